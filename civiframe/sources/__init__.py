"""Readers and writers of date-partitioned feeds, snapshots and pointers."""
