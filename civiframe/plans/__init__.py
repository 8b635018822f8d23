"""The nightly jobs: operators chained from raw frame to result frame.

Functions named ``*_plan`` only build a DataFrame. Functions named ``run_*`` read,
build and write.
"""
