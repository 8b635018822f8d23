"""Joins of facts with computed lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Places over which facts without any key are dealt when a missing key matches a missing key.
SPREAD = 256


def _common_type(facts: DataFrame, name: str, lookup: DataFrame, other: str) -> str:
    """Type that the values of both key columns fit into; equal ones stay as they are."""
    first, second = facts.schema[name].dataType, lookup.schema[other].dataType
    if first == second:
        return first.simpleString()
    both = facts.sparkSession.range(0).select(F.coalesce(F.lit(None).cast(first), F.lit(None).cast(second)).alias("k"))
    return both.schema["k"].dataType.simpleString()


def row_hash(df: DataFrame) -> Column:
    """Hash of a row by its columns of plain types: deals rows that have no key."""
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    return F.xxhash64(*plain)


def spread_left_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]], *,
    null_safe: bool = False, shuffled: bool = False, unsorted: bool = False,
) -> DataFrame:
    """Left join whose hot keys AQE can split, also when the lookup was aggregated on the key.

    AQE splits a skewed partition only where both sides come straight from a shuffle. A lookup that
    was aggregated or ranked on the join key is already partitioned by it, so it is not shuffled
    again, and a key with most of the facts would be one task. Here both sides are joined on the key
    and its hash: the lookup, which is small beside the facts, is shuffled once more for that, and
    then measured sizes decide which partitions are split. Other keys cost nothing; a small lookup is
    still broadcast, unless ``shuffled`` says that it grows with the facts: estimates from compressed
    files would broadcast it long after it is large. ``unsorted`` keeps the facts from being sorted: a partition's
    lookup rows are hashed in memory instead, for lookups without frequent keys that are no larger than the facts. Facts with a missing key match nothing and are
    dealt by their own content; with ``null_safe`` facts without any key are dealt over ``SPREAD``
    places, to each of which the lookup's rows without a key are sent. The lookup's key columns are
    dropped; other names must differ.
    """
    kinds = [_common_type(facts, name, lookup, other) for name, other in on]
    keys = [F.col(other).alias(f"_key{i}") for i, (_, other) in enumerate(on)]
    others = [c for c in lookup.columns if c not in {other for _, other in on}]

    def hashed(names: Sequence[str]):
        return F.xxhash64(*[F.col(name).cast(kind) for name, kind in zip(names, kinds)])

    def missing(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b if null_safe else a | b, [F.col(name).isNull() for name in names])

    own, theirs = [name for name, _ in on], [other for _, other in on]
    spread = F.pmod(row_hash(facts), F.lit(SPREAD)) if null_safe else row_hash(facts)
    left = facts.withColumn("_hash", F.when(missing(own), spread).otherwise(hashed(own)))
    if null_safe:
        places = F.when(missing(theirs), F.sequence(F.lit(0), F.lit(SPREAD - 1)).cast("array<bigint>"))
        right = lookup.select(*keys, *others, F.explode(F.coalesce(places, F.array(hashed(theirs)))).alias("_lookup_hash"))
    else:
        right = lookup.select(*keys, *others, hashed(theirs).alias("_lookup_hash"))
    tests = [F.col("_hash") == F.col("_lookup_hash")]
    for i, (name, _) in enumerate(on):
        tests.append(F.col(name).eqNullSafe(F.col(f"_key{i}")) if null_safe else F.col(name) == F.col(f"_key{i}"))
    if unsorted:
        right = right.hint("shuffle_hash")
    elif shuffled:
        right = right.hint("merge")
    joined = left.join(right, reduce(lambda a, b: a & b, tests), "left")
    return joined.drop("_hash", "_lookup_hash", *[f"_key{i}" for i in range(len(on))])
