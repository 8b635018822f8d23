"""Joins on validity intervals and tumbling-window statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.operators.joins import SPREAD

#: A key with more versions than this has its intervals indexed; so many of the shortest
#: version fit into a leaf of the index.
LEAF_VERSIONS = 8
#: Most levels of an index below its root.
MOST_LEVELS = 24


def _moments(*columns: tuple[DataFrame, str]) -> tuple[list[Column], Callable[[Column], Column]]:
    """The columns as times that compare, and a function that turns such a time into seconds on one clock.
    A malformed text is null and lies in no interval. Texts are wall-clock times unless another
    column is an instant."""
    kinds = [df.schema[name].dataType for df, name in columns]
    wanted = "timestamp" if any(isinstance(k, T.TimestampType) for k in kinds) else "timestamp_ntz"
    moments = [
        F.col(name).try_cast(wanted) if isinstance(kind, T.StringType) else F.col(name)
        for (_, name), kind in zip(columns, kinds)
    ]

    def seconds(moment: Column) -> Column:
        if all(isinstance(k, T.NumericType) for k in kinds):
            return F.floor(moment.cast("double"))
        time = moment.cast(wanted)
        if wanted == "timestamp":
            return F.unix_seconds(time)
        return F.unix_date(time.cast("date")).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)

    return moments, seconds


def _shifted(value: Column, places: Column, direction: str = "right") -> Column:
    return F.call_function(f"shift{direction}", value.cast("long"), places.cast("int"))


def _leaf(second: Column) -> Column:
    """Place of a time among the ``2 ** _levels`` equal parts of its key's span; what is outside goes to the ends."""
    parts = _shifted(F.lit(1), F.col("_levels"), "left")
    place = F.floor((second - F.col("_low")) * parts / (F.col("_high") - F.col("_low") + 1))
    return F.greatest(F.lit(0), F.least(place, parts - 1)).cast("long")


def _ancestor(leaf: Column, height: Column) -> Column:
    """Node so many levels above a leaf; the root is 1."""
    return _shifted(leaf + _shifted(F.lit(1), F.col("_levels"), "left"), height)


def _cover(first: Column, last: Column) -> Column:
    """The fewest nodes whose leaves are exactly ``first`` to ``last``: two a level at most."""

    def of_level(h: Column) -> Column:
        side = _shifted(F.lit(1), h, "left")
        left, right = _shifted(first + side - 1, h), _shifted(last + 1, h)
        start = _shifted(F.lit(1), F.col("_levels") - h, "left")
        return F.array(
            F.when((left < right) & (left % 2 == 1), start + left), F.when((left < right) & (right % 2 == 1), start + right - 1)
        )

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.col("_levels")), of_level)))


def interval_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[tuple[str, str]],
    ts: str,
    start: str,
    end: str,
    *,
    how: str = "left",
    closed: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Facts with the dimension rows valid at their time.

    ``keys`` pairs fact and dimension columns. The interval is ``[start, end]``
    (``closed``) or ``[start, end)``; a null end is open, a malformed one is not. Columns
    of both sides are returned, so their names must differ.

    One plan for every input, and nothing is run while it is built: the join hashes on the keys, the
    interval is its residual. A key with more than ``LEAF_VERSIONS`` versions has one entry there, its
    index, and its versions are met in a second join, on the keys and a node of a binary tree over the
    times of the key. The leaves are as short as a few of the key's shortest versions; a version is
    listed under the few nodes that make up its interval, a fact looks up the nodes above its own leaf.
    So a fact meets versions near its time, and a key with many facts is dealt over its nodes. Without
    such keys the second join has an empty side, and AQE drops it. For a left join the times that no
    version of an indexed key covers are versions of their own without values.

    Facts without any key would be one task of either join. They are dealt over ``SPREAD`` places of the
    first, to which the entries without a key (``LEAF_VERSIONS`` at most) are sent if ``null_safe``. The
    second deals facts that it need not look up. Both go by the time of the fact. The first is a merge join, as versions
    grow with their keys and estimates from compressed files would broadcast them whole.
    """
    (moment, first, last), seconds = _moments((facts, ts), (versions, start), (versions, end))
    names = [f"_key{i}" for i in range(len(keys))]
    own = {n: F.col(v) for n, (_, v) in zip(names, keys)}

    known = versions.where(first.isNotNull() & (F.col(end).isNull() | last.isNotNull())).withColumns(
        own | {"_first": first, "_last": last, "_first_s": seconds(first), "_last_s": seconds(last)}
    )
    length = F.col("_last_s") - F.col("_first_s")
    span = {
        "_n": F.count("*"),
        "_low": F.min("_first_s"),
        "_high": F.max(F.greatest("_first_s", "_last_s")),
        "_short": F.min(F.when(length > 0, length)),
    }
    ratio = (F.col("_high") - F.col("_low") + 1) / F.coalesce("_short", F.lit(1))
    fine = F.least(F.ceil(F.log2(ratio / LEAF_VERSIONS)), F.ceil(F.log2("_n")) + 4, F.lit(MOST_LEVELS)).cast("int")
    levels = F.when((F.col("_n") > LEAF_VERSIONS) & (fine > 0), fine)

    spans = known.groupBy(*names).agg(*[c.alias(n) for n, c in span.items()]).withColumn("_levels", levels)
    spans = spans.where("_levels is not null").select(*names, "_low", "_high", "_levels")
    other = spans.toDF(*[f"_of{n}" for n in names], "_low", "_high", "_levels")

    def same(left: Sequence[str], right: Sequence[str]) -> list[Column]:
        return [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in zip(left, right)]

    def together(tests: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a & b, tests)

    def covers(to: str) -> Column:
        upper = time <= F.col("_last") if closed else time < F.col("_last")
        return (time >= F.col("_first")) & (F.col(f"`{to}`").isNull() | upper)

    own_key = [f for f, _ in keys]
    of_span = together(same(names, [f"_of{n}" for n in names]))
    time = F.col("_moment")
    plain = known.select(*versions.columns, *names, "_first", "_last").join(other, of_span, "left_anti")
    by_time = F.xxhash64(F.col(f"`{ts}`"))  # no other column is needed for it, so unused ones stay unread
    # of a key that is missing as a whole, facts are dealt over places and its entries sent to each of them
    places = F.when(together([F.lit(null_safe), *[F.col(n).isNull() for n in names]]), F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    place = F.when(together([F.col(f"`{k}`").isNull() for k in own_key]), F.pmod(by_time, F.lit(SPREAD)).cast("int"))
    direct = plain.unionByName(spans, allowMissingColumns=True).withColumn("_at", F.explode(F.coalesce(places, F.array(F.lit(0)))))
    entry = F.when(F.col("_levels").isNotNull(), time.isNotNull()).otherwise(covers(end))
    placed = facts.withColumns({"_moment": moment, "_place": F.coalesce(place, F.lit(0))})
    met = placed.join(direct.hint("merge"), together([*same(own_key, names), F.col("_place") == F.col("_at"), entry]), how)

    height = F.explode(F.when(F.col("_levels").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_levels"))))
    # nodes are positive
    node = F.when(F.col("_levels").isNotNull(), _ancestor(_leaf(seconds(time)), F.col("_height"))).otherwise(-F.pmod(by_time, F.lit(1 << 20)))
    asked = met.drop("_first", "_last", "_place", "_at", *names).withColumn("_height", height).withColumn("_node", node)
    there = {c: f"_indexed_{c}" for c in versions.columns}
    listed = _listed(known.join(other, of_span), versions, names, F.col(end).isNull(), how == "left").withColumnsRenamed(there)
    after = F.col("_first").isNull() | (time > F.col("_first") if closed else time >= F.col("_first"))
    between = after & (F.col("_last").isNull() | (time < F.col("_last")))
    inside = F.when(F.col("_gap"), between).otherwise(covers(there[end]))
    joined = asked.join(listed, together([*same(own_key, names), F.col("_node") == F.col("_listed"), inside]), "left")
    joined = joined.where(F.col("_levels").isNull() | F.col("_listed").isNotNull())

    def value(c: str) -> Column:
        return F.when(F.col("_levels").isNull(), F.col(f"`{c}`")).otherwise(F.col(f"`{there[c]}`")).alias(c)

    return joined.select(*[F.col(f"`{c}`") for c in facts.columns], *map(value, versions.columns))


def _listed(spanned: DataFrame, versions: DataFrame, names: list[str], open_end: Column, gaps: bool) -> DataFrame:
    """Versions of indexed keys under the nodes that make up their intervals; with ``gaps`` also the times
    that no version of the key covers, as versions with null columns.

    ``_first`` and ``_last`` are then the times between which a gap lies, null where it has no end. A gap
    lies before a version that starts after all earlier ones have ended, and after the last one.
    """
    top = _shifted(F.lit(1), F.col("_levels"), "left") - 1
    kind = dict(spanned.dtypes)["_first"]

    def entry(gap: bool, first: Column, last: Column, nodes: Column) -> Column:
        parts = {"_gap": F.lit(gap), "_first": first.cast(kind), "_last": last.cast(kind), "_nodes": nodes}
        return F.struct(*[c.alias(n) for n, c in parts.items()])

    own = _cover(_leaf(F.col("_first_s")), F.coalesce(_leaf(F.col("_last_s")), top))
    entries = [entry(False, F.col("_first"), F.col("_last"), own)]
    if gaps:
        before = Window.partitionBy(*names).orderBy("_first")
        earlier = before.rowsBetween(Window.unboundedPreceding, -1)
        everything = Window.partitionBy(*names)
        spanned = spanned.withColumns({
            "_until": F.max("_last").over(earlier), "_until_s": F.max("_last_s").over(earlier),
            "_open": F.coalesce(F.max(open_end).over(earlier), F.lit(False)), "_place": F.row_number().over(before),
            "_rows": F.count("*").over(everything), "_end": F.max("_last").over(everything),
            "_end_s": F.max("_last_s").over(everything), "_ever_open": F.max(open_end).over(everything),
        })
        until, start = F.col("_until"), F.col("_first")
        from_ = F.when(until.isNull(), F.lit(0)).otherwise(_leaf(F.col("_until_s"))).cast("long")
        ahead = ~F.col("_open") & (until.isNull() | (until < start))
        behind = (F.col("_place") == F.col("_rows")) & ~F.col("_ever_open")
        entries.append(F.when(ahead, entry(True, until, start, _cover(from_, _leaf(F.col("_first_s"))))))
        entries.append(F.when(behind, entry(True, F.col("_end"), F.lit(None), _cover(_leaf(F.col("_end_s")), top))))
    each = spanned.select(*versions.columns, *names, F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    values = [F.when(~F.col("_e._gap"), F.col(f"`{c}`")).alias(c) for c in versions.columns]
    return each.select(*values, *names, "_e._gap", "_e._first", "_e._last", F.explode("_e._nodes").alias("_listed"))


def traffic_statistics(df: DataFrame, minutes: int = 15) -> DataFrame:
    """Speed and reliability per segment and tumbling window. Partial aggregates are
    built before the only shuffle."""
    return (
        df.groupBy("segment", F.window("date", f"{minutes} minutes").alias("w"))
        .agg(
            F.min("avgSpeed").alias("speed_min"),
            F.round(F.avg("avgSpeed"), 1).alias("speed_avg"),
            F.max("avgSpeed").alias("speed_max"),
            F.round(F.stddev("avgSpeed"), 1).alias("speed_std"),
            F.round(F.avg("reliability"), 1).alias("rel_avg"),
            F.round(F.stddev("reliability"), 1).alias("rel_std"),
            F.count("avgSpeed").alias("nb_values"),
        )
        .select(
            F.col("w.start").alias("start_time"), F.col("segment").alias("id"),
            "speed_min", "speed_avg", "speed_max", "speed_std", "rel_avg", "rel_std", "nb_values",
        )
    )
