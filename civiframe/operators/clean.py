"""Projection, casting and whole-batch quality gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiframe.operators.joins import spread_left_join
from civiframe.config import BIN, OUTLET, PRODUCER, TableSpec
from civiframe.functions import text as X
from civiframe.functions.keys import technical_key
from civiframe.functions.dates import week_of_month_text
from civiframe.sources.readers import empty_frame

LENIENT = {
    "double": X.lenient_double,
    "int": X.lenient_int,
    "boolean": X.lenient_boolean,
    "float": X.lenient_float,
    "string": lambda c: c,
}


# -- naming -----------------------------------------------------------------------


def name_positional(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``_c0, _c1, ...`` -> configured names; extra columns keep their own."""
    return df.withColumnsRenamed({f"_c{i}": name for i, name in enumerate(spec.names)})


def in_spec_order(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Configured columns in configured order, others dropped."""
    return df.select(*spec.names)


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[X.clean_header(name) for name in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names are matched without regard to case."""
    return df.withColumnsRenamed(dict(names))


# -- casts ------------------------------------------------------------------------


def lenient_cast(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every configured column cast by its type; bad text becomes the type's zero."""
    return df.withColumns({f.name: LENIENT[f.type](F.col(f.name)) for f in spec.fields})


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


# -- gates ------------------------------------------------------------------------


def violation_counts(
    df: DataFrame, required: Sequence[str] = (), limits: Mapping[str, int] | None = None
) -> DataFrame:
    """One row: how many rows miss a required value, how many hold an over-long one."""
    missing = _any([F.col(c).isNull() for c in required]) if required else F.lit(False)
    long = (
        _any([F.coalesce(F.length(c) > n, F.lit(False)) for c, n in limits.items()])
        if limits
        else F.lit(False)
    )
    return df.agg(
        F.count_if(missing).alias("missing_required"), F.count_if(long).alias("too_long")
    )


def gate(
    df: DataFrame, required: Sequence[str] = (), limits: Mapping[str, int] | None = None
) -> DataFrame:
    """The whole batch, or no row at all if any row violates. The check is a scalar
    subquery over the full input, so nothing is counted on the driver."""
    counts = violation_counts(df, required, limits)
    bad = counts.select((F.col("missing_required") + F.col("too_long")).alias("n"))
    return df.where(bad.scalar() == 0)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def _gated(df: DataFrame, spec: TableSpec, casts: Mapping[str, Column]) -> DataFrame:
    if not set(spec.names) <= set(df.columns):
        return empty_frame(df.sparkSession, spec.schema())
    return gate(df.withColumns(dict(casts)), spec.required, spec.limits)


def prepare_producers(raw: DataFrame) -> DataFrame:
    """Typed producers; a batch that lacks a column, misses a required value or holds
    an over-long text is rejected whole. A bad optional number becomes null."""
    df = normalise_headers(raw)
    return _gated(
        df,
        PRODUCER,
        {
            "code_producteur": X.text_to_int(F.col("code_producteur")),
            "rva_adr": X.text_to_int(F.col("rva_adr")),
            "code_insee": X.text_to_int(F.col("code_insee")),
            "longitude": F.col("longitude").try_cast("double"),
            "latitude": F.col("latitude").try_cast("double"),
        },
    )


def prepare_bins(raw: DataFrame) -> DataFrame:
    """Typed bins, same rejection; missing or bad frequencies become 0."""
    df = rename(normalise_headers(raw), BIN.aliases)
    return _gated(
        df,
        BIN,
        {
            "code_producteur": X.text_to_int(F.col("code_producteur")),
            "litrage_recipient": X.text_to_int(F.col("litrage_recipient")),
            "frequence_om": X.lenient_int(F.col("frequence_om")),
            "frequence_cs": X.lenient_double(F.col("frequence_cs")),
        },
    )


def prepare_outlets(raw: DataFrame) -> DataFrame:
    """Ten outlet columns under clean headers, cast, required values checked."""
    df = in_spec_order(normalise_headers(raw), OUTLET)
    return gate(lenient_cast(df, OUTLET), OUTLET.required)


def prepare_weighings(raw: DataFrame, spec: TableSpec) -> DataFrame:
    named = raw if spec.header else name_positional(raw, spec)
    return in_spec_order(lenient_cast(named, spec), spec)


# -- filters and stamps -------------------------------------------------------------


def between_hours(df: DataFrame, ts: str, first: int, last: int) -> DataFrame:
    """Hours strictly between the bounds; as a set, so the time is parsed once per row."""
    return df.where(F.hour(ts).isin(list(range(first + 1, last))))


def before_date(df: DataFrame, ts: str, date: str) -> DataFrame:
    return df.where(F.col(ts) < F.to_date(F.lit(date)))


def stamp_day(df: DataFrame, date: str) -> DataFrame:
    year, month, day = date.split("-")
    return df.withColumns({"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)})


def stamp_week(df: DataFrame, date: str) -> DataFrame:
    year, month, day = date.split("-")
    week = week_of_month_text(int(day))
    return df.withColumns({"year": F.lit(year), "month": F.lit(month), "week": F.lit(week)})


def with_technical_key(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumn("technical_key", technical_key(*[F.col(c) for c in columns]))


# -- duplicates ---------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """Rows of every duplicated key with the row count; null keys form one group."""
    repeated = duplicate_keys(df, key).withColumnRenamed(key, "_key")
    return spread_left_join(df, repeated, [(key, "_key")], null_safe=True).where("n_rows is not null")


def keep_one(df: DataFrame, key: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per key, the first by ``order`` (default: all columns). The rank limit
    runs before the shuffle, so a hot key sends one row per task."""
    window = Window.partitionBy(key).orderBy(*(order or [c for c in df.columns if c != key]))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def batch_date(df: DataFrame, column: str = "date_photo") -> DataFrame:
    """The batch's photo date with the number of different ones found."""
    return df.agg(F.max(column).alias(column), F.count_distinct(column).alias("n_dates"))


def single_batch_date(df: DataFrame, column: str = "date_photo") -> str | None:
    """Photo date for the driver; a mixed batch is an error (one row is fetched)."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low != high:
        raise ValueError(f"batch mixes {column} {low} and {high}")
    return high


def frame_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in one frame only, duplicates counted, with the side they come from. Columns match by
    position. Rows count plus one on the left and minus one on the right; one grouping on the whole row
    gives both directions."""
    signed = left.withColumn("_sign", F.lit(1)).unionAll(right.withColumn("_sign", F.lit(-1)))
    names = signed.columns[:-1]
    surplus = signed.groupBy(*[F.col(f"`{n}`") for n in names]).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    copies = F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int")))
    return surplus.withColumns({"side": F.when(F.col("_n") > 0, "left").otherwise("right"), "_n": copies}).drop("_n")
