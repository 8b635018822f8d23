"""Scans. A job that needs one day opens that day's folder (``day_folder``), so neither listing
nor header nor schema depends on other days. Ranges of dates select Hive-style
partitions by predicate, and Spark prunes folders at planning time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.config import TableSpec
from civiframe.functions.dates import week_of_month_text
from civiframe.session import folders


def on_date(date: str) -> Column:
    """Predicate for ``yyyy-MM-dd`` (one day) or ``yyyy-MM`` (a whole month)."""
    names = ("year", "month", "day")
    tests = [F.col(n).cast("int") == int(v) for n, v in zip(names, date.split("-"))]
    return _all(tests)


def day_folder(base: str, date: str) -> str:
    """Glob of the folder of a day (or of a month's days): ``month=01`` as well as ``month=1``.
    Read it with ``basePath`` so that the partition columns stay."""
    return _folder(base, ("year", "month", "day"), date.split("-"))


def week_folder(base: str, date: str) -> str:
    """Glob of the folder of a date's week of the month."""
    year, month, day = date.split("-")
    return _folder(base, ("year", "month", "week"), (year, month, week_of_month_text(int(day))))


def _folder(base: str, names: Sequence[str], values: Sequence[str]) -> str:
    parts = [f"{name}={{{v},{int(v)}}}" if v != str(int(v)) else f"{name}={v}" for name, v in zip(names, values)]
    return "/".join([base, *parts])


def in_week_of(date: str) -> Column:
    year, month, day = date.split("-")
    week = week_of_month_text(int(day))
    return _all(
        [
            F.col("year").cast("int") == int(year),
            F.col("month").cast("int") == int(month),
            F.col("week").cast("int") == int(week),
        ]
    )


def between_dates(first: str, last: str) -> Column:
    """Days ``first`` to ``last``, both included. The comparison uses partition
    columns only, so it prunes."""
    day_number = (
        F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    )
    return day_number.between(int(first.replace("-", "")), int(last.replace("-", "")))


def day_equals(date: str) -> Column:
    """Rows of one day given by text columns year, month, day."""
    year, month, day = date.split("-")
    return (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)


def _all(tests: list[Column]) -> Column:
    result = tests[0]
    for test in tests[1:]:
        result = result & test
    return result


# -- file formats ---------------------------------------------------------------


def read_csv_schema(spark: SparkSession, path: str, spec: TableSpec, base: str | None = None) -> DataFrame:
    """CSV under a mandatory schema (compressed files are recognised by suffix)."""
    reader = (
        spark.read.schema(spec.schema())
        .option("header", spec.header)
        .option("sep", spec.delimiter)
        .option("encoding", spec.encoding)
    )
    return _below(reader, base).csv(path)


def _below(reader, base: str | None):
    return reader if base is None else reader.option("basePath", base)


def read_csv_config(spark: SparkSession, path: str, spec: TableSpec, base: str | None = None) -> DataFrame:
    """CSV as text columns, header, delimiter and encoding from the specification. Files
    whose header differs from the first one's fail instead of shifting columns."""
    reader = (
        spark.read.option("header", spec.header)
        .option("sep", spec.delimiter)
        .option("encoding", spec.encoding)
        .option("inferSchema", False)
        .option("enforceSchema", False)
    )
    return _below(reader, base).csv(path)


def read_orc(
    spark: SparkSession, path: str, schema: T.StructType | None = None, base: str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _below(reader, base).orc(path)


def read_orc_day(spark: SparkSession, base: str, date: str, schema: T.StructType) -> DataFrame:
    """The stored rows of a day; a day without folder is empty."""
    return read_or_empty(spark, lambda: read_orc(spark, day_folder(base, date), base=base), schema)


def read_orc_below(spark: SparkSession, path: str) -> DataFrame:
    """Every ORC file below a folder that also holds other formats."""
    return (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.orc").orc(path)
    )


def read_frames(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True, base: str | None = None
) -> DataFrame:
    """Nested JSON frames. Jobs pass ``schema``; without one every file is read to infer it."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return _below(reader, base).json(path)


def read_variant_frames(
    spark: SparkSession, path: str, base: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Frames whose ``data`` differs from sensor to sensor and day to day: ``deveui, timestamp, data``
    and the day, ``data`` a VARIANT. Nothing is inferred and no schema is given, so days of
    different structures are one scan. A file holds frames or arrays of them."""
    raw = _below(spark.read.option("singleVariantColumn", "_file").option("multiLine", multi_line), base).json(path)
    frames = F.coalesce(F.try_variant_get("_file", "$", "array<variant>"), F.array("_file"))
    # the frames of a file are one value first, so that the filter of the second explode does not read the file again
    each = raw.select(*[c for c in raw.columns if c != "_file"], F.explode(F.array(frames)).alias("_frames")).withColumn("_frame", F.explode("_frames"))
    return each.select(
        F.try_variant_get("_frame", "$.deveui", "string").alias("deveui"),
        F.try_variant_get("_frame", "$.timestamp", "string").alias("timestamp"),
        F.try_variant_get("_frame", "$.data", "variant").alias("data"),
        *[c for c in raw.columns if c != "_file"],
    )


def read_table(spark: SparkSession, path: str, fmt: str, spec: TableSpec | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv_config(spark, path, spec)
    if fmt == "orc":
        return read_orc(spark, path)
    if fmt == "orc_below":
        return read_orc_below(spark, path)
    if fmt == "json":
        return read_frames(spark, path)
    raise ValueError(f"unknown format {fmt!r}")


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Database table. ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` split the read; the driver jar comes with the deployment."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


# -- missing data ---------------------------------------------------------------


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_or_empty(spark: SparkSession, read, schema: T.StructType) -> DataFrame:
    """``read()``, or an empty typed frame when the path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return empty_frame(spark, schema)


# -- snapshots ------------------------------------------------------------------


def latest_path(pointers: DataFrame) -> str | None:
    """Path of the newest pointer row (one row reaches the driver)."""
    return pointers.agg(F.max_by("path", "date").alias("path")).first()["path"]


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """Newest snapshot named by the pointer table ``base/latest``."""
    path = latest_path(spark.read.orc(f"{base}/latest"))
    return spark.read.orc(f"{base}/{path}")


def read_dated(spark: SparkSession, base: str, date: str) -> DataFrame:
    """Snapshot of a date from a partitioned snapshot table: only its folder is listed and
    opened. A date without one gives no rows."""
    found = folders(spark, day_folder(base, date))
    return spark.read.option("basePath", base).orc(found) if found else spark.read.orc(base).where(on_date(date))


def reference_month(date: str) -> str:
    """``yyyy-MM`` of the same month one year earlier."""
    year, month = date.split("-")[:2]
    return f"{int(year) - 1}-{month}"


def support_month(date: str) -> tuple[str, str]:
    """Stored month holding the reference weights and its file format. The feed
    began in 2021, whose only stored month is January, as CSV."""
    year, month = date.split("-")[:2]
    if year == "2022":
        return f"{int(year) - 1}-01", "csv"
    return f"{int(year) - 1}-{month}", "orc_below"


def previous_year_window(facts: DataFrame, ts: str, date: str) -> DataFrame:
    """Facts of the month ``reference_month(date)``, as a range on the time column so
    that the predicate reaches the scan."""
    first = F.to_date(F.lit(reference_month(date) + "-01"))
    return facts.where((F.col(ts) >= first) & (F.col(ts) < F.add_months(first, 1)))


def scan_days(frames: DataFrame, first: str, last: str) -> DataFrame:
    """One pruned scan over a range of days instead of one scan per day."""
    return frames.where(between_dates(first, last))


def fill_day_columns(df: DataFrame, date: str) -> DataFrame:
    """Day columns of a file read outside the partitioned layout, kept where present."""
    for name, value in zip(("year", "month", "day"), date.split("-")):
        known = F.coalesce(F.col(name).cast("string"), F.lit(value)) if name in df.columns else F.lit(value)
        df = df.withColumn(name, known)
    return df


def union_days(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Days whose frames differ in columns, missing ones null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def known_only(frames: DataFrame, referential: DataFrame, key: str = "deveui") -> DataFrame:
    return frames.join(referential.select(key), key, "left_semi")
