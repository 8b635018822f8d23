"""Writers. Replacing a partition is one dynamic overwrite, so a re-run gives the
same table; there is no separate delete that could be left half done.

Tables whose rows are replaced by key (one sensor of many) have buckets of the key beneath
the day. A replacement lists the (day, bucket) folders that it touches; only these are
read and written, so its cost does not grow with the other keys of those days."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.config import POINTER
from civiframe.functions.dates import days_between
from civiframe.session import Staged, folders, remove_path
from civiframe.sources.readers import day_folder, on_date, read_dated, read_or_empty

DAY = ("year", "month", "day")
WEEK = ("year", "month", "week")
BUCKET = (*DAY, "bucket")
#: Buckets of a day. A table keeps the number it was first written with.
BUCKETS = 16
_WIDTH = {"year": 4, "bucket": 3}


def _balanced(df: DataFrame, files: int | None, by: Sequence[str] = ()) -> DataFrame:
    """``files`` outputs when a number is given; otherwise a rebalance, where AQE cuts
    partitions to the advisory size and splits a day that holds most rows."""
    if files:
        return df.repartition(files)
    return df.hint("rebalance", *by) if by else df.hint("rebalance")


def append_day(df: DataFrame, base: str, fmt: str = "orc", by: Sequence[str] = DAY) -> None:
    df.write.mode("append").partitionBy(*by).format(fmt).save(base)


def append_with_csv(df: DataFrame, base: str, csv_base: str, by: Sequence[str] = DAY) -> None:
    """ORC append plus a CSV copy."""
    append_day(df, base, by=by)
    df.write.mode("append").partitionBy(*by).options(header=True, sep=";").csv(csv_base)


def write_dual(df: DataFrame, base: str, files: int | None = None, mode: str = "append") -> None:
    """Gzip CSV and ORC copies, rebalanced to the advisory size (or to ``files`` outputs). The
    frame is staged once, so its plan does not run twice."""
    with Staged(df.sparkSession) as work:
        staged = _balanced(work.put(df, "dual"), files)
        staged.write.mode(mode).options(header=True, sep=";", compression="gzip").csv(f"{base}/csv")
        staged.write.mode(mode).orc(f"{base}/orc")


def publish_pointer(spark: SparkSession, base: str, path: str, moment) -> None:
    """Append the pointer row after the snapshot is complete."""
    row = spark.createDataFrame([(moment, path)], POINTER)
    row.coalesce(1).write.mode("append").orc(f"{base}/latest")


def write_snapshot(df: DataFrame, base: str, path: str, moment) -> None:
    """Dimension snapshot, then the pointer that makes it the latest one."""
    df.write.mode("overwrite").orc(f"{base}/{path}")
    publish_pointer(df.sparkSession, base, path, moment)


def _folder_values(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partition columns as the text their folders carry (``month=01``): values read back
    from folders come as numbers and would otherwise open folders of their own."""
    return df.withColumns({c: F.lpad(F.col(c).cast("string"), _WIDTH.get(c, 2), "0") for c in by})


def _overwrite_partitions(df: DataFrame, base: str, by: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .orc(base)
    )


def replace_partition(df: DataFrame, base: str, by: Sequence[str] = DAY) -> None:
    """Replace every partition that ``df`` brings, leave the others alone."""
    _overwrite_partitions(_balanced(_folder_values(df, by), None, by), base, by)


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def in_buckets(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` with the bucket of its key; null keys share one."""
    return df.withColumn("bucket", bucket_of(F.col(key), buckets))


def _written(df: DataFrame, by: Sequence[str]) -> set[str]:
    """Folders that rows of ``df`` lie in, below the base. A row for each folder reaches the driver."""
    return {"/".join(f"{c}={row[c]}" for c in by) for row in df.select(*by).distinct().collect()}


def _below(base_depth: int, path: str) -> str:
    return "/".join(path.split("/")[-base_depth:])


def _remove_emptied(spark: SparkSession, found: list[str], written: set[str], by: Sequence[str]) -> None:
    """Of the folders ``found`` those that hold no row any more go, with their day if it is empty then."""
    for path in found:
        if _below(len(by), path) not in written:
            remove_path(spark, path)
            day = path.rsplit("/", 1)[0]
            if len(by) > len(DAY) and not folders(spark, f"{day}/*"):
                remove_path(spark, day)


def replace_day(df: DataFrame, base: str, date: str, by: Sequence[str] = DAY) -> None:
    """Replace all that ``base`` holds of a day; a frame without rows clears it.

    Rows of another day, or of none, are an error before anything is written. Folders of
    the day (its buckets, if ``by`` has them) that got no row go after the new ones are in place.
    """
    spark = df.sparkSession
    with Staged(spark) as work:
        rows = work.put(_folder_values(df, by), "day")
        if not rows.where(~F.coalesce(on_date(date), F.lit(False))).isEmpty():
            raise ValueError(f"rows to store outside {date}, or without a day")
        _overwrite_partitions(_balanced(rows, None, by), base, by)
        written = _written(rows, by)
        found = folders(spark, "/".join([day_folder(base, date), *[f"{c}=*" for c in by if c not in DAY]]))
        _remove_emptied(spark, found, written, by)


def replace_touched(
    spark: SparkSession,
    new: DataFrame,
    base: str,
    touched: DataFrame,
    survivors: Callable[[DataFrame], DataFrame],
) -> None:
    """Rewrite the folders ``touched`` (``year, month, day, bucket``) as ``survivors`` of their
    rows plus ``new``; all other folders stay as they are.

    ``new`` may hold rows of these folders alone: another folder, or none, is an error before
    anything is written, since it would be replaced whole. A table that does not exist yet is
    empty. The result is staged first, since it is read from the table being written; a folder
    left without rows goes. The list of folders, a row for each, reaches the driver.
    """
    with Staged(spark) as work:
        new = work.put(_folder_values(new, BUCKET), "replacement")
        wanted = work.put(_folder_values(touched.select(*BUCKET).distinct(), BUCKET), "touched")
        if not new.join(wanted, list(BUCKET), "left_anti").isEmpty():
            raise ValueError("rows to store outside the touched folders, or without a day")
        names = _written(wanted, BUCKET)
        months = defaultdict(lambda: (set(), set()))
        for name in names:
            year, month, day, bucket = name.split("/")
            months[f"{year}/{month}"][0].add(day)
            months[f"{year}/{month}"][1].add(bucket)
        found = [
            path
            for month, (days, buckets) in months.items()
            for path in folders(spark, f"{base}/{month}/{{{','.join(sorted(days))}}}/{{{','.join(sorted(buckets))}}}")
            if _below(len(BUCKET), path) in names
        ]
        stored = read_or_empty(spark, lambda: spark.read.option("basePath", base).orc(found), new.schema) if found else new.limit(0)
        stored = _folder_values(stored, BUCKET)
        new = new.select(*[F.col(n).cast(stored.schema[n].dataType).alias(n) for n in stored.columns])
        result = work.put(survivors(stored).unionByName(new), "replace")
        left = _written(result, BUCKET)
        _overwrite_partitions(_balanced(result, None, BUCKET), base, BUCKET)
        _remove_emptied(spark, found, left, BUCKET)


def replace_key_range(
    spark: SparkSession, new: DataFrame, base: str, first: str, last: str, key: str, value: str, buckets: int = BUCKETS
) -> None:
    """Replace one sensor's rows of the days ``first`` to ``last``, both included, in its bucket."""
    days = spark.range(1).select(F.explode(days_between(F.to_date(F.lit(first)), F.date_add(F.lit(last), 1))).alias("d"))
    touched = days.select(
        F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"),
        bucket_of(F.lit(value), buckets).alias("bucket"),
    )
    replace_touched(
        spark, in_buckets(new, key, buckets), base, touched, lambda stored: stored.where(~F.col(key).eqNullSafe(value))
    )


def replace_key_day(
    spark: SparkSession, new: DataFrame, base: str, date: str, key: str, value: str, buckets: int = BUCKETS
) -> None:
    """Replace one sensor's rows of one day."""
    replace_key_range(spark, new, base, date, date, key, value, buckets)


def full_reload(df: DataFrame, target: str, fmt: str = "orc") -> None:
    df.write.mode("overwrite").format(fmt).save(target)


def publish_to(df: DataFrame, reloads: Sequence[str] = (), replaces: Sequence[str] = ()) -> None:
    """One frame to several targets: full reloads and partition replacements."""
    with Staged(df.sparkSession) as work:
        staged = work.put(df, "publish")
        for target in reloads:
            full_reload(staged, target)
        for target in replaces:
            replace_partition(staged, target)


def publish_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Full reload of a database table; the table itself is kept."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=options)


def patch_column(
    spark: SparkSession, base: str, date: str, column: str, type_name: str, target: str
) -> None:
    """Stored snapshot of a date with one column cast, written beside the original as
    CSV and ORC."""
    stored = read_dated(spark, base, date)
    patched = stored.withColumn(column, F.col(column).try_cast(type_name))
    write_dual(patched, target, mode="overwrite")


def mark_replayed(sensors: DataFrame, replayed: DataFrame, date: str) -> DataFrame:
    """Sensors with ``reprisedon`` set for those replayed. Missing ids match nothing."""
    done = replayed.select("deveui").where(F.col("deveui").isNotNull()).distinct()
    flagged = sensors.join(done.withColumn("_done", F.lit(True)), "deveui", "left")
    return flagged.withColumn(
        "reprisedon", F.when(F.col("_done"), F.lit(date)).otherwise(F.col("reprisedon"))
    ).select(*sensors.columns)
