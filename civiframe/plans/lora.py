"""Sensor frames: daily load and replay, all sensors in one plan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.functions.dates import days_between
from civiframe.operators.clean import stamp_day, with_technical_key
from civiframe.operators.melt import (
    expand_data,
    explode_history,
    melt_measures,
    sensors_to_replay,
)
from civiframe.operators.temporal import interval_join
from civiframe.session import Staged
from civiframe.sources.readers import (
    between_dates,
    day_folder,
    known_only,
    read_frames,
    read_or_empty,
)
from civiframe.sources.sinks import (
    BUCKET,
    BUCKETS,
    bucket_of,
    full_reload,
    in_buckets,
    mark_replayed,
    replace_day,
    replace_touched,
)

NUMBERED = ("id", "year", "month", "day")


def analyse(
    frames: DataFrame,
    parameters: DataFrame,
    steps: DataFrame,
    inserted_at: Column,
    history_columns: Iterable[str] = (),
) -> DataFrame:
    """Frames to long measures. ``history_columns`` are the leaves that may hold past
    values for some sensor; ``steps`` says for which."""
    flat = explode_history(expand_data(frames), history_columns, steps)
    return melt_measures(flat, parameters, inserted_at)


def enrich(measures: DataFrame, referential: DataFrame) -> DataFrame:
    """Nature and unit of each measure, valid at its time; unknown measures drop out."""
    versions = referential.select(
        F.col("deveui").alias("_deveui"), F.col("dataparameter").alias("_name"),
        "enabledon", "disabledon", "measurenatureid", "unitid",
    )
    joined = interval_join(
        measures, versions, [("deveui", "_deveui"), ("name", "_name")], "tramedate",
        "enabledon", "disabledon", how="inner", closed=False,
    )
    return joined.select(
        "id", "deveui", "enabledon", "tramedate", "name", "value",
        F.col("insertedDate").alias("inserteddate"), "measurenatureid", "unitid",
        "year", "month", "day",
    )


def daily_plan(
    frames: DataFrame,
    sensors: DataFrame,
    parameters: DataFrame,
    referential: DataFrame,
    date: str,
    inserted_at: Column,
    history_columns: Iterable[str] = (),
) -> DataFrame:
    steps = referential.select("deveui", "dataparameter", "step")
    measures = analyse(known_only(frames, sensors), parameters, steps, inserted_at, history_columns)
    return with_technical_key(stamp_day(enrich(measures, referential), date), *NUMBERED)


def sensors_without_measures(frames: DataFrame, result: DataFrame) -> DataFrame:
    """Sensors that sent frames but gave no measure (wrong parameters or referential)."""
    return frames.select("deveui").distinct().join(result.select("deveui"), "deveui", "left_anti")


def replay_days(due: DataFrame, run_date: str) -> DataFrame:
    """Days to read again per sensor: from its start to its end, or to the run date;
    a sensor whose range is empty gives no row."""
    start = F.to_date("enabledon")
    end = F.coalesce(F.to_date("disabledon"), F.to_date(F.lit(run_date)))
    return due.select("deveui", F.explode(days_between(start, end)).alias("day_date"))


def frames_to_replay(frames: DataFrame, days: DataFrame) -> DataFrame:
    """Frames of the wanted days. Frame and day tables hash on (sensor, day)."""
    frame_day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    wanted = days.withColumnRenamed("deveui", "_deveui")
    return frames.join(
        wanted, (F.col("deveui") == F.col("_deveui")) & (frame_day == F.col("day_date")), "left_semi"
    )


def replay_plan(
    frames: DataFrame,
    sensors: DataFrame,
    parameters: DataFrame,
    referential: DataFrame,
    run_date: str,
    inserted_at: Column,
    history_columns: Iterable[str] = (),
) -> DataFrame:
    """Measures of all sensors due for replay; rows keep their own day."""
    days = replay_days(sensors_to_replay(sensors), run_date)
    steps = referential.select("deveui", "dataparameter", "step")
    measures = analyse(
        frames_to_replay(frames, days), parameters, steps, inserted_at, history_columns
    )
    return with_technical_key(enrich(measures, referential), *NUMBERED)


def outside_replay(stored: DataFrame, days: DataFrame) -> DataFrame:
    """Stored measures outside the replayed (sensor, day) pairs."""
    stored_day = F.make_date(*[F.col(c).cast("int") for c in ("year", "month", "day")])
    gone = days.withColumnRenamed("deveui", "_deveui")
    return stored.join(
        gone, (F.col("deveui") == F.col("_deveui")) & (stored_day == F.col("day_date")), "left_anti"
    )


def run_daily(
    spark: SparkSession, base: str, target: str, date: str, sensors: DataFrame,
    parameters: DataFrame, referential: DataFrame, inserted_at: Column, schema: T.StructType,
    history_columns: Iterable[str] = (), report: str | None = None, buckets: int = BUCKETS,
) -> None:
    """The day's frames (their folder alone is opened, under a given schema) to the target's
    day, in buckets of the sensor. A day without measures leaves the target alone. ``report``
    names a table that gets the day's sensors without a measure, none included."""
    with Staged(spark) as work:
        frames = read_or_empty(spark, lambda: read_frames(spark, day_folder(base, date), schema, base=base), schema)
        plan = daily_plan(frames, sensors, parameters, referential, date, inserted_at, history_columns)
        measures = work.put(plan, "measures")
        if not measures.isEmpty():
            replace_day(in_buckets(measures, "deveui", buckets), target, date, BUCKET)
        if report:
            silent = sensors_without_measures(known_only(frames, sensors), measures)
            replace_day(stamp_day(silent, date), report, date)


def run_replay(
    spark: SparkSession, frames: DataFrame, target: str, sensors: DataFrame, sensors_target: str,
    parameters: DataFrame, referential: DataFrame, run_date: str, inserted_at: Column,
    history_columns: Iterable[str] = (), buckets: int = BUCKETS,
) -> None:
    """Replay every due sensor, replace its days in the target, then mark it. Of each day only
    the buckets of due sensors are read and written. Nothing is marked when the replacement
    fails, so the next run starts over. Frames of days that lack columns come as
    ``union_days`` of ``fill_day_columns``."""
    with Staged(spark) as work:
        due = work.put(sensors_to_replay(sensors), "due")
        days = replay_days(due, run_date)
        first, last = days.agg(F.min("day_date"), F.max("day_date")).first()
        if first is not None:
            measures = replay_plan(
                frames.where(between_dates(str(first), str(last))),
                sensors, parameters, referential, run_date, inserted_at, history_columns,
            )
            touched = days.select(
                F.year("day_date").alias("year"), F.month("day_date").alias("month"),
                F.dayofmonth("day_date").alias("day"), bucket_of(F.col("deveui"), buckets).alias("bucket"),
            )
            replace_touched(
                spark, in_buckets(measures, "deveui", buckets), target, touched, lambda stored: outside_replay(stored, days)
            )
        marked = work.put(mark_replayed(sensors, due, run_date), "marked")
        full_reload(marked, sensors_target)
