"""Road traffic: statistics per segment and quarter of an hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.config import TRAFFIC
from civiframe.functions.dates import local_timestamp
from civiframe.operators.clean import between_hours, rename, stamp_week, with_technical_key
from civiframe.operators.temporal import traffic_statistics
from civiframe.sources.readers import read_csv_schema, read_or_empty, week_folder
from civiframe.sources.sinks import WEEK, replace_partition

# Names of the analysed columns and the hours kept (exclusive bounds).
COLUMN_NAMES = {
    "datetime": "date",
    "predefinedLocationReference": "segment",
    "averageVehicleSpeed": "avgSpeed",
    "travelTime": "travelTime",
    "travelTimeReliability": "reliability",
    "trafficStatus": "status",
}
FIRST_HOUR, LAST_HOUR = 4, 22


def intake(raw: DataFrame, first: int = FIRST_HOUR, last: int = LAST_HOUR) -> DataFrame:
    """Renamed measures with local time, day hours only."""
    named = rename(raw, COLUMN_NAMES)
    return between_hours(named.withColumn("date", local_timestamp(F.col("date"))), "date", first, last)


def traffic_plan(raw: DataFrame, date: str, minutes: int = 15) -> DataFrame:
    stamped = stamp_week(traffic_statistics(intake(raw), minutes), date)
    return with_technical_key(stamped, "id", "start_time", "year", "month", "week")


def run_traffic(spark: SparkSession, base: str, target: str, date: str, minutes: int = 15) -> None:
    """The week of ``date``: read (its folder alone is opened), analyse, replace that week in
    the target. A week without measures leaves the target alone."""
    raw = read_or_empty(
        spark,
        lambda: read_csv_schema(spark, week_folder(base, date), TRAFFIC, base=base),
        TRAFFIC.schema(),
    )
    replace_partition(traffic_plan(raw.select(*TRAFFIC.names), date, minutes), target, WEEK)


