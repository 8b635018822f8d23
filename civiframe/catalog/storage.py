"""Sources and sinks: each query writes derived rows to the shared folder and reads
them back through the operator under test."""

import datetime

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.registry import iso_text, query, seconds_text
from civiframe.config import TRAFFIC, Field, TableSpec
from civiframe.functions.dates import week_of_month
from civiframe.session import work_path
from civiframe.sources import readers, sinks

_EVENT_SQL = "event_id, user_id, event_type, value"


def _by_day(t):
    text = F.col("ts").cast("string")
    return t.events.select(
        "event_id", "user_id", "event_type", "value",
        F.substring(text, 1, 4).alias("year"), F.substring(text, 6, 2).alias("month"),
        F.substring(text, 9, 2).alias("day"),
    )


def _stored_days(t, name):
    path = work_path(t.spark, name)
    sinks.replace_partition(_by_day(t), path)
    return path


@query(
    "partition_scan",
    f"""select 'day' as scope, {_EVENT_SQL} from events where strftime(ts, '%Y-%m-%d') = '2024-01-07'
    union all select 'month' as scope, {_EVENT_SQL} from events where strftime(ts, '%Y-%m') = '2024-01'""",
)
def _partition_scan(t):
    stored = t.spark.read.orc(_stored_days(t, "scan"))
    day = stored.where(readers.on_date("2024-01-07")).withColumn("scope", F.lit("day"))
    month = stored.where(readers.on_date("2024-01")).withColumn("scope", F.lit("month"))
    return day.unionByName(month).select("scope", "event_id", "user_id", "event_type", "value")


@query(
    "partition_scan_week",
    f"select {_EVENT_SQL} from events where day(ts) between 8 and 14",
)
def _partition_scan_week(t):
    path = work_path(t.spark, "scan-week")
    weekly = _by_day(t).withColumn("week", week_of_month(F.col("day").cast("int"))).drop("day")
    sinks.replace_partition(weekly, path, sinks.WEEK)
    stored = t.spark.read.orc(path).where(readers.in_week_of("2024-01-10"))
    return stored.select("event_id", "user_id", "event_type", "value")


@query(
    "csv_schema_scan",
    f"""with {S.TRAFFIC_RAW} select datetime, predefinedLocationReference as "predefinedLocationReference",
      averageVehicleSpeed as "averageVehicleSpeed", travelTime as "travelTime",
      travelTimeReliability as "travelTimeReliability", trafficStatus as "trafficStatus" from traffic_raw""",
)
def _csv_schema_scan(t):
    path = work_path(t.spark, "csv-schema")
    S.traffic_raw(t).write.options(header=False, sep=";", compression="gzip").csv(path)
    return readers.read_csv_schema(t.spark, path, TRAFFIC)


_TEXT_SPEC = TableSpec(
    "customers", (Field("code", "int"), Field("nom"), Field("solde", "double")), delimiter="|",
    encoding="ISO-8859-1",
)


@query(
    "csv_config_scan",
    "select cast(c_custkey as varchar) as code, c_name || ' é' as nom, cast(c_acctbal as varchar) as solde from customer",
)
def _csv_config_scan(t):
    path = work_path(t.spark, "csv-config")
    rows = t.customer.select(
        F.col("c_custkey").cast("string").alias("code"),
        F.concat("c_name", F.lit(" é")).alias("nom"),
        F.col("c_acctbal").cast("string").alias("solde"),
    )
    rows.write.options(header=True, sep="|", encoding="ISO-8859-1").csv(path)
    return readers.read_csv_config(t.spark, path, _TEXT_SPEC)


@query("orc_scan", "select c_custkey, c_name, c_acctbal, c_nationkey from customer where c_acctbal > 0")
def _orc_scan(t):
    path = work_path(t.spark, "orc")
    sinks.full_reload(t.customer, path)
    stored = readers.read_table(t.spark, path, "orc")
    return stored.where("c_acctbal > 0").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")


@query("orc_recursive_scan", f"select {_EVENT_SQL} from events")
def _orc_recursive_scan(t):
    """ORC and CSV copies below one folder, in folders that are no partitions."""
    path = work_path(t.spark, "mixed")
    events = t.events.select("event_id", "user_id", "event_type", "value")
    for part in ("click", "view"):
        sinks.write_dual(events.where(F.col("event_type") == part), f"{path}/{part}")
    sinks.write_dual(events.where(~F.col("event_type").isin("click", "view")), f"{path}/rest/deep")
    return readers.read_table(t.spark, path, "orc_below")


@query(
    "json_scan",
    """select 'S' || user_id as deveui, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00' as "timestamp",
       event_type as kind, value, cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as counter from events""",
)
def _json_scan(t):
    path = work_path(t.spark, "json")
    frames = t.events.select(
        F.concat(F.lit("S"), "user_id").alias("deveui"),
        F.concat(iso_text(F.col("ts")), F.lit("+01:00")).alias("timestamp"),
        F.struct(
            F.col("event_type").alias("kind"), "value",
            F.struct(F.get_json_object("props", "$.k").cast("long").alias("counter")).alias("status"),
        ).alias("data"),
    )
    frames.write.json(path)
    stored = readers.read_frames(t.spark, path, multi_line=False)
    return stored.select(
        "deveui", "timestamp", "data.kind", "data.value", F.col("data.status.counter").alias("counter")
    )


@query(
    "empty_fallback",
    "select n_nationkey, n_name, count(c_custkey) as n from nation join customer on c_nationkey = n_nationkey group by all",
)
def _empty_fallback(t):
    """A missing day adds nothing: its typed empty frame joins the stored rows."""
    missing = readers.read_or_empty(
        t.spark, lambda: t.spark.read.orc(work_path(t.spark, "absent")), t.customer.schema
    )
    customers = t.customer.unionByName(missing)
    joined = customers.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_nationkey", "n_name").agg(F.count("c_custkey").alias("n"))


def _snapshots(t, base):
    """Two customer snapshots: the later one lacks members with a negative balance."""
    for day, rows in (("01", t.customer), ("02", t.customer.where("c_acctbal >= 0"))):
        moment = datetime.datetime(2024, 1, int(day), 12)
        sinks.write_snapshot(rows, base, f"year=2024/month=01/day={day}/orc", moment)


@query("latest_snapshot", "select c_custkey, c_name, c_acctbal from customer where c_acctbal >= 0")
def _latest_snapshot(t):
    base = work_path(t.spark, "snapshots")
    _snapshots(t, base)
    return readers.read_latest(t.spark, base).select("c_custkey", "c_name", "c_acctbal")


@query("dated_snapshot", "select c_custkey, c_name, c_acctbal from customer")
def _dated_snapshot(t):
    base = work_path(t.spark, "dated")
    stamped = [
        rows.withColumns({"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit(day)})
        for day, rows in (("01", t.customer), ("02", t.customer.where("c_acctbal >= 0")))
    ]
    sinks.append_day(stamped[0].unionByName(stamped[1]), base)
    return readers.read_dated(t.spark, base, "2024-01-01").select("c_custkey", "c_name", "c_acctbal")


@query(
    "sink_partition_roundtrip",
    """select event_id, event_type, value, cast(day(ts) as integer) as day, c.copy from events,
       (select unnest(['orc', 'csv']) as copy) c""",
)
def _sink_partition_roundtrip(t):
    base, csv_base = work_path(t.spark, "append"), work_path(t.spark, "append-csv")
    rows = _by_day(t).drop("user_id").hint("rebalance", "year", "month", "day")
    sinks.append_with_csv(rows, base, csv_base)
    orc = t.spark.read.orc(base).withColumn("copy", F.lit("orc"))
    schema = "event_id LONG, event_type STRING, value DOUBLE, year INT, month INT, day INT"
    csv = t.spark.read.schema(schema).options(header=True, sep=";").csv(csv_base)
    both = orc.unionByName(csv.withColumn("copy", F.lit("csv")))
    return both.select("event_id", "event_type", "value", "day", "copy")


@query(
    "sink_dual_roundtrip",
    """select o_orderkey, o_totalprice, c.copy from orders, (select unnest(['orc', 'csv']) as copy) c""",
)
def _sink_dual_roundtrip(t):
    base = work_path(t.spark, "dual-out")
    sinks.write_dual(t.orders.select("o_orderkey", "o_totalprice"), base, files=2)
    csv = t.spark.read.schema("o_orderkey LONG, o_totalprice DOUBLE").options(header=True, sep=";").csv(f"{base}/csv")
    orc = t.spark.read.orc(f"{base}/orc").withColumn("copy", F.lit("orc"))
    return orc.unionByName(csv.withColumn("copy", F.lit("csv")))


@query(
    "schema_patch",
    "select c_custkey, cast(c_nationkey as double) as c_nationkey from customer",
)
def _schema_patch(t):
    base, patched = work_path(t.spark, "patch"), work_path(t.spark, "patched")
    stored = t.customer.select("c_custkey", "c_nationkey").withColumns(
        {"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("01")}
    )
    sinks.append_day(stored, base)
    sinks.patch_column(t.spark, base, "2024-01-01", "c_nationkey", "double", patched)
    return t.spark.read.orc(f"{patched}/orc").select("c_custkey", "c_nationkey")


@query(
    "replace_partition",
    """select event_id, event_type, value * 2 as value, cast(day(ts) as integer) as day from events
         where day(ts) = 7 and event_type <> 'view'
       union all select event_id, event_type, value, cast(day(ts) as integer) from events where day(ts) <> 7""",
)
def _replace_partition(t):
    """Day 7 comes again with other values and fewer rows, twice."""
    path = _stored_days(t, "replace")
    again = _by_day(t).where((F.col("day") == "07") & (F.col("event_type") != "view"))
    for _ in range(2):
        sinks.replace_partition(again.withColumn("value", F.col("value") * 2), path)
    return t.spark.read.orc(path).select("event_id", "event_type", "value", "day")


@query(
    "replace_range",
    """select event_id, event_type, value, cast(day(ts) as integer) as day from events
         where not (event_type = 'click' and day(ts) between 5 and 9)
       union all select event_id, event_type, -value, cast(day(ts) as integer) from events
         where event_type = 'click' and day(ts) between 5 and 8""",
)
def _replace_range(t):
    """The clicks of days 5 to 9 are replaced in their buckets; the new ones end on day 8."""
    path = work_path(t.spark, "range")
    sinks.replace_partition(sinks.in_buckets(_by_day(t), "event_type", 2), path, sinks.BUCKET)
    new = _by_day(t).where((F.col("event_type") == "click") & F.col("day").between("05", "08"))
    sinks.replace_key_range(
        t.spark, new.withColumn("value", -F.col("value")), path, "2024-01-05", "2024-01-09",
        "event_type", "click", buckets=2,
    )
    return t.spark.read.orc(path).select("event_id", "event_type", "value", "day")


@query(
    "replace_day",
    """select event_id, event_type, -value as value, cast(day(ts) as integer) as day from events
         where day(ts) = 7 and event_type <> 'view'
       union all select event_id, event_type, value, cast(day(ts) as integer) from events where day(ts) not in (7, 8)""",
)
def _replace_day(t):
    """Two named days of a table with buckets come again: one with fewer rows, one without any."""
    path = work_path(t.spark, "named-day")
    rows = sinks.in_buckets(_by_day(t), "event_type", 2)
    sinks.replace_partition(rows, path, sinks.BUCKET)
    again = rows.where((F.col("day") == "07") & (F.col("event_type") != "view")).withColumn("value", -F.col("value"))
    sinks.replace_day(again, path, "2024-01-07", sinks.BUCKET)
    sinks.replace_day(rows.where("false"), path, "2024-01-08", sinks.BUCKET)
    return t.spark.read.orc(path).select("event_id", "event_type", "value", "day")


@query(
    "sink_full_reload",
    """select o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as day_text, c.target from orders,
       (select unnest(['first', 'second']) as target) c""",
)
def _sink_full_reload(t):
    """Published twice: the second load replaces the first in both targets."""
    targets = {name: work_path(t.spark, name) for name in ("first", "second")}
    rows = t.orders.select("o_orderkey", "o_custkey", seconds_text(F.col("o_orderdate")).alias("day_text"))
    for frame in (rows.where("o_custkey >= 0"), rows):
        sinks.publish_to(frame, reloads=list(targets.values()))
    stored = [t.spark.read.orc(p).withColumn("target", F.lit(n)) for n, p in targets.items()]
    return stored[0].unionByName(stored[1])
