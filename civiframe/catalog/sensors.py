"""Sensor frames: flatten, history, melt, enrichment, replay."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.registry import query
from civiframe.operators import melt
from civiframe.plans import lora
from civiframe.operators.clean import with_technical_key
from civiframe.session import work_path
from civiframe.sources import readers
from civiframe.sources.readers import known_only, scan_days
from civiframe.sources.sinks import BUCKET, in_buckets, mark_replayed, replace_partition

INSERTED = "2024-02-01T00:00:00+01:00"
RUN_DATE = "2024-01-20"


def _inserted():
    return F.lit(INSERTED)


@query(
    "flatten_nested",
    f"""with {S.FRAMES} select deveui, "timestamp", year, month, day, kind, k as status_counter,
      cast(value as varchar) || 'kWh' as "EAP", 't1,t2' as temperatures_name,
      round(value + value / 2, 3) as temperatures_sum from frames""",
)
def _flatten_nested(t):
    flat = melt.expand_data(S.frames(t))
    total = F.aggregate(F.flatten("temperatures_values"), F.lit(0.0), lambda a, b: a + b)
    return flat.select(
        "deveui", "timestamp", "year", "month", "day", "kind", "status_counter", "EAP",
        F.array_join("temperatures_name", ",").alias("temperatures_name"),
        F.round(total, 3).alias("temperatures_sum"),
    )


_HISTORY_SQL = f"""with {S.FRAMES}, steps as (select distinct deveui from frames where user_id % 2 = 0),
  stepped as (select * from frames where user_id % 2 = 0),
  exploded as (
    select deveui, strftime(ts - to_seconds(cast(p * 3600 as integer)), '%Y-%m-%dT%H:%M:%S') || '+01:00' as "timestamp",
           case p when 0 then value when 1 then value / 2 else cast(k as double) end as past
    from stepped, range(3) r(p))"""


@query(
    "history_explode",
    f"""{_HISTORY_SQL}
    select e.deveui, e."timestamp", f.kind, round(e.past, 3) as past, 1 as n_values from exploded e
      left join stepped f on f.deveui = e.deveui and f."timestamp" = e."timestamp"
    union all
    select deveui, "timestamp", kind, round(value, 3), 3 from frames where user_id % 2 = 1""",
)
def _history_explode(t):
    steps = S.sensor_ids(t).where(F.col("user_id") % 2 == 0).select(
        "deveui", F.lit("past").alias("dataparameter"), F.lit(3600).alias("step")
    )
    flat = melt.expand_data(S.frames(t)).select("deveui", "timestamp", "kind", "past")
    exploded = melt.explode_history(flat, "past", steps, each_copy=True)
    return exploded.select(
        "deveui", "timestamp", "kind", F.round(F.col("past")[0], 3).alias("past"),
        F.size("past").alias("n_values"),
    )


@query(
    "history_columns",
    f"""with {S.FRAMES}, stepped as (select * from frames where user_id % 2 = 0),
  dated as (
    select deveui, day, strftime(ts - to_seconds(cast(p * 3600 as integer)), '%Y-%m-%dT%H:%M:%S') || '+01:00' as "timestamp",
           case p when 0 then value when 1 then value / 2 else cast(k as double) end as past, cast(null as double) as older
    from stepped, range(3) r(p)
    union all
    select deveui, day, strftime(ts - to_seconds(cast(p * 1800 as integer)), '%Y-%m-%dT%H:%M:%S') || '+01:00', null,
           case p when 0 then value * 3 else cast(k as double) end
    from stepped, range(2) r(p)),
  partners as (select distinct deveui, "timestamp", kind from stepped)
    select d.deveui, d."timestamp", d.day, p.kind, round(d.past, 3) as past, round(d.older, 3) as older
    from dated d left join partners p using (deveui, "timestamp")
    union all
    select deveui, "timestamp", day, kind, round(value, 3), round(value * 3, 3) from frames where user_id % 2 = 1""",
)
def _history_columns(t):
    """Two history columns with steps of their own, and the day of the frame that brought each value."""
    own = S.sensor_ids(t).where(F.col("user_id") % 2 == 0).select("deveui")
    steps = own.select("deveui", F.lit("past").alias("dataparameter"), F.lit(3600).alias("step")).unionAll(
        own.select("deveui", F.lit("older"), F.lit(1800))
    )
    older = F.array(F.col("past")[0] * 3, F.col("past")[2])
    flat = melt.expand_data(S.frames(t)).select("deveui", "timestamp", "year", "month", "day", "kind", "past", older.alias("older"))
    exploded = melt.explode_history(flat, ["past", "older"], steps)
    return exploded.select(
        "deveui", "timestamp", "day", "kind", F.round(F.col("past")[0], 3).alias("past"), F.round(F.col("older")[0], 3).alias("older")
    )


_MELTED_COLUMNS = """deveui, tramedate, name, round(cast(cast(v as float) as double), 3) as value, year, month, day,
  deveui || ' | ' || tramedate || ' | ' || name as id"""


def _rounded(df):
    return df.withColumn("value", F.round(F.col("value").cast("double"), 3))


@query("measure_melt", f"with {S.FRAMES}, {S.MEASURES} select {_MELTED_COLUMNS} from measures")
def _measure_melt(t):
    flat = melt.expand_data(S.frames(t))
    return _rounded(melt.melt_measures(flat, S.parameters(t), _inserted())).drop("insertedDate")


@query("variant_melt", f"with {S.FRAMES}, {S.MEASURES} select {_MELTED_COLUMNS} from measures")
def _variant_melt(t):
    """Days of two structures in multi-line files, read by one plan without inference or schema: on odd days
    numbers stand for texts, a text for an object, a leaf is missing and another is deeper than all others.
    The number of files grows with the frames, so that a file does not."""
    path = work_path(t.spark, "variant-frames")
    parts = max(2, t.events.count() // 300_000)
    frames = S.frames(t).withColumn("part", F.pmod(F.xxhash64("deveui", "timestamp"), F.lit(parts)))
    odd = F.col("day").cast("int") % 2 == 1
    other = F.struct(
        F.col("data.kind").alias("kind"), F.lit("off").alias("status"),
        F.regexp_replace("data.EAP", "kWh", "").cast("double").alias("EAP"), F.col("data.temperatures").alias("temperatures"),
        F.struct(F.struct(F.array(F.lit(1)).alias("b")).alias("a")).alias("diagnosis"),
    )
    for rows, data in ((frames.where(~odd), F.col("data")), (frames.where(odd), other)):
        frame = F.struct("deveui", "timestamp", data.alias("data"))
        files = rows.groupBy("year", "month", "day", "part").agg(F.to_json(F.collect_list(frame), {"pretty": "true"}).alias("value"))
        files.write.mode("append").partitionBy("year", "month", "day", "part").text(path)
    stored = readers.read_variant_frames(t.spark, path)
    days = {c: F.lpad(F.col(c).cast("string"), 4 if c == "year" else 2, "0") for c in ("year", "month", "day")}
    return _rounded(melt.melt_variants(stored.withColumns(days), S.parameters(t), _inserted())).drop("insertedDate")


@query(
    "measure_name_prefix",
    """select event_id, case when event_type = 'error' then '' else 'label:' end
       || case when event_type = 'view' then '' else 'k1:' || event_type || ':' end || user_id as name from events""",
)
def _measure_name_prefix(t):
    empty = F.array().cast("array<string>")
    kind = F.col("event_type")
    label = F.when(kind == "error", empty).otherwise(F.array(F.lit("label")))
    prefix = F.when(kind == "view", empty).otherwise(F.array(F.lit("k1"), kind))
    name = melt.prefixed_name(label, prefix, F.col("user_id").cast("string"))
    return t.events.select("event_id", name.alias("name"))


@query(
    "known_sensor_semi",
    f"""with {S.FRAMES}, {S.SENSOR_IDS}, {S.SENSORS}
    select deveui, count(*) as n from frames where deveui in (select deveui from sensors where disabledon is null)
    group by deveui""",
)
def _known_sensor_semi(t):
    known = S.sensors(t).where(F.col("disabledon").isNull())
    return known_only(S.frames(t), known).groupBy("deveui").agg(F.count("*").alias("n"))


_ENRICHED = """enriched as (select m.*, r.enabledon, r.measurenatureid, r.unitid
  from measures m join referential r on r.deveui = m.deveui and r.dataparameter = m.name
    and m.tramedate >= r.enabledon and (r.disabledon is null or m.tramedate < r.disabledon))"""
_ENRICHED_COLUMNS = """deveui || ' | ' || tramedate || ' | ' || name as id, deveui, enabledon, tramedate, name,
  round(cast(cast(v as float) as double), 3) as value, measurenatureid, unitid"""


@query(
    "asof_measure_join",
    f"""with {S.FRAMES}, {S.MEASURES}, {S.REFERENTIAL}, {_ENRICHED}
    select {_ENRICHED_COLUMNS}, year, month, day from enriched""",
)
def _asof_measure_join(t):
    measures = melt.melt_measures(melt.expand_data(S.frames(t)), S.parameters(t), _inserted())
    return _rounded(lora.enrich(measures, S.referential(t))).drop("inserteddate")


@query(
    "pipe_lora",
    f"""with {S.FRAMES}, {S.MEASURES}, {S.REFERENTIAL}, {S.SENSOR_IDS}, {S.SENSORS}, {_ENRICHED},
    kept as (select {_ENRICHED_COLUMNS} from enriched where deveui in (select deveui from sensors))
    select *, '2024' as year, '01' as month, '10' as day, id || '_2024_01_10' as technical_key from kept""",
)
def _pipe_lora(t):
    plan = lora.daily_plan(
        S.frames(t), S.sensors(t), S.parameters(t), S.referential(t), "2024-01-10", _inserted(), ["past"]
    )
    return _rounded(plan).drop("inserteddate")


# -- replay ------------------------------------------------------------------------------------

_DUE = """due as (select * from sensors where updatedon >= reprisedon or (updatedon is not null and reprisedon is null))"""
_DAYS = f"""days as (select deveui, cast(d as date) as day_date from (
  select deveui, unnest(range(cast(enabledon as timestamp), cast(coalesce(disabledon, '{RUN_DATE}') as timestamp), interval 1 day)) as d
  from due))"""
_REPLAY = f"with {S.FRAMES}, {S.MEASURES}, {S.REFERENTIAL}, {S.SENSOR_IDS}, {S.SENSORS}, {_DUE}, {_DAYS}, {_ENRICHED}"


@query(
    "replay_candidates",
    f"with {S.SENSOR_IDS}, {S.SENSORS}, {_DUE} select deveui, enabledon, disabledon, updatedon, reprisedon from due",
)
def _replay_candidates(t):
    return melt.sensors_to_replay(S.sensors(t))


@query(
    "replay_dates",
    f"with {S.SENSOR_IDS}, {S.SENSORS}, {_DUE}, {_DAYS} select deveui, cast(day_date as varchar) as day_date from days",
)
def _replay_dates(t):
    days = lora.replay_days(melt.sensors_to_replay(S.sensors(t)), RUN_DATE)
    return days.withColumn("day_date", F.col("day_date").cast("string"))


@query(
    "replay_scan",
    """select 'S' || user_id as deveui, strftime(ts, '%d') as day, event_type as kind,
         case when event_type <> 'view' then value end as extra, count(*) as n
       from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-13' group by all""",
)
def _replay_scan(t):
    """Days whose frames lack a column are read together with those that have it."""
    frames = S.frames(t).select("deveui", "year", "month", "day", F.col("data.kind").alias("kind"),
                                F.regexp_replace("data.EAP", "kWh", "").cast("double").alias("extra"))
    window = scan_days(frames, "2024-01-05", "2024-01-12")
    with_extra = window.where(F.col("kind") != "view")
    without = window.where(F.col("kind") == "view").drop("extra")
    both = with_extra.unionByName(without, allowMissingColumns=True)
    return both.groupBy("deveui", "day", "kind", "extra").agg(F.count("*").alias("n"))


@query(
    "mark_replayed",
    f"""with {S.SENSOR_IDS}, {S.SENSORS}, {_DUE} select deveui, enabledon, disabledon, updatedon,
      case when deveui in (select deveui from due) then '{RUN_DATE}' else reprisedon end as reprisedon from sensors""",
)
def _mark_replayed(t):
    sensors = S.sensors(t)
    return mark_replayed(sensors, melt.sensors_to_replay(sensors), RUN_DATE)


@query(
    "pipe_lora_replay",
    f"""{_REPLAY}, kept as (select e.* from enriched e join days d on d.deveui = e.deveui and d.day_date = cast(e.ts as date))
    select {_ENRICHED_COLUMNS}, year, month, day,
      deveui || ' | ' || tramedate || ' | ' || name || '_' || year || '_' || month || '_' || day as technical_key from kept""",
)
def _pipe_lora_replay(t):
    plan = lora.replay_plan(
        S.frames(t), S.sensors(t), S.parameters(t), S.referential(t), RUN_DATE, _inserted()
    )
    return _rounded(plan).drop("inserteddate")


@query(
    "pipe_lora_replay_stored",
    f"""{_REPLAY}, stored as (select e.*, d.deveui is not null as again from enriched e
      left join days d on d.deveui = e.deveui and d.day_date = cast(e.ts as date))
    select {_ENRICHED_COLUMNS.replace('cast(cast(v as float) as double)', 'case when again then cast(cast(v as float) as double) else 0.0 end')},
      year, month, day, deveui || ' | ' || tramedate || ' | ' || name || '_' || year || '_' || month || '_' || day as technical_key
    from stored""",
)
def _pipe_lora_replay_stored(t):
    """The table holds every measure as zero; the replay brings those of due sensors' days back."""
    frames, parameters, referential = S.frames(t), S.parameters(t), S.referential(t)
    target, sensors_target = work_path(t.spark, "measures"), work_path(t.spark, "sensors")
    measures = lora.enrich(melt.melt_measures(melt.expand_data(frames), parameters, _inserted()), referential)
    stored = with_technical_key(measures, *lora.NUMBERED).withColumn("value", F.lit(0).cast(measures.schema["value"].dataType))
    replace_partition(in_buckets(stored, "deveui", 2), target, BUCKET)
    lora.run_replay(
        t.spark, frames, target, S.sensors(t), sensors_target, parameters, referential, RUN_DATE, _inserted(), buckets=2
    )
    days = {c: F.lpad(F.col(c).cast("string"), 4 if c == "year" else 2, "0") for c in ("year", "month", "day")}
    return _rounded(t.spark.read.orc(target)).withColumns(days).drop("inserteddate", "bucket")
