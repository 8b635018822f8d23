"""Scalar expressions over whole tables."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.registry import (
    iso_text,
    query,
    seconds_text,
    sql_paris_epoch,
    sql_surrogate_key,
)
from civiframe.functions import dates, keys
from civiframe.functions.flow import pick_frequency, plausible_weight
from civiframe.functions.geo import conic_constants, project_point
from civiframe.functions.text import extract_number
from civiframe.operators.weights import with_first_flow


@query(
    "week_of_month",
    """select o_orderkey, case when day(o_orderdate) <= 7 then '01' when day(o_orderdate) <= 14 then '02'
       when day(o_orderdate) <= 21 then '03' when day(o_orderdate) <= 28 then '04' else '05' end as week
       from orders""",
)
def _week_of_month(t):
    return t.orders.select("o_orderkey", dates.week_of_month(F.dayofmonth("o_orderdate")).alias("week"))


@query(
    "local_timestamp",
    """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as local_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') as standard_text from events""",
)
def _local_timestamp(t):
    iso = F.concat(iso_text(F.col("ts")), F.lit("+02:00"))
    return t.events.select(
        "event_id",
        seconds_text(dates.local_timestamp(iso)).alias("local_time"),
        dates.iso_to_standard_text(iso).alias("standard_text"),
    )


@query(
    "floor_quarter",
    """select event_id, strftime(time_bucket(interval 15 minutes, ts), '%Y-%m-%d %H:%M:%S') as quarter
       from events""",
)
def _floor_quarter(t):
    return t.events.select(
        "event_id", seconds_text(dates.floor_minutes(F.col("ts"), 15)).alias("quarter")
    )


@query(
    "compact_timestamp",
    f"""with {S.WEIGHINGS_RAW}
    select Date_de_la_levee as d, Heure_de_la_levee as h,
           strftime(strptime(Date_de_la_levee || lpad(Heure_de_la_levee, 6, '0'), '%Y%m%d%H%M%S'),
                    '%Y-%m-%d %H:%M:%S') as local_time
    from weighings_raw""",
)
def _compact_timestamp(t):
    d, h = F.col("Date_de_la_levee"), F.col("Heure_de_la_levee")
    return S.weighings_raw(t).select(
        d.alias("d"), h.alias("h"), seconds_text(dates.compact_local(d, h)).alias("local_time")
    )


@query(
    "compact_timestamp_utc",
    f"""with {S.WEIGHINGS_RAW},
    timed as (select Date_de_la_levee as d, Heure_de_la_levee as h,
      cast(strptime(Date_de_la_levee || lpad(Heure_de_la_levee, 6, '0'), '%Y%m%d%H%M%S') as timestamp) as local_ts
      from weighings_raw)
    select d, h, {sql_paris_epoch('local_ts')} as epoch_seconds from timed""",
)
def _compact_timestamp_utc(t):
    d, h = F.col("Date_de_la_levee"), F.col("Heure_de_la_levee")
    return S.weighings_raw(t).select(
        d.alias("d"), h.alias("h"),
        F.unix_seconds(dates.compact_instant(d, h)).alias("epoch_seconds"),
    )


_US_TEXT = """us_text as (select o_orderkey,
  case o_orderstatus when 'O' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    when 'F' then month(o_orderdate) || '/' || day(o_orderdate) || '/' || strftime(o_orderdate, '%y')
    else strftime(o_orderdate, '%m/%d/%Y') end as raw, o_orderdate from orders)"""


@query(
    "us_date",
    f"""with {_US_TEXT} select o_orderkey, raw,
    case when strftime(o_orderdate, '%Y') < '2000' and raw not like '%-%' and length(split_part(raw, '/', 3)) = 2
      then '20' || strftime(o_orderdate, '%y-%m-%d') || ' 00:00:00'
      else strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' end as day_text from us_text""",
)
def _us_date(t):
    day = F.col("o_orderdate")
    text = day.cast("string")
    year, month, dom = F.substring(text, 1, 4), F.substring(text, 6, 2), F.substring(text, 9, 2)
    short = F.concat_ws("/", F.month(day), F.dayofmonth(day), F.substring(year, 3, 2))
    raw = (
        F.when(F.col("o_orderstatus") == "O", seconds_text(day))
        .when(F.col("o_orderstatus") == "F", short)
        .otherwise(F.concat_ws("/", month, dom, year))
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).withColumn(
        "day_text", dates.us_date(F.col("raw"))
    )


@query(
    "surrogate_key",
    f"""with parts as (select c_custkey, cast(c_custkey as varchar) || '20220101' as a,
        c_name || '20220101' as b, coalesce(case when c_acctbal >= 0 then c_mktsegment end, 'null') || '20220225' as c
        from customer)
    select c_custkey, {sql_surrogate_key('a')} as key_of_number, {sql_surrogate_key('b')} as key_of_name,
           {sql_surrogate_key('c')} as key_of_optional from parts""",
)
def _surrogate_key(t):
    day = F.lit("20220101")
    optional = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey",
        keys.surrogate_key(F.col("c_custkey"), day).alias("key_of_number"),
        keys.surrogate_key(F.col("c_name"), day).alias("key_of_name"),
        keys.surrogate_key(optional, F.lit("20220225")).alias("key_of_optional"),
    )


@query(
    "technical_key",
    """select event_id, event_type || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '_' || strftime(ts, '%Y_%m')
       || '_' || case when day(ts) <= 7 then '01' when day(ts) <= 14 then '02' when day(ts) <= 21 then '03'
                      when day(ts) <= 28 then '04' else '05' end as technical_key
       from events""",
)
def _technical_key(t):
    text = F.col("ts").cast("string")
    key = keys.technical_key(
        F.col("event_type"), seconds_text(F.col("ts")), F.substring(text, 1, 4),
        F.substring(text, 6, 2), dates.week_of_month(F.dayofmonth("ts")),
    )
    return t.events.select("event_id", key.alias("technical_key"))


_MEASURED_SQL = """case l_returnflag when 'A' then cast(l_extendedprice as varchar) || 'kWh'
  when 'N' then 'T=' || cast(l_quantity as varchar) || ' C' else case l_linestatus when 'O' then 'no value'
  else cast(l_linenumber as varchar) || '-' || cast(l_linenumber as varchar) end end"""


@query(
    "extract_number",
    f"""with texts as (select l_orderkey, l_linenumber, {_MEASURED_SQL} as raw from lineitem),
    kept as (select *, regexp_replace(raw, '[^-.0-9]+', '', 'g') as k from texts)
    select l_orderkey, l_linenumber, raw,
           round(cast(case when k = '' then 0.0 else try_cast(k as float) end as double), 1) as number
    from kept""",
)
def _extract_number(t):
    line = F.col("l_linenumber").cast("string")
    raw = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.col("l_extendedprice").cast("string"), F.lit("kWh")))
        .when(
            F.col("l_returnflag") == "N",
            F.concat(F.lit("T="), F.col("l_quantity").cast("string"), F.lit(" C")),
        )
        .otherwise(
            F.when(F.col("l_linestatus") == "O", "no value").otherwise(F.concat(line, F.lit("-"), line))
        )
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw")).withColumn(
        "number", F.round(extract_number(F.col("raw")).cast("double"), 1)
    )


@query(
    "frequency_pick",
    """select p_partkey, case when p_brand = 'Brand#13' then null
         when p_type = 'LARGE' then p_size / 4.0 when p_type = 'ECONOMY' then cast(p_size % 3 as double)
         else 0.0 end as frequency from part""",
)
def _frequency_pick(t):
    kind = (
        F.when(F.col("p_type") == "LARGE", "Bac CS 360 l")
        .when(F.col("p_type") == "ECONOMY", "Bac PNM OM 240 l")
        .otherwise(F.col("p_type"))
    )
    cs = F.when(F.col("p_brand") != "Brand#13", F.col("p_size") / 4.0)
    return t.part.select(
        "p_partkey", pick_frequency(kind, F.col("p_size") % 3, cs).alias("frequency")
    )


@query(
    "flow_class",
    f"""with {S.WEIGHINGS_RAW}, {S.WEIGHED}, {S.CLASSIFIED}
    select code_puce, code_tournee, code_immat, categorie_recipient, type_flux, count(*) as n
    from classified group by all""",
)
def _flow_class(t):
    group = ["code_puce", "code_tournee", "code_immat", "categorie_recipient", "type_flux"]
    return with_first_flow(S.weighed(t)).groupBy(*group).agg(F.count("*").alias("n"))


@query(
    "weight_plausible",
    f"""with w as (select l_orderkey, l_linenumber, l_quantity * 6 - 10 as poids,
          case l_returnflag when 'A' then 'OM' when 'N' then 'CS' else
            case l_linestatus when 'O' then 'Verre' end end as flow from lineitem)
    select l_orderkey, l_linenumber, poids, flow, {S.PLAUSIBLE_SQL} as plausible from w""",
)
def _weight_plausible(t):
    flow = (
        F.when(F.col("l_returnflag") == "A", "OM")
        .when(F.col("l_returnflag") == "N", "CS")
        .when(F.col("l_linestatus") == "O", "Verre")
    )
    weights = t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") * 6 - 10).alias("poids"), flow.alias("flow")
    )
    return weights.withColumn("plausible", plausible_weight(F.col("poids"), F.col("flow")))


_K = conic_constants()
POSITION_SQL = "47.9 + (c_acctbal + 1000) / 27500 as latitude, 2.8 + c_nationkey / 62.5 + c_custkey % 97 / 9700.0 as longitude"


def sql_projected(latitude: str, longitude: str) -> tuple[str, str]:
    es = f"({_K['ecc']!r} * sin(radians({latitude})))"
    t = f"(tan(pi() / 4 - radians({latitude}) / 2) / pow((1 - {es}) / (1 + {es}), {_K['ecc'] / 2!r}))"
    r = f"({_K['radius']!r} * pow({t}, {_K['n']!r}))"
    theta = f"({_K['n']!r} * radians({longitude} - 3.0))"
    return f"1700000.0 + {r} * sin({theta})", f"7200000.0 + {_K['origin']!r} - {r} * cos({theta})"


def positions(customers):
    return customers.withColumns(
        {
            "latitude": 47.9 + (F.col("c_acctbal") + 1000) / 27500,
            "longitude": 2.8 + F.col("c_nationkey") / 62.5 + F.col("c_custkey") % 97 / 9700.0,
        }
    )


_X, _Y = sql_projected("latitude", "longitude")


@query(
    "project_point",
    f"""with positions as (select c_custkey, {POSITION_SQL} from customer)
    select c_custkey, round({_X}, 3) as x, round({_Y}, 3) as y from positions""",
)
def _project_point(t):
    x, y = project_point(F.col("latitude"), F.col("longitude"))
    return positions(t.customer).select("c_custkey", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))
