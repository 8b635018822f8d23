"""Municipal tables derived from the provided ones, in Spark and as SQL text.

No municipal table is provided; each stand-in covers a whole provided table and is
written twice, so that query and SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiframe.catalog.registry import Tables, iso_text, ntz
from civiframe.functions.dates import compact_instant
from civiframe.operators.joins import spread_left_join

# -- road traffic: one measure per event ------------------------------------------------

TRAFFIC_RAW = """traffic_raw as (
  select strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+02:00' as datetime,
         event_type as predefinedLocationReference,
         cast(floor(value) as integer) as averageVehicleSpeed,
         cast(user_id as integer) as travelTime,
         cast(regexp_extract(props, '([0-9]+)', 1) as integer) as travelTimeReliability,
         event_type as trafficStatus
  from events)"""


def traffic_raw(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(iso_text(F.col("ts")), F.lit("+02:00")).alias("datetime"),
        F.col("event_type").alias("predefinedLocationReference"),
        F.floor("value").cast("int").alias("averageVehicleSpeed"),
        F.col("user_id").cast("int").alias("travelTime"),
        F.get_json_object("props", "$.k").cast("int").alias("travelTimeReliability"),
        F.col("event_type").alias("trafficStatus"),
    )


# -- bins: one chip per part ---------------------------------------------------------------

VOLUMES = (1, 120, 140, 180, 240, 330, 340, 360, 400, 500, 660, 750, 770, 1000)

CATEGORY_SQL = """case p_type when 'ECONOMY' then 'Bacs ordures ménagères'
  when 'LARGE' then 'Bacs collecte sélective' when 'MEDIUM' then 'Bacs verre'
  when 'PROMO' then 'Bacs biodéchets' when 'SMALL' then 'Bacs carton' end"""
VOLUME_SQL = f"[{', '.join(map(str, VOLUMES))}][p_size % {len(VOLUMES)} + 1]"


def category():
    kind = F.col("p_type")
    return (
        F.when(kind == "ECONOMY", "Bacs ordures ménagères")
        .when(kind == "LARGE", "Bacs collecte sélective")
        .when(kind == "MEDIUM", "Bacs verre")
        .when(kind == "PROMO", "Bacs biodéchets")
        .when(kind == "SMALL", "Bacs carton")
    )


def volume():
    options = F.array(*[F.lit(v) for v in VOLUMES])
    return F.element_at(options, (F.col("p_size") % len(VOLUMES) + 1).cast("int"))


# three versions per chip, each 800 days long, touching; the last one open
BIN_VERSIONS = f"""bin_versions as (
  select p_partkey * 10 + v as id_bac, 'C' || p_partkey as chip, {CATEGORY_SQL} as categorie_recipient,
         {VOLUME_SQL} as litrage_recipient,
         timestamp '1995-01-01' + to_days(cast(p_size as integer)) + to_days(cast(v * 800 as integer)) as date_debut,
         case when v < 2 then timestamp '1995-01-01' + to_days(cast(p_size as integer)) + to_days(cast(v * 800 + 800 as integer)) end as date_fin
  from part, range(3) r(v))"""


def bin_versions(t: Tables) -> DataFrame:
    first = ntz("1995-01-01 00:00:00")
    return t.part.withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        (F.col("p_partkey") * 10 + F.col("v")).alias("id_bac"),
        F.concat(F.lit("C"), "p_partkey").alias("chip"),
        category().alias("categorie_recipient"),
        volume().alias("litrage_recipient"),
        (first + F.make_dt_interval(F.col("p_size") + F.col("v") * 800)).alias("date_debut"),
        F.when(
            F.col("v") < 2, first + F.make_dt_interval(F.col("p_size") + F.col("v") * 800 + 800)
        ).alias("date_fin"),
    )


# -- weighings: one per line item ------------------------------------------------------------

_SECONDS_SQL = "((l_orderkey * 37 + l_linenumber * 101) % 86400)"
_HHMMSS_SQL = (
    f"cast(({_SECONDS_SQL} // 3600) * 10000 + ({_SECONDS_SQL} % 3600 // 60) * 100"
    f" + {_SECONDS_SQL} % 60 as varchar)"
)

# raw weighing columns (the time lacks leading zeros; some chips, rounds and trucks are missing)
WEIGHINGS_RAW = f"""weighings_raw as (
  select strftime(l_shipdate, '%Y%m%d') as Date_de_la_levee, {_HHMMSS_SQL} as Heure_de_la_levee,
         case when not (l_returnflag = 'R' and l_linestatus = 'O') then 'C' || l_partkey end as Code_puce,
         l_quantity * 6 - 10 as Pesee_net, 48.0 + l_discount as Latitude, 3.0 + l_tax as Longitude,
         case when l_tax > 0 then 'T' || l_suppkey end as Immatriculation,
         case l_returnflag when 'A' then 'LU-' || l_suppkey || '-OM'
              when 'N' then 'ME-' || l_suppkey || '-' || case l_linenumber when 1 then 'CS' when 2 then 'VE' when 3 then 'BIO' else 'XX' end
         end as Tournee
  from lineitem)"""


def weighings_raw(t: Tables) -> DataFrame:
    seconds = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 101) % 86400
    compact = (
        F.floor(seconds / 3600) * 10000 + F.floor(seconds % 3600 / 60) * 100 + seconds % 60
    ).cast("string")
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")
    suffix = F.when(line == 1, "CS").when(line == 2, "VE").when(line == 3, "BIO").otherwise("XX")
    return t.lineitem.select(
        F.replace(
            F.substring(F.col("l_shipdate").cast("string"), 1, 10), F.lit("-"), F.lit("")
        ).alias("Date_de_la_levee"),
        compact.alias("Heure_de_la_levee"),
        F.when(
            ~((flag == "R") & (F.col("l_linestatus") == "O")), F.concat(F.lit("C"), "l_partkey")
        ).alias("Code_puce"),
        (F.col("l_quantity") * 6 - 10).alias("Pesee_net"),
        (F.lit(48.0) + F.col("l_discount")).alias("Latitude"),
        (F.lit(3.0) + F.col("l_tax")).alias("Longitude"),
        F.when(F.col("l_tax") > 0, F.concat(F.lit("T"), "l_suppkey")).alias("Immatriculation"),
        F.when(flag == "A", F.concat(F.lit("LU-"), "l_suppkey", F.lit("-OM")))
        .when(flag == "N", F.concat(F.lit("ME-"), "l_suppkey", F.lit("-"), suffix))
        .alias("Tournee"),
    )


# weighings with the category of their chip, as classified facts need them
WEIGHED = f"""weighed as (
  select cast(strptime(Date_de_la_levee || lpad(Heure_de_la_levee, 6, '0'), '%Y%m%d%H%M%S') as timestamp) as date_mesure,
         Code_puce as code_puce, p_partkey as id_bac, Tournee as code_tournee, Immatriculation as code_immat,
         Pesee_net as poids, {CATEGORY_SQL} as categorie_recipient, {VOLUME_SQL} as litrage_recipient
  from weighings_raw left join part on Code_puce = 'C' || p_partkey)"""


def weighed(t: Tables) -> DataFrame:
    from civiframe.functions.dates import compact_local

    chips = t.part.select(
        F.concat(F.lit("C"), "p_partkey").alias("chip"),
        F.col("p_partkey").alias("id_bac"),
        category().alias("categorie_recipient"),
        volume().alias("litrage_recipient"),
    )
    raw = weighings_raw(t).drop("Latitude", "Longitude")
    return spread_left_join(raw, chips, [("Code_puce", "chip")], shuffled=True).select(
        compact_local(F.col("Date_de_la_levee"), F.col("Heure_de_la_levee")).alias("date_mesure"),
        F.col("Code_puce").alias("code_puce"),
        "id_bac",
        F.col("Tournee").alias("code_tournee"),
        F.col("Immatriculation").alias("code_immat"),
        F.col("Pesee_net").alias("poids"),
        "categorie_recipient",
        "litrage_recipient",
    )


# first-pass flow of the category, round and truck
FLOW_SQL = """case
  when categorie_recipient = 'Bacs ordures ménagères' then 'OM'
  when categorie_recipient = 'Bacs collecte sélective' then 'CS'
  when categorie_recipient = 'Bacs verre' then 'Verre'
  when categorie_recipient = 'Bacs biodéchets' then 'Biodechets'
  when code_tournee like '%OM' then 'OM' when code_tournee like '%CS' then 'CS'
  when code_tournee like '%VE' then 'Verre' when code_tournee like '%BIO' then 'Biodechets'
  when categorie_recipient = 'Bacs carton' then 'Autres'
  when categorie_recipient is null and code_immat is not null then 'Inconnu_connu'
  else 'Inconnu' end"""

CLASSIFIED = f"classified as (select *, {FLOW_SQL} as type_flux from weighed)"

TRUCK_MODE = """truck_counts as (
  select code_immat, case type_flux when 'Inconnu_connu' then 'Inconnu' else type_flux end as truck_flow,
         count(*) as n
  from classified
  where code_tournee is null and code_immat in (
    select code_immat from classified where type_flux = 'Inconnu_connu')
  group by 1, 2),
truck_mode as (
  select code_immat, truck_flow, n
  from (select *, rank() over (partition by code_immat order by n desc) as r from truck_counts)
  where r = 1)"""

FINAL_FLOW_SQL = """case when type_flux in ('Inconnu', 'Inconnu_connu') then coalesce(truck_flow, 'Inconnu')
  when type_flux = 'Autres' then 'Inconnu' else type_flux end"""

PLAUSIBLE_SQL = """case when poids > 0 and poids < case flow when 'OM' then 120 when 'CS' then 40
  when 'Verre' then 240 else 250 end then poids else 0.0 end"""


# -- dimensions: producers from customers, bins from parts ----------------------------------------
# A customer of the segment MACHINERY is new; one with a negative balance has left; one
# above 9000 was closed earlier; nations below 5 change their activity.

PRODUCER_TABLES = """latest_producers as (
  select c_custkey * 10 + 1 as id_producteur, cast(c_custkey as integer) as code_producteur,
         c_nationkey as id_rva, 'Ville ' || c_nationkey as commune, c_nationkey + 35000 as code_insee,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as type_producteur,
         'Pavillon' as activite, c_acctbal / 1000 as latitude, c_acctbal / 2000 as longitude,
         timestamp '2022-01-01' as date_debut,
         case when c_acctbal > 9000 then timestamp '2022-02-01' end as date_fin,
         timestamp '2022-01-01 13:00:00' as date_crea, cast(null as timestamp) as date_modif,
         '2022' as year, '01' as month, '01' as day
  from customer where c_mktsegment <> 'MACHINERY'
  union all
  select -1, null, null, 'Indetermine', null, null, 'Indeterminee', null, null,
         timestamp '2020-01-01', null, timestamp '2020-01-01 12:00:00', null, null, null, null),
incoming_producers as (
  select c_custkey * 10 + 2 as id_producteur, cast(c_custkey as integer) as code_producteur,
         c_nationkey as id_rva, 'Ville ' || c_nationkey as commune, c_nationkey + 35000 as code_insee,
         case when c_mktsegment <> 'BUILDING' then c_mktsegment end as type_producteur,
         case when c_nationkey < 5 then 'Enseignement' else 'Pavillon' end as activite,
         c_acctbal / 1000 as latitude, c_acctbal / 2000 as longitude,
         timestamp '2022-03-01' as date_debut, cast(null as timestamp) as date_fin,
         timestamp '2022-03-02 13:00:00' as date_crea, cast(null as timestamp) as date_modif,
         '2022' as year, '03' as month, '02' as day
  from customer where c_acctbal >= 0)"""


def _producer_columns(suffix: int, activity, **fixed) -> list:
    none = F.lit(None).cast("timestamp_ntz")
    return [
        (F.col("c_custkey") * 10 + suffix).alias("id_producteur"),
        F.col("c_custkey").cast("int").alias("code_producteur"),
        F.col("c_nationkey").alias("id_rva"),
        F.concat(F.lit("Ville "), "c_nationkey").alias("commune"),
        (F.col("c_nationkey") + 35000).alias("code_insee"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("type_producteur"),
        activity.alias("activite"),
        (F.col("c_acctbal") / 1000).alias("latitude"),
        (F.col("c_acctbal") / 2000).alias("longitude"),
        fixed["date_debut"].alias("date_debut"),
        fixed.get("date_fin", none).alias("date_fin"),
        fixed["date_crea"].alias("date_crea"),
        none.alias("date_modif"),
        F.lit("2022").alias("year"),
        F.lit(fixed["month"]).alias("month"),
        F.lit(fixed["day"]).alias("day"),
    ]


def latest_producers(t: Tables) -> DataFrame:
    members = t.customer.where(F.col("c_mktsegment") != "MACHINERY").select(
        *_producer_columns(
            1, F.lit("Pavillon"), date_debut=ntz("2022-01-01 00:00:00"),
            date_fin=F.when(F.col("c_acctbal") > 9000, ntz("2022-02-01 00:00:00")),
            date_crea=ntz("2022-01-01 13:00:00"), month="01", day="01",
        )
    )
    values = {
        "id_producteur": F.lit(-1), "commune": F.lit("Indetermine"), "activite": F.lit("Indeterminee"),
        "date_debut": ntz("2020-01-01 00:00:00"), "date_crea": ntz("2020-01-01 12:00:00"),
    }
    unknown = t.spark.range(1).select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in members.schema]
    )
    return members.unionByName(unknown)


def incoming_producers(t: Tables) -> DataFrame:
    activity = F.when(F.col("c_nationkey") < 5, "Enseignement").otherwise("Pavillon")
    return t.customer.where(F.col("c_acctbal") >= 0).select(
        *_producer_columns(
            2, activity, date_debut=ntz("2022-03-01 00:00:00"),
            date_crea=ntz("2022-03-02 13:00:00"), month="03", day="02",
        )
    )


# Parts of the type PROMO are new, those of Brand#1 have left, Brand#2 was closed earlier,
# Brand#3 changes its volume, Brand#4 changes owner.
BIN_TABLES = f"""latest_bins as (
  select p_partkey * 10 + 1 as id_bac, 'C' || p_partkey as code_puce, p_size as code_producteur,
         {CATEGORY_SQL} as categorie_recipient, 'Bac ' || p_type as type_recipient,
         {VOLUME_SQL} as litrage_recipient, 'Connu' as type_puce, cast(p_size % 3 as double) as nb_collecte,
         timestamp '2022-01-01' as date_debut,
         case when p_brand = 'Brand#2' then timestamp '2022-02-01' end as date_fin,
         timestamp '2022-01-01 13:00:00' as date_crea, cast(null as timestamp) as date_modif,
         '2022' as year, '01' as month, '01' as day, cast(p_size * 10 + 1 as bigint) as id_producteur
  from part where p_type <> 'PROMO'
  union all
  select v, case v when -1 then 'null' else 'INCONNU' end, 0, 'Indetermine', 'Indetermine', 0, 'Inconnu', null,
         timestamp '2020-01-01', null, timestamp '2020-01-01 12:00:00', null, null, null, null, -1
  from (values (-1), (-2)) s(v)),
incoming_bins as (
  select p_partkey * 10 + 2 as id_bac, 'C' || p_partkey as code_puce,
         case when p_brand = 'Brand#4' then p_size + 1 else p_size end as code_producteur,
         {CATEGORY_SQL} as categorie_recipient, 'Bac ' || p_type as type_recipient,
         case when p_brand = 'Brand#3' then 999 else {VOLUME_SQL} end as litrage_recipient,
         'Connu' as type_puce, cast(p_size % 3 as double) as nb_collecte,
         timestamp '2022-03-01' as date_debut, cast(null as timestamp) as date_fin,
         timestamp '2022-03-02 13:00:00' as date_crea, cast(null as timestamp) as date_modif,
         '2022' as year, '03' as month, '02' as day,
         cast((case when p_brand = 'Brand#4' then p_size + 1 else p_size end) * 10 + 2 as bigint) as id_producteur
  from part where p_brand <> 'Brand#1')"""


def _bin_columns(suffix: int, owner, litres, **fixed) -> list:
    none = F.lit(None).cast("timestamp_ntz")
    return [
        (F.col("p_partkey") * 10 + suffix).alias("id_bac"),
        F.concat(F.lit("C"), "p_partkey").alias("code_puce"),
        owner.alias("code_producteur"),
        category().alias("categorie_recipient"),
        F.concat(F.lit("Bac "), "p_type").alias("type_recipient"),
        litres.alias("litrage_recipient"),
        F.lit("Connu").alias("type_puce"),
        (F.col("p_size") % 3).cast("double").alias("nb_collecte"),
        fixed["date_debut"].alias("date_debut"),
        fixed.get("date_fin", none).alias("date_fin"),
        fixed["date_crea"].alias("date_crea"),
        none.alias("date_modif"),
        F.lit("2022").alias("year"),
        F.lit(fixed["month"]).alias("month"),
        F.lit(fixed["day"]).alias("day"),
        (owner * 10 + suffix).cast("long").alias("id_producteur"),
    ]


def latest_bins(t: Tables) -> DataFrame:
    members = t.part.where(F.col("p_type") != "PROMO").select(
        *_bin_columns(
            1, F.col("p_size"), volume(), date_debut=ntz("2022-01-01 00:00:00"),
            date_fin=F.when(F.col("p_brand") == "Brand#2", ntz("2022-02-01 00:00:00")),
            date_crea=ntz("2022-01-01 13:00:00"), month="01", day="01",
        )
    )
    for number, chip in ((-1, "null"), (-2, "INCONNU")):
        values = {
            "id_bac": F.lit(number), "code_puce": F.lit(chip), "code_producteur": F.lit(0),
            "categorie_recipient": F.lit("Indetermine"), "type_recipient": F.lit("Indetermine"),
            "litrage_recipient": F.lit(0), "type_puce": F.lit("Inconnu"),
            "date_debut": ntz("2020-01-01 00:00:00"), "date_crea": ntz("2020-01-01 12:00:00"),
            "id_producteur": F.lit(-1),
        }
        row = t.spark.range(1).select(
            *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in members.schema]
        )
        members = members.unionByName(row)
    return members


def incoming_bins(t: Tables) -> DataFrame:
    owner = F.when(F.col("p_brand") == "Brand#4", F.col("p_size") + 1).otherwise(F.col("p_size"))
    litres = F.when(F.col("p_brand") == "Brand#3", 999).otherwise(volume())
    return t.part.where(F.col("p_brand") != "Brand#1").select(
        *_bin_columns(
            2, owner, litres, date_debut=ntz("2022-03-01 00:00:00"),
            date_crea=ntz("2022-03-02 13:00:00"), month="03", day="02",
        )
    )


# -- sensors: one per user, one frame per event -----------------------------------------------------
# Even users are meters (text with a unit), odd ones thermometers (nested arrays).

FRAMES = """frames as (
  select 'S' || user_id as deveui, user_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00' as "timestamp",
         strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day, ts,
         event_type as kind, value, cast(regexp_extract(props, '([0-9]+)', 1) as integer) as k
  from events)"""


def frames(t: Tables) -> DataFrame:
    stamp = F.col("ts").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    temperature = F.array(
        *[
            F.struct(F.lit(name).alias("name"), F.array(value).alias("values"))
            for name, value in (("t1", F.col("value")), ("t2", F.col("value") / 2))
        ]
    )
    return t.events.select(
        F.concat(F.lit("S"), "user_id").alias("deveui"),
        F.concat(iso_text(F.col("ts")), F.lit("+01:00")).alias("timestamp"),
        F.substring(stamp, 1, 4).alias("year"),
        F.substring(stamp, 6, 2).alias("month"),
        F.substring(stamp, 9, 2).alias("day"),
        F.struct(
            F.col("event_type").alias("kind"),
            F.struct(k.alias("counter")).alias("status"),
            F.concat(F.col("value").cast("string"), F.lit("kWh")).alias("EAP"),
            temperature.alias("temperatures"),
            F.array("value", F.col("value") / 2, k.cast("double")).alias("past"),
        ).alias("data"),
    )


SENSOR_IDS = "sensor_ids as (select distinct user_id, 'S' || user_id as deveui from events)"


def sensor_ids(t: Tables) -> DataFrame:
    return t.events.select("user_id").distinct().select(
        "user_id", F.concat(F.lit("S"), "user_id").alias("deveui")
    )


def parameters(t: Tables) -> DataFrame:
    meter = F.col("user_id") % 2 == 0

    def either(if_meter: list[str], otherwise: list[str]):
        texts = [F.array(*[F.lit(v) for v in names]).cast("array<string>") for names in (if_meter, otherwise)]
        return F.when(meter, texts[0]).otherwise(texts[1])

    return sensor_ids(t).select(
        "deveui",
        either([], ["temp"]).alias("global_name_keys"),
        either(["kind"], []).alias("global_name_values"),
        either(["EAP"], []).alias("name_keys"),
        either([], ["temperatures_name"]).alias("name_values"),
        either(["EAP"], ["temperatures_values"]).alias("value_columns"),
        either(["meter"], []).alias("user_label"),
    )


# long measures of the frames
MEASURES = """measures as (
  select deveui, "timestamp" as tramedate, 'meter:' || kind || ':EAP' as name, value as v, year, month, day, ts, user_id
  from frames where user_id % 2 = 0
  union all
  select deveui, "timestamp", 'temp:t1', value, year, month, day, ts, user_id from frames where user_id % 2 = 1
  union all
  select deveui, "timestamp", 'temp:t2', value / 2, year, month, day, ts, user_id from frames where user_id % 2 = 1)"""

# two validity periods per (sensor, name), split at a day that depends on the sensor;
# the name temp:t2 is unknown for the first period
REFERENTIAL = """referential as (
  select deveui, name as dataparameter,
         case p when 0 then '2024-01-01' else '2024-01-' || lpad(cast(10 + user_id % 10 as varchar), 2, '0') end as enabledon,
         case p when 0 then '2024-01-' || lpad(cast(10 + user_id % 10 as varchar), 2, '0') end as disabledon,
         cast(length(name) as integer) as measurenatureid, cast(p as integer) as unitid
  from (select distinct user_id, deveui, name from measures), range(2) r(p)
  where not (name = 'temp:t2' and p = 0))"""


def referential(t: Tables) -> DataFrame:
    names = F.when(
        F.col("user_id") % 2 == 0,
        F.transform(
            F.array(*[F.lit(v) for v in ("click", "error", "purchase", "signup", "view")]),
            lambda kind: F.concat(F.lit("meter:"), kind, F.lit(":EAP")),
        ),
    ).otherwise(F.array(F.lit("temp:t1"), F.lit("temp:t2")))
    split = F.concat(F.lit("2024-01-"), F.lpad((10 + F.col("user_id") % 10).cast("string"), 2, "0"))
    period = F.explode(F.array(F.lit(0), F.lit(1)))
    return (
        sensor_ids(t)
        .withColumn("dataparameter", F.explode(names))
        .withColumn("p", period)
        .where(~((F.col("dataparameter") == "temp:t2") & (F.col("p") == 0)))
        .select(
            "deveui",
            "dataparameter",
            F.when(F.col("p") == 0, "2024-01-01").otherwise(split).alias("enabledon"),
            F.when(F.col("p") == 0, split).alias("disabledon"),
            F.length("dataparameter").alias("measurenatureid"),
            F.col("p").alias("unitid"),
            F.lit(3600).alias("step"),
        )
    )


# replay state of each sensor
SENSORS = """sensors as (
  select deveui, user_id, '2024-01-' || lpad(cast(1 + user_id % 5 as varchar), 2, '0') as enabledon,
         case when user_id % 3 = 0 then '2024-01-' || lpad(cast(3 + user_id % 7 as varchar), 2, '0') end as disabledon,
         case when user_id % 4 < 3 then '2024-02-0' || (1 + user_id % 4) end as updatedon,
         case when user_id % 5 < 3 then '2024-02-0' || (1 + user_id % 5) end as reprisedon
  from sensor_ids)"""


def sensors(t: Tables) -> DataFrame:
    u = F.col("user_id")

    def january(day):
        return F.concat(F.lit("2024-01-"), F.lpad(day.cast("string"), 2, "0"))

    def february(day):
        return F.concat(F.lit("2024-02-0"), day.cast("string"))

    return sensor_ids(t).select(
        "deveui",
        january(1 + u % 5).alias("enabledon"),
        F.when(u % 3 == 0, january(3 + u % 7)).alias("disabledon"),
        F.when(u % 4 < 3, february(1 + u % 4)).alias("updatedon"),
        F.when(u % 5 < 3, february(1 + u % 5)).alias("reprisedon"),
    )


# -- dimension stored with instants, for jobs that take Paris dates -----------------------------------


def bin_dimension_instants(t: Tables) -> DataFrame:
    """``bin_versions`` with its dates as instants of Paris midnights, plus the bin of
    unknown chips."""

    def instant(name: str):
        day = F.replace(F.substring(F.col(name).cast("string"), 1, 10), F.lit("-"), F.lit(""))
        return compact_instant(day, F.lit("000000"))

    versions = bin_versions(t).select(
        "id_bac", F.col("chip").alias("code_puce"), "categorie_recipient", "litrage_recipient",
        instant("date_debut").alias("date_debut"), instant("date_fin").alias("date_fin"),
    )
    unknown = t.spark.range(1).select(
        F.lit(-2).cast("long").alias("id_bac"), F.lit("INCONNU").alias("code_puce"),
        F.lit("Indetermine").alias("categorie_recipient"), F.lit(0).alias("litrage_recipient"),
        compact_instant(F.lit("20200101"), F.lit("000000")).alias("date_debut"),
        F.lit(None).cast("timestamp").alias("date_fin"),
    )
    return versions.unionByName(unknown)
