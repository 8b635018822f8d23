"""Casts, renames, gates, filters, duplicates and the traffic job."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.registry import query, seconds_text
from civiframe.config import BIN, OUTLET, WEIGHING, Field, TableSpec
from civiframe.operators import clean
from civiframe.operators.temporal import traffic_statistics
from civiframe.plans.traffic import COLUMN_NAMES, intake, traffic_plan
from civiframe.plans.waste import outlet_preparation

_WINDOWS = """select {start} as start_time, {seg} as id, min(speed) as speed_min, round(avg(speed), 1) as speed_avg,
  max(speed) as speed_max, round(stddev_samp(speed), 1) as speed_std, round(avg(rel), 1) as rel_avg,
  round(stddev_samp(rel), 1) as rel_std, count(speed) as nb_values"""
_BUCKET = "strftime(time_bucket(interval 15 minutes, cast(substr(datetime, 1, 19) as timestamp)), '%Y-%m-%d %H:%M:%S')"
_TRAFFIC_CTE = f"""with {S.TRAFFIC_RAW},
  typed as (select {_BUCKET} as quarter, cast(substr(datetime, 1, 19) as timestamp) as local_ts,
     predefinedLocationReference as segment, averageVehicleSpeed as speed, travelTimeReliability as rel,
     travelTime, trafficStatus from traffic_raw)"""


@query(
    "traffic_window_stats",
    f"""{_TRAFFIC_CTE} {_WINDOWS.format(start='quarter', seg='segment')} from typed group by quarter, segment""",
)
def _traffic_window_stats(t):
    stats = traffic_statistics(intake(S.traffic_raw(t), first=-1, last=24))
    return stats.withColumn("start_time", seconds_text(F.col("start_time")))


@query(
    "hour_filter",
    f"""{_TRAFFIC_CTE} select strftime(local_ts, '%Y-%m-%d %H:%M:%S') as date, segment, speed as "avgSpeed",
        "travelTime", rel as reliability, "trafficStatus" as status
        from typed where hour(local_ts) between 5 and 21""",
)
def _hour_filter(t):
    return intake(S.traffic_raw(t)).withColumn("date", seconds_text(F.col("date")))


@query(
    "pipe_traffic",
    f"""{_TRAFFIC_CTE}, stats as ({_WINDOWS.format(start='quarter', seg='segment')}
        from typed where hour(local_ts) between 5 and 21 group by quarter, segment)
    select *, '2024' as year, '01' as month, '02' as week,
           id || '_' || start_time || '_2024_01_02' as technical_key from stats""",
)
def _pipe_traffic(t):
    return traffic_plan(S.traffic_raw(t), "2024-01-10").withColumn(
        "start_time", seconds_text(F.col("start_time"))
    )


@query(
    "rename_map",
    f"""with {S.TRAFFIC_RAW} select datetime as date, predefinedLocationReference as segment,
        averageVehicleSpeed as "avgSpeed", travelTime as "travelTime", travelTimeReliability as reliability,
        trafficStatus as status from traffic_raw""",
)
def _rename_map(t):
    return clean.rename(S.traffic_raw(t), COLUMN_NAMES)


@query(
    "before_date_filter",
    "select event_id, user_id, value from events where ts < timestamp '2024-01-16'",
)
def _before_date_filter(t):
    return clean.before_date(t.events, "ts", "2024-01-16").select("event_id", "user_id", "value")


# -- casts ---------------------------------------------------------------------------------

_TEXTS = """texts as (select l_orderkey, l_linenumber,
  case l_returnflag when 'A' then replace(cast(l_extendedprice as varchar), '.', ',')
    when 'N' then cast(l_extendedprice as varchar) else 'x' || l_linenumber end as number_text,
  case l_returnflag when 'A' then cast(l_linenumber as varchar)
    when 'N' then cast(l_discount * 100 + l_linenumber as varchar)
    else case l_linestatus when 'O' then 'none' end end as whole_text,
  case l_linestatus when 'O' then 'TRUE' else case l_returnflag when 'A' then 'false' else 'yes' end end as flag_text
  from lineitem)"""

_CAST_SPEC = TableSpec(
    "texts", (Field("number_text", "double"), Field("whole_text", "int"), Field("flag_text", "boolean"))
)


def _texts(t):
    price, line = F.col("l_extendedprice").cast("string"), F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(flag == "A", F.translate(price, ".", ","))
        .when(flag == "N", price)
        .otherwise(F.concat(F.lit("x"), line))
        .alias("number_text"),
        F.when(flag == "A", line.cast("string"))
        .when(flag == "N", (F.col("l_discount") * 100 + line).cast("string"))
        .when(status == "O", "none")
        .alias("whole_text"),
        F.when(status == "O", "TRUE").when(flag == "A", "false").otherwise("yes").alias("flag_text"),
    )


@query(
    "lenient_cast",
    f"""with {_TEXTS} select l_orderkey, l_linenumber,
      coalesce(try_cast(replace(number_text, ',', '.') as double), 0.0) as number_text,
      coalesce(case when contains(whole_text, '.') then cast(trunc(try_cast(whole_text as double)) as integer)
               else try_cast(whole_text as integer) end, 0) as whole_text,
      lower(flag_text) = 'true' as flag_text from texts""",
)
def _lenient_cast(t):
    return clean.lenient_cast(_texts(t), _CAST_SPEC)


_WEIGHING_TEXTS_SQL = f"""with {S.WEIGHINGS_RAW}
  select Date_de_la_levee as "Date_de_la_levee", Heure_de_la_levee as "Heure_de_la_levee", Code_puce as "Code_puce",
         Pesee_net as "Pesee_net", 1 as "Statut_de_la_levee", Latitude as "Latitude", Longitude as "Longitude",
         0.0::double as "Bouton_poussoir_1", 0.0::double as "Bouton_poussoir_2", 1.0::double as "Bouton_poussoir_3",
         0.0::double as "Bouton_poussoir_4", 0.0::double as "Bouton_poussoir_5", 0.0::double as "Bouton_poussoir_6",
         cast(null as varchar) as "Statut_du_bac", Immatriculation as "Immatriculation", Tournee as "Tournee"
  from weighings_raw"""


def _weighing_texts(t):
    """Weighings as unnamed text columns in file order, with one column too many."""
    raw = S.weighings_raw(t)
    decimal_comma = F.translate(F.col("Pesee_net").cast("string"), ".", ",")
    values = {
        "Date_de_la_levee": F.col("Date_de_la_levee"), "Heure_de_la_levee": F.col("Heure_de_la_levee"),
        "Code_puce": F.col("Code_puce"), "Pesee_net": decimal_comma, "Statut_de_la_levee": F.lit("1.0"),
        "Latitude": F.col("Latitude").cast("string"), "Longitude": F.col("Longitude").cast("string"),
        "Bouton_poussoir_2": F.lit("off"), "Bouton_poussoir_3": F.lit("1"),
        "Immatriculation": F.col("Immatriculation"), "Tournee": F.col("Tournee"),
    }
    columns = [
        values.get(name, F.lit(None)).cast("string").alias(f"_c{i}")
        for i, name in enumerate(WEIGHING.names)
    ]
    return raw.select(*columns, F.lit("surplus").alias(f"_c{len(columns)}"))


@query(
    "positional_rename",
    f"""with {S.WEIGHINGS_RAW} select Date_de_la_levee as "Date_de_la_levee", Heure_de_la_levee as "Heure_de_la_levee",
        Code_puce as "Code_puce", Immatriculation as "Immatriculation", Tournee as "Tournee" from weighings_raw""",
)
def _positional_rename(t):
    named = clean.in_spec_order(clean.name_positional(_weighing_texts(t), WEIGHING), WEIGHING)
    return named.select("Date_de_la_levee", "Heure_de_la_levee", "Code_puce", "Immatriculation", "Tournee")


@query("pipe_weigh_prepare", _WEIGHING_TEXTS_SQL)
def _pipe_weigh_prepare(t):
    spec = TableSpec("weighing", WEIGHING.fields, header=False)
    return clean.prepare_weighings(_weighing_texts(t), spec)


@query(
    "header_normalise",
    """select c_custkey as code_producteur, c_name as nom_eleve, c_mktsegment as categorie_recipient,
       c_nationkey as no_100 from customer""",
)
def _header_normalise(t):
    odd = t.customer.select(
        F.col("c_custkey").alias("Code |producteur"), F.col("c_name").alias("Nom 'élève["),
        F.col("c_mktsegment").alias("Catégorie% récipient"), F.col("c_nationkey").alias("N°o $(100)"),
    )
    return clean.normalise_headers(odd)


# -- gates ------------------------------------------------------------------------------------


def _raw_bins(t, chip=None):
    """Bin file of a day as text, one row per part."""
    return t.part.select(
        F.col("p_size").cast("string").alias("Code producteur"),
        F.coalesce(S.category(), F.lit("Bacs papier")).alias("Catégorie récipient"),
        F.concat(F.lit("Bac "), "p_type").alias("Type de récipient"),
        S.volume().cast("string").alias("Litrage récipient"),
        (F.concat(F.lit("C"), "p_partkey") if chip is None else chip).alias("Code puce"),
        F.when(F.col("p_brand") != "Brand#13", (F.col("p_size") % 3).cast("string")).alias("Fréquence OM"),
        F.translate((F.col("p_size") / 4.0).cast("string"), ".", ",").alias("Fréquence CS"),
        F.lit("20220301").alias("date_photo"),
    )


_BINS_SQL = f"""select p_size as code_producteur, coalesce({S.CATEGORY_SQL}, 'Bacs papier') as categorie_recipient,
  'Bac ' || p_type as type_recipient, {S.VOLUME_SQL} as litrage_recipient, 'C' || p_partkey as code_puce,
  case when p_brand <> 'Brand#13' then p_size % 3 else 0 end as frequence_om, p_size / 4.0 as frequence_cs,
  '20220301' as date_photo from part"""


@query(
    "gate_required",
    f"""with good as ({_BINS_SQL}),
    bad as (select * from good where not exists (select 1 from part where p_brand = 'Brand#7'))
    select 'complete' as batch, * from good union all select 'chip missing' as batch, * from bad""",
)
def _gate_required(t):
    chip = F.when(F.col("p_brand") != "Brand#7", F.concat(F.lit("C"), "p_partkey"))
    complete = clean.prepare_bins(_raw_bins(t)).withColumn("batch", F.lit("complete"))
    missing = clean.prepare_bins(_raw_bins(t, chip)).withColumn("batch", F.lit("chip missing"))
    return complete.unionByName(missing).select("batch", *BIN.names)


@query(
    "gate_length",
    f"""with good as ({_BINS_SQL}),
    bad as (select * from good where not exists (select 1 from part where length('CHIP-' || p_name) > 10))
    select 'short' as batch, count(*) as n_rows from good
    union all select 'long chip' as batch, count(*) as n_rows from bad""",
)
def _gate_length(t):
    long_chip = F.concat(F.lit("CHIP-"), "p_name")
    counted = []
    for batch, raw in (("short", _raw_bins(t)), ("long chip", _raw_bins(t, long_chip))):
        prepared = clean.prepare_bins(raw)
        counted.append(
            prepared.agg(F.count("*").alias("n_rows")).select(F.lit(batch).alias("batch"), "n_rows")
        )
    return counted[0].unionByName(counted[1])


def raw_outlets(t):
    """Outlet tickets as text under untidy headers, one per order."""
    day = F.col("o_orderdate").cast("string")
    us = F.concat_ws(
        "/", F.month("o_orderdate"), F.dayofmonth("o_orderdate"), F.substring(day, 1, 4)
    )
    open_order = F.col("o_orderstatus") == "O"
    return t.orders.select(
        F.concat(F.lit("T"), "o_custkey").alias("Immat"),
        F.when(open_order, seconds_text(F.col("o_orderdate"))).otherwise(us).alias("Date Service Véhic."),
        F.col("o_orderpriority").alias("Description Tournée"),
        (F.col("o_orderkey") % 300 + 0.5).cast("string").alias("Km Réalisé"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("J"), "o_orderkey")).alias("No Bon"),
        F.lit("LOT").alias("Lot"),
        (F.col("o_custkey") % 40).cast("string").alias("Service"),
        F.when(F.col("o_orderstatus") == "F", "PESEE EMBARQUEE")
        .when(F.col("o_orderstatus") == "P", "USINE")
        .alias("Nom Rech. Lieu de vidage"),
        F.translate((F.floor(F.col("o_totalprice") / 10) / 100).cast("string"), ".", ",").alias("Multiples Lignes"),
        F.lit("BOM").alias("Clé unique ligne ticket"),
    )


OUTLETS_SQL = """outlets as (select 'T' || o_custkey as immat,
  case when o_orderstatus = 'O' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       else month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) end as date_service_vehic,
  o_orderpriority as description_tournee, cast(o_orderkey % 300 as integer) as km_realise,
  case when o_orderpriority <> '5-LOW' then 'J' || o_orderkey end as no_bon, 'LOT' as lot,
  cast(o_custkey % 40 as integer) as service,
  case o_orderstatus when 'F' then 'PESEE EMBARQUEE' when 'P' then 'USINE' end as nom_rech_lieu_de_vidage,
  floor(o_totalprice / 10) / 100 as multiples_lignes, 'BOM' as cle_unique_ligne_ticket, o_orderdate from orders)"""


@query(
    "outlet_prepare",
    f"""with {OUTLETS_SQL} select * exclude (o_orderdate) from outlets
    where no_bon is not null and nom_rech_lieu_de_vidage is not null""",
)
def _outlet_prepare(t):
    return outlet_preparation(raw_outlets(t))


@query(
    "drop_incomplete",
    f"""with {OUTLETS_SQL} select nom_rech_lieu_de_vidage, count(*) as n from outlets
    where no_bon is not null group by 1""",
)
def _drop_incomplete(t):
    named = clean.normalise_headers(raw_outlets(t)).select(*OUTLET.names)
    kept = clean.drop_incomplete(named, ["immat", "date_service_vehic", "no_bon", "lot", "service"])
    return kept.groupBy("nom_rech_lieu_de_vidage").agg(F.count("*").alias("n"))


# -- duplicates -----------------------------------------------------------------------------------

_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


def _lines(t):
    return t.lineitem.select(*_LINE_COLUMNS.split(", "))


@query(
    "dup_key_report",
    f"""select {_LINE_COLUMNS}, n_rows from lineitem
        join (select l_orderkey, count(*) as n_rows from lineitem group by 1 having count(*) > 1) using (l_orderkey)""",
)
def _dup_key_report(t):
    return clean.duplicate_report(_lines(t), "l_orderkey")


@query(
    "dup_key_keep_one",
    f"""select {_LINE_COLUMNS} from (select {_LINE_COLUMNS}, row_number() over (partition by l_orderkey
        order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as r from lineitem) where r = 1""",
)
def _dup_key_keep_one(t):
    return clean.keep_one(_lines(t), "l_orderkey")


@query("distinct_rows", "select distinct l_suppkey, l_linenumber, l_quantity from lineitem")
def _distinct_rows(t):
    return t.lineitem.select("l_suppkey", "l_linenumber", "l_quantity").distinct()


@query(
    "batch_date",
    """select max(strftime(o_orderdate, '%Y%m%d')) as date_photo,
       count(distinct strftime(o_orderdate, '%Y%m%d')) as n_dates from orders""",
)
def _batch_date(t):
    photo = F.replace(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit("-"), F.lit(""))
    return clean.batch_date(t.orders.select(photo.alias("date_photo")))


@query(
    "frame_diff",
    """with a as (select l_suppkey, l_linenumber from lineitem where l_returnflag <> 'A'),
            b as (select l_suppkey, l_linenumber from lineitem where l_linestatus <> 'O')
    select *, 'left' as side from (select * from a except all select * from b)
    union all select *, 'right' as side from (select * from b except all select * from a)""",
)
def _frame_diff(t):
    columns = ["l_suppkey", "l_linenumber"]
    left = t.lineitem.where(F.col("l_returnflag") != "A").select(*columns)
    right = t.lineitem.where(F.col("l_linestatus") != "O").select(*columns)
    return clean.frame_difference(left, right)
