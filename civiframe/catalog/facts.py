"""Interval joins, flow of the weighings, history, outlets."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.cleaning import OUTLETS_SQL, raw_outlets
from civiframe.catalog.registry import ntz, query, seconds_text, sql_paris_epoch
from civiframe.operators import clean, outlets, weights
from civiframe.operators.temporal import interval_join
from civiframe.plans.waste import outlet_facts, weighing_facts
from civiframe.sources.readers import previous_year_window

_TIMED = f"""with {S.WEIGHINGS_RAW}, {S.BIN_VERSIONS}, timed as (
  select *, cast(strptime(Date_de_la_levee || lpad(Heure_de_la_levee, 6, '0'), '%Y%m%d%H%M%S') as timestamp) as date_mesure
  from weighings_raw)"""


@query(
    "asof_bin_join",
    f"""{_TIMED} select Code_puce as code_puce, strftime(date_mesure, '%Y-%m-%d %H:%M:%S') as date_mesure,
      Pesee_net as poids, coalesce(id_bac, -2) as id_bac, categorie_recipient
    from timed left join bin_versions on Code_puce is not distinct from chip and date_mesure >= date_debut
      and (date_fin is null or date_mesure <= date_fin)""",
)
def _asof_bin_join(t):
    from civiframe.functions.dates import compact_local

    timed = S.weighings_raw(t).withColumn(
        "date_mesure", compact_local(F.col("Date_de_la_levee"), F.col("Heure_de_la_levee"))
    )
    joined = interval_join(
        timed, S.bin_versions(t), [("Code_puce", "chip")], "date_mesure", "date_debut", "date_fin",
        null_safe=True,
    )
    return joined.select(
        F.col("Code_puce").alias("code_puce"),
        seconds_text(F.col("date_mesure")).alias("date_mesure"),
        F.col("Pesee_net").alias("poids"),
        F.coalesce("id_bac", F.lit(-2)).alias("id_bac"),
        "categorie_recipient",
    )


_FLOWS = f"with {S.WEIGHINGS_RAW}, {S.WEIGHED}, {S.CLASSIFIED}, {S.TRUCK_MODE}"


@query("flow_mode", f"{_FLOWS} select code_immat, truck_flow, n from truck_mode")
def _flow_mode(t):
    mode = weights.truck_flow_mode(weights.with_first_flow(S.weighed(t)))
    return mode.select("code_immat", "truck_flow", "n")


@query(
    "flow_final",
    f"""{_FLOWS} select code_puce, code_tournee, code_immat, poids, {S.FINAL_FLOW_SQL} as type_flux
    from classified left join truck_mode using (code_immat)""",
)
def _flow_final(t):
    flows = weights.with_final_flow(weights.with_first_flow(S.weighed(t)))
    return flows.select("code_puce", "code_tournee", "code_immat", "poids", "type_flux")


@query(
    "pipe_weigh_analysis",
    f"""with {S.WEIGHINGS_RAW}, {S.BIN_VERSIONS}, timed as (
      select *, cast(strptime(Date_de_la_levee || lpad(Heure_de_la_levee, 6, '0'), '%Y%m%d%H%M%S') as timestamp) as local_ts
      from weighings_raw),
    instants as (select *, {sql_paris_epoch('local_ts')} as moment from timed),
    versions as (select *, {sql_paris_epoch('date_debut')} as first_at, {sql_paris_epoch('date_fin')} as last_at from bin_versions),
    weighed as (select moment, Code_puce as code_puce, coalesce(id_bac, -2) as id_bac, Tournee as code_tournee,
      Immatriculation as code_immat, Pesee_net as poids, Latitude as latitude, Longitude as longitude, categorie_recipient
      from instants left join versions on Code_puce is not distinct from chip and moment >= first_at
        and (last_at is null or moment <= last_at)),
    {S.CLASSIFIED}, {S.TRUCK_MODE},
    final as (select classified.*, {S.FINAL_FLOW_SQL} as flow from classified left join truck_mode using (code_immat))
    select distinct moment as epoch_seconds, code_puce, id_bac, code_tournee, code_immat, poids, {S.PLAUSIBLE_SQL} as poids_corr,
      latitude, longitude, flow as type_flux, '2024' as year, '01' as month, '10' as day from final""",
)
def _pipe_weigh_analysis(t):
    now = F.lit("2024-01-10 13:00:00").cast("timestamp")
    facts = weighing_facts(S.weighings_raw(t), S.bin_dimension_instants(t), "2024-01-10", now)
    return facts.withColumn("epoch_seconds", F.unix_seconds("date_mesure")).drop(
        "date_mesure", "date_crea", "date_modif"
    )


def history_sql(until):
    return """history as (select l_partkey as id_bac, l_quantity as poids,
   case when l_tax > 0.02 then l_quantity else 0.0 end as poids_corr, l_shipdate as date_mesure from lineitem),
  last_weights as (select * from (select *, row_number() over (partition by id_bac
     order by date_mesure desc, poids, poids_corr) as history_value from history
     where date_mesure <= timestamp '%s') where history_value <= 6 and poids = poids_corr)""" % until


_HISTORY = history_sql("2000-06-30")


def history(t):
    return t.lineitem.select(
        F.col("l_partkey").alias("id_bac"),
        F.col("l_quantity").alias("poids"),
        F.when(F.col("l_tax") > 0.02, F.col("l_quantity")).otherwise(0.0).alias("poids_corr"),
        F.col("l_shipdate").alias("date_mesure"),
    )


@query(
    "history_last_n",
    f"""with {_HISTORY} select id_bac, count(*) as n, round(avg(poids), 4) as average,
      count(*) = 6 as complete from last_weights group by id_bac""",
)
def _history_last_n(t):
    last = weights.last_weights(history(t), ntz("2000-06-30 00:00:00"))
    full = weights.history_average(last).select("id_bac", "n", "average").withColumn("complete", F.lit(True))
    few = weights.short_history(last).withColumn("complete", F.lit(False))
    averages = last.groupBy("id_bac").agg(F.avg("poids").alias("average"))
    few = few.join(averages, "id_bac").select("id_bac", "n", "average", "complete")
    return full.unionByName(few).withColumn("average", F.round("average", 4))


@query(
    "history_kept_state",
    f"""with {history_sql("1998-03-01")} select id_bac, poids, strftime(date_mesure, '%Y-%m-%d') as day_text, count(*) as n
    from last_weights group by all""",
)
def _history_kept_state(t):
    """The state kept over three runs, the last rows of which are not due yet, as history of the last."""
    rows, state = history(t), history(t).where("false")
    for first, last in (("1900-01-01", "1995-06-01"), ("1995-06-01", "1997-01-01"), ("1997-01-01", "2100-01-01")):
        new = rows.where((F.col("date_mesure") >= first) & (F.col("date_mesure") < last))
        state = weights.merge_history(state, new, ntz(min(last, "1998-03-01") + " 00:00:01"))
    last = weights.last_weights(state, ntz("1998-03-01 00:00:00"))
    return last.groupBy("id_bac", "poids", F.date_format("date_mesure", "yyyy-MM-dd").alias("day_text")).agg(F.count("*").alias("n"))


@query(
    "prev_year_window",
    """select l_orderkey, l_linenumber, l_quantity from lineitem
       where strftime(l_shipdate, '%Y-%m') = '1998-05'""",
)
def _prev_year_window(t):
    return previous_year_window(t.lineitem, "l_shipdate", "1999-05-20").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


# -- outlets ---------------------------------------------------------------------------------


def _prepared_outlets(t):
    return clean.prepare_outlets(raw_outlets(t))


@query(
    "latest_month_filter",
    f"""with {OUTLETS_SQL} select immat as code_immat, no_bon,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as date_mesure from outlets
    where strftime(o_orderdate, '%Y-%m') = (select max(strftime(o_orderdate, '%Y-%m')) from outlets)""",
)
def _latest_month_filter(t):
    now = F.lit("2024-01-10 13:00:00").cast("timestamp")
    return outlets.latest_month(outlets.outlet_columns(_prepared_outlets(t), now)).select(
        "code_immat", "no_bon", "date_mesure"
    )


@query(
    "outlet_analysis",
    f"""with {OUTLETS_SQL}, kept as (select * from outlets
       where coalesce(nom_rech_lieu_de_vidage, '') <> 'PESEE EMBARQUEE' and no_bon is not null),
    facts as (select immat as code_immat, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as date_mesure,
      description_tournee as code_tournee, cast(km_realise as double) as distance, lot as secteur, service as nb_bac,
      nom_rech_lieu_de_vidage as localisation_vidage, multiples_lignes as poids, cle_unique_ligne_ticket as type_vehicule,
      '2024' as year, '01' as month, '10' as day, o_orderdate from kept)
    select 'daily' as mode, * exclude (o_orderdate) from facts
      where strftime(o_orderdate, '%Y-%m') = (select max(strftime(o_orderdate, '%Y-%m')) from outlets)
    union all select 'replay' as mode, * exclude (o_orderdate) from facts""",
)
def _outlet_analysis(t):
    now = F.lit("2024-01-10 13:00:00").cast("timestamp")
    prepared = _prepared_outlets(t)
    daily = outlet_facts(prepared, "2024-01-10", now).withColumn("mode", F.lit("daily"))
    replay = outlet_facts(prepared, "2024-01-10", now, replay=True).withColumn("mode", F.lit("replay"))
    return daily.unionByName(replay).drop("date_crea", "date_modif")
