"""Reference rates and corrected weights."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.facts import _HISTORY, history
from civiframe.catalog.registry import ntz, query
from civiframe.operators import weights
from civiframe.sources.readers import previous_year_window

def sums_sql(month=None):
    window = f"and strftime(date_mesure, '%Y-%m') = '{month}'" if month else ""
    return f"""with {S.WEIGHINGS_RAW}, {S.WEIGHED}, support as (
  select *, case when length(code_tournee) > 0 then list_extract(string_split(code_tournee, '-'), 3) end as flow_code
  from weighed where poids > 0 and poids < 250 {window})"""


_SUMS = sums_sql()

VOLUME_RATES_SQL = "volume_rates(rate, category, volumes, default_rate) as (values {})".format(
    ", ".join(f"('{r}', '{c}', '{v}', {d}::double)" for r, c, v, d in weights.VOLUME_RATES)
)
FLOW_RATES_SQL = "flow_rates(rate, code, default_rate) as (values {})".format(
    ", ".join(f"('{r}', '{c}', {d}::double)" for r, c, d in weights.FLOW_RATES)
)
_BY_VOLUME = """volume_averages as (select rate, avg(poids) as average, count(*) as n from support
  join volume_rates on categorie_recipient = category and contains(volumes, cast(litrage_recipient as varchar))
  group by rate having count(*) > 50)"""
_BY_FLOW = """flow_averages as (select rate, avg(poids) as average, count(*) as n from support
  join flow_rates on code = flow_code group by rate)"""


def _support(t):
    return S.weighed(t).select("id_bac", "code_tournee", "poids")


def _bins(t):
    return t.part.select(
        F.col("p_partkey").alias("id_bac"),
        S.category().alias("categorie_recipient"),
        S.volume().alias("litrage_recipient"),
    )


@query(
    "rate_by_flow_volume",
    f"{_SUMS}, {VOLUME_RATES_SQL}, {_BY_VOLUME} select rate, round(average, 6) as average, n from volume_averages",
)
def _rate_by_flow_volume(t):
    rates = weights.rate_by_volume(weights.reference_averages(_support(t), _bins(t)))
    return rates.select("rate", F.round("average", 6).alias("average"), "n")


@query(
    "rate_by_flow",
    f"{_SUMS}, {FLOW_RATES_SQL}, {_BY_FLOW} select rate, round(average, 6) as average, n from flow_averages",
)
def _rate_by_flow(t):
    rates = weights.rate_by_flow(weights.reference_averages(_support(t), _bins(t)))
    return rates.select("rate", F.round("average", 6).alias("average"), "n")


@query("rate_global", f"{_SUMS} select round(avg(poids), 6) as average, count(*) as n from support")
def _rate_global(t):
    overall = weights.rate_global(weights.reference_averages(_support(t), _bins(t)))
    return overall.select(F.round("average", 6).alias("average"), "n")


@query(
    "rates_of_month",
    f"""{sums_sql("1997-05")}, {VOLUME_RATES_SQL}, {FLOW_RATES_SQL}, {_BY_VOLUME.replace('50', '5')}, {_BY_FLOW}
    select 'volume' as kind, rate, round(average, 6) as average, n from volume_averages
    union all select 'flow', rate, round(average, 6), n from flow_averages
    union all select 'overall', null, round(avg(poids), 6), count(*) from support""",
)
def _rates_of_month(t):
    """Every reference average of the month a year before a date."""
    month = previous_year_window(S.weighed(t), "date_mesure", "1998-05-10")
    averages = weights.reference_averages(month, _bins(t))
    enough = averages.where((F.col("kind") != weights.BY_VOLUME) | (F.col("n") > 5))
    return enough.select("kind", "rate", F.round("average", 6).alias("average"), "n")


@query(
    "rate_default",
    f"""{_SUMS}, {VOLUME_RATES_SQL}, {FLOW_RATES_SQL}, {_BY_VOLUME}, {_BY_FLOW}
    select rate, round(coalesce(average, default_rate), 6) as weight from volume_rates left join volume_averages using (rate)
    union all
    select rate, round(coalesce(average, default_rate), 6) as weight from flow_rates left join flow_averages using (rate)""",
)
def _rate_default(t):
    averages = weights.reference_averages(_support(t), _bins(t))
    by_volume = weights.rates_with_default(weights.volume_rates(t.spark), weights.rate_by_volume(averages))
    by_flow = weights.rates_with_default(weights.flow_rates(t.spark), weights.rate_by_flow(averages))
    return by_volume.unionByName(by_flow).select("rate", F.round("weight", 6).alias("weight"))


_RATE_NAME_SQL = "case when flow in ('Autres', 'Inconnu') then null {} {} end".format(
    " ".join(
        f"when flow = '{flow}' and litrage_recipient in ({', '.join(v)}) then '{rate}'"
        for flow, by_volume in weights.RATE_VOLUMES.items()
        for rate, v in by_volume.items()
    ),
    " ".join(f"when flow = '{f}' then '{r}'" for f, r in weights.FLOW_GLOBAL_RATE.items()),
)

# weighings with their first flow as final one; implausible weights stand at 0
TO_CORRECT = f"""flowed as (select *, {S.FLOW_SQL} as flow from weighed),
  to_correct as (select *, {S.PLAUSIBLE_SQL} as corr from flowed)"""

CORRECTED = f"""own as (select id_bac, avg(poids) as own_average from last_weights group by id_bac having count(*) = 6),
  all_rates as (select rate, coalesce(average, default_rate) as weight from volume_rates left join volume_averages using (rate)
    union all select rate, coalesce(average, default_rate) from flow_rates left join flow_averages using (rate)),
  named as (select *, {_RATE_NAME_SQL} as rate from to_correct),
  corrected as (select named.*, coalesce(round(case when corr = 0 then own_average else corr end, 2),
      weight, (select avg(poids) from support)) as poids_corr,
      corr = 0 and own_average is null as by_rate
    from named left join own using (id_bac) left join all_rates using (rate))"""


def to_correct(t):
    flowed = weights.with_first_flow(S.weighed(t))
    return weights.with_plausible_weight(flowed).select(
        "date_mesure", "code_puce", "id_bac", "code_tournee", "code_immat", "poids", "poids_corr", "type_flux"
    )


@query(
    "weight_correct",
    f"""{_SUMS}, {VOLUME_RATES_SQL}, {FLOW_RATES_SQL}, {_BY_VOLUME}, {_BY_FLOW}, {_HISTORY}, {TO_CORRECT}, {CORRECTED}
    select code_puce, id_bac, code_tournee, code_immat, poids, flow as type_flux, round(poids_corr, 6) as poids_corr,
      count(*) as n from corrected group by all""",
)
def _weight_correct(t):
    corrected = weights.correct_weights(
        to_correct(t), _support(t), _bins(t), history(t), ntz("2000-06-30 00:00:00")
    )
    return (
        corrected.withColumn("poids_corr", F.round("poids_corr", 6))
        .groupBy("code_puce", "id_bac", "code_tournee", "code_immat", "poids", "type_flux", "poids_corr")
        .agg(F.count("*").alias("n"))
    )
