"""Slowly-changing dimensions: parts of the merge, whole merges and both in a row."""

from pyspark.sql import functions as F

from civiframe.catalog import standins as S
from civiframe.catalog.registry import query, seconds_text, sql_paris_epoch, sql_surrogate_key
from civiframe.operators import scd
from civiframe.plans.waste import bin_dimension, producer_dimension
from civiframe.session import stage

PHOTO, NOW = "2022-03-01 00:00:00", "2022-03-02 13:00:00"


def _readable(df):
    """Timestamps as text, so that results do not depend on the session zone."""
    stamps = ("date_debut", "date_fin", "date_crea", "date_modif")
    return df.withColumns({c: seconds_text(F.col(c)) for c in stamps if c in df.columns})


_TEXT_DATES = """replace (strftime(date_debut, '%Y-%m-%d %H:%M:%S') as date_debut,
  strftime(date_fin, '%Y-%m-%d %H:%M:%S') as date_fin, strftime(date_crea, '%Y-%m-%d %H:%M:%S') as date_crea,
  strftime(date_modif, '%Y-%m-%d %H:%M:%S') as date_modif)"""

_P = f"""with {S.PRODUCER_TABLES},
 active as (select * from latest_producers where date_fin is null and code_producteur is not null)"""
_P_SAME = " and ".join(
    f"n.{c} is not distinct from a.{c}"
    for c in ("id_rva", "commune", "code_insee", "type_producteur", "activite", "latitude", "longitude")
)


@query(
    "scd_deleted",
    f"""{_P} select id_producteur, code_producteur, activite from active a
    where not exists (select 1 from incoming_producers n where n.code_producteur = a.code_producteur)""",
)
def _scd_deleted(t):
    gone = scd.closed_members(S.latest_producers(t), S.incoming_producers(t), scd.PRODUCERS)
    return gone.select("id_producteur", "code_producteur", "activite")


@query(
    "scd_created",
    f"""{_P} select id_producteur, code_producteur, activite from incoming_producers n
    where not exists (select 1 from active a where n.code_producteur = a.code_producteur)""",
)
def _scd_created(t):
    new = scd.new_members(S.latest_producers(t), S.incoming_producers(t), scd.PRODUCERS)
    return new.select("id_producteur", "code_producteur", "activite")


@query(
    "scd_changed",
    f"""{_P} select a.id_producteur, a.code_producteur, not ({_P_SAME}) as changed
    from active a join incoming_producers n on n.code_producteur = a.code_producteur""",
)
def _scd_changed(t):
    both = scd.split_changes(S.latest_producers(t), S.incoming_producers(t), scd.PRODUCERS)
    return both.select("id_producteur", "code_producteur", "changed")


_PRODUCER_COLUMNS = (
    "id_producteur, code_producteur, id_rva, commune, code_insee, type_producteur, activite, latitude, longitude, "
    "date_debut, date_fin, date_crea, date_modif, year, month, day"
)


@query(
    "scd2_producer",
    f"""{_P}, merged as (
      select a.* replace (timestamp '{PHOTO}' as date_fin, timestamp '{NOW}' as date_modif) from active a
        where not exists (select 1 from incoming_producers n where n.code_producteur = a.code_producteur)
      union all select n.* from incoming_producers n
        where not exists (select 1 from active a where n.code_producteur = a.code_producteur)
      union all select a.* from active a join incoming_producers n on n.code_producteur = a.code_producteur where {_P_SAME}
      union all select n.* replace (a.id_producteur as id_producteur, a.date_debut as date_debut, a.date_crea as date_crea,
          timestamp '{NOW}' as date_modif, a.year as year, a.month as month, a.day as day)
        from active a join incoming_producers n on n.code_producteur = a.code_producteur where not ({_P_SAME})
      union all select * from latest_producers where date_fin is not null or code_producteur is null)
    select * {_TEXT_DATES} from merged""",
)
def _scd2_producer(t):
    merged = scd.merge(
        S.latest_producers(t), S.incoming_producers(t), scd.PRODUCERS, F.lit(PHOTO), F.lit(NOW)
    )
    return _readable(scd.one_row_per_id(merged, scd.PRODUCERS))


_B = f"""with {S.BIN_TABLES},
 active as (select * from latest_bins where date_fin is null and code_puce not in ('null', 'INCONNU'))"""
_B_SAME = " and ".join(
    f"n.{c} is not distinct from a.{c}"
    for c in (
        "code_producteur", "categorie_recipient", "type_recipient", "litrage_recipient", "type_puce", "nb_collecte",
    )
)


@query(
    "owner_change_theta",
    f"""{_B} select a.id_bac, a.code_puce, a.code_producteur, n.code_producteur as next_owner
    from active a join incoming_bins n on n.code_puce = a.code_puce and n.code_producteur <> a.code_producteur""",
)
def _owner_change_theta(t):
    moved = scd.owner_changes(S.latest_bins(t), S.incoming_bins(t), scd.BINS)
    return moved.select("id_bac", "code_puce", "code_producteur", "next_owner")


@query(
    "fk_preserve",
    f"""{_B} select n.code_puce, n.code_producteur, coalesce(l.id_producteur, n.id_producteur) as id_producteur
    from incoming_bins n left join latest_bins l
      on l.code_puce = n.code_puce and l.code_producteur = n.code_producteur""",
)
def _fk_preserve(t):
    kept = scd.preserve_owner_id(S.incoming_bins(t), S.latest_bins(t), scd.BINS)
    return kept.select("code_puce", "code_producteur", "id_producteur")


# owners of the bins: suppliers with money, plus the unknown one
_OWNERS = """owners as (select s_suppkey * 10 + 1 as id_producteur, cast(s_suppkey as integer) as code_producteur
  from supplier where s_acctbal >= 0 union all select -1, null)"""


def _owners(t):
    known = t.supplier.where(F.col("s_acctbal") >= 0).select(
        (F.col("s_suppkey") * 10 + 1).alias("id_producteur"),
        F.col("s_suppkey").cast("int").alias("code_producteur"),
    )
    unknown = t.spark.range(1).select(
        F.lit(-1).cast("long").alias("id_producteur"), F.lit(None).cast("int").alias("code_producteur")
    )
    return known.unionByName(unknown)


@query(
    "fk_default",
    f"""with {S.BIN_TABLES}, {_OWNERS} select b.id_bac, b.code_puce, coalesce(o.id_producteur, -1) as id_producteur
    from latest_bins b left join owners o on o.id_producteur = b.id_producteur""",
)
def _fk_default(t):
    return scd.default_owner_id(S.latest_bins(t), _owners(t)).select("id_bac", "code_puce", "id_producteur")


@query(
    "scd2_bin",
    f"""{_B}, {_OWNERS}, incoming as (
      select n.* replace (coalesce(l.id_producteur, n.id_producteur) as id_producteur)
      from incoming_bins n left join latest_bins l on l.code_puce = n.code_puce and l.code_producteur = n.code_producteur),
    merged as (
      select a.* replace (timestamp '{PHOTO}' as date_fin, timestamp '{NOW}' as date_modif) from active a
        where not exists (select 1 from incoming n where n.code_puce = a.code_puce)
      union all select n.* from incoming n where not exists (select 1 from active a where n.code_puce = a.code_puce)
      union all select a.* from active a join incoming n on n.code_puce = a.code_puce where {_B_SAME}
      union all select n.* replace (a.id_bac as id_bac, a.id_producteur as id_producteur, a.date_debut as date_debut,
          a.date_crea as date_crea, timestamp '{NOW}' as date_modif, a.year as year, a.month as month, a.day as day)
        from active a join incoming n on n.code_puce = a.code_puce
        where not ({_B_SAME}) and n.code_producteur = a.code_producteur
      union all select a.* replace (timestamp '{PHOTO}' as date_fin, timestamp '{NOW}' as date_modif)
        from active a join incoming n on n.code_puce = a.code_puce where n.code_producteur <> a.code_producteur
      union all select n.* replace (timestamp '{NOW}' as date_crea)
        from active a join incoming n on n.code_puce = a.code_puce where n.code_producteur <> a.code_producteur
      union all select * from latest_bins where date_fin is not null or code_puce in ('null', 'INCONNU'))
    select m.* replace (coalesce(o.id_producteur, -1) as id_producteur,
      strftime(date_debut, '%Y-%m-%d %H:%M:%S') as date_debut, strftime(date_fin, '%Y-%m-%d %H:%M:%S') as date_fin,
      strftime(date_crea, '%Y-%m-%d %H:%M:%S') as date_crea, strftime(date_modif, '%Y-%m-%d %H:%M:%S') as date_modif)
    from merged m left join owners o on o.id_producteur = m.id_producteur""",
)
def _scd2_bin(t):
    latest = S.latest_bins(t)
    incoming = scd.preserve_owner_id(S.incoming_bins(t), latest, scd.BINS)
    merged = scd.merge(latest, incoming, scd.BINS, F.lit(PHOTO), F.lit(NOW))
    return _readable(scd.one_row_per_id(scd.default_owner_id(merged, _owners(t)), scd.BINS))


# -- both dimensions from prepared files, first and second day -----------------------------------


def _prepared_producers(t, photo: str):
    return t.customer.select(
        F.col("c_custkey").cast("int").alias("code_producteur"),
        F.col("c_nationkey").alias("rva_adr"),
        (F.col("c_nationkey") + 35000).alias("code_insee"),
        F.col("c_name").alias("nom_commune"),
        F.col("c_mktsegment").alias("type_producteur"),
        F.lit("Pavillon").alias("activite"),
        (F.col("c_acctbal") / 1000).alias("longitude"),
        (F.col("c_acctbal") / 2000).alias("latitude"),
        F.lit(photo).alias("date_photo"),
    )


def _prepared_bins(t, photo: str, later: bool):
    owner = F.when(F.lit(later) & (F.col("p_brand") == "Brand#4"), F.col("p_size") + 1).otherwise(F.col("p_size"))
    return t.part.select(
        owner.alias("code_producteur"),
        F.coalesce(S.category(), F.lit("Bacs papier")).alias("categorie_recipient"),
        F.when(F.col("p_type") == "LARGE", "Bac CS 360 l")
        .when(F.col("p_type") == "ECONOMY", "Bac PNM OM 240 l")
        .otherwise("Bac")
        .alias("type_recipient"),
        S.volume().alias("litrage_recipient"),
        F.concat(F.lit("C"), "p_partkey").alias("code_puce"),
        (F.col("p_size") % 3).alias("frequence_om"),
        (F.col("p_size") / 4.0).alias("frequence_cs"),
        F.lit(photo).alias("date_photo"),
    )


_KEY = sql_surrogate_key
_DAY_1, _DAY_2 = (sql_paris_epoch(f"timestamp '{d}'") for d in ("2022-02-25", "2022-02-26"))


@query(
    "pipe_dimensions",
    f"""with src as (select 'C' || p_partkey as code_puce, p_size as owner_1, p_brand,
        case when p_brand = 'Brand#4' then p_size + 1 else p_size end as owner_2,
        case p_type when 'LARGE' then p_size / 4.0 when 'ECONOMY' then cast(p_size % 3 as double) else 0.0 end as nb_collecte
      from part),
    day_1 as (select code_puce || '20220225' as key_text, owner_1 || '20220225' as owner_text, code_puce,
        owner_1 as code_producteur, nb_collecte, {_DAY_1} as start_at,
        case when p_brand = 'Brand#4' then {_DAY_2} end as end_at, '25' as day from src),
    day_2 as (select code_puce || '20220226', 'null20220225', code_puce, owner_2, nb_collecte, {_DAY_2}, null, '26'
      from src where p_brand = 'Brand#4'),
    every as (select * from day_1 union all select * from day_2),
    sentinels as (select 'null20220225' as key_text, 'null20220225' as owner_text, 'null' as code_puce, 0 as code_producteur,
        cast(null as double) as nb_collecte, {sql_paris_epoch("timestamp '2020-01-01'")} as start_at, null as end_at, cast(null as varchar) as day
      union all select 'INCONNU20220225', 'null20220225', 'INCONNU', 0, null, {sql_paris_epoch("timestamp '2020-01-01'")}, null, null),
    owned as (select e.* replace (case when c.c_custkey is null then 'null20220225' else owner_text end as owner_text)
      from every e left join customer c on c.c_custkey = e.code_producteur),
    rows_ as (select * from owned union all select * from sentinels)
    select {_KEY('key_text')} as id_bac, code_puce, code_producteur, nb_collecte, start_at, end_at, day,
           {_KEY('owner_text')} as id_producteur from rows_""",
)
def _pipe_dimensions(t):
    """Two days in a row from the first, empty dimension, each day's snapshot stored as the
    job does. On the second day some bins have
    a new owner; its id is made with that day's photo, which no producer carries, so
    these bins belong to the unknown producer."""
    now = F.lit("2022-02-25 13:00:00").cast("timestamp")
    days = (("2022-02-25", "20220225", False), ("2022-02-26", "20220226", True))
    producers = scd.bootstrap_producers(t.spark, days[0][0], now)
    bins = scd.bootstrap_bins(t.spark, days[0][0], now)
    for run_date, photo, later in days:
        producers = stage(
            producer_dimension(producers, _prepared_producers(t, photo), run_date, photo, now),
            "producers",
        )
        prepared = _prepared_bins(t, photo, later)
        bins = stage(bin_dimension(bins, prepared, producers, run_date, photo, now), "bins")
    return bins.select(
        "id_bac", "code_puce", "code_producteur", "nb_collecte",
        F.unix_seconds("date_debut").alias("start_at"), F.unix_seconds("date_fin").alias("end_at"),
        "day", "id_producteur",
    )


@query(
    "dim_bootstrap",
    f"""with {S.PRODUCER_TABLES}
    select {_KEY("'null20220225'")} as id_producteur, cast(null as integer) as code_producteur,
      'Indetermine' as commune, 'Indeterminee' as activite, {sql_paris_epoch("timestamp '2020-01-01'")} as start_at
    union all select id_producteur, code_producteur, commune, activite, cast(epoch(date_debut) as bigint)
    from incoming_producers""",
)
def _dim_bootstrap(t):
    now = F.lit("2022-02-25 13:00:00").cast("timestamp")
    first = scd.bootstrap_producers(t.spark, "2022-02-25", now)
    columns = ["id_producteur", "code_producteur", "commune", "activite"]
    day_zero = F.lit("1970-01-01").cast("timestamp_ntz")
    arrived = S.incoming_producers(t).select(
        *columns,
        F.timestamp_diff("SECOND", day_zero, F.col("date_debut")).alias("start_at"),
    )
    return first.select(*columns, F.unix_seconds("date_debut").alias("start_at")).unionByName(arrived)


@query(
    "producer_bin_join",
    """select l_orderkey, l_linenumber, s_suppkey, s_name, l_quantity from lineitem join supplier on s_suppkey = l_suppkey""",
)
def _producer_bin_join(t):
    bins = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"), "l_quantity")
    return bins.join(t.supplier.select("s_suppkey", "s_name"), "s_suppkey").select(
        "l_orderkey", "l_linenumber", "s_suppkey", "s_name", "l_quantity"
    )
