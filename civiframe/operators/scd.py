"""Slowly-changing dimensions (type 2) from daily full snapshots.

One full outer join of the active members with the snapshot says what happened to
every key; the new dimension is that join's rows rewritten, plus the closed history.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civiframe.config import BIN_DIM, PRODUCER_DIM
from civiframe.functions.dates import LOCAL_ZONE, compact_instant
from civiframe.functions.flow import chip_type, pick_frequency
from civiframe.functions.keys import surrogate_key
from civiframe.operators.clean import keep_one, stamp_day
from civiframe.operators.joins import spread_left_join

CLOSED, CREATED, SAME, UPDATED, OWNER_CHANGED = (
    "closed", "created", "unchanged", "updated", "owner_changed",
)


@dataclass(frozen=True)
class Dimension:
    """How one dimension is merged. ``owner`` names the column whose change closes a
    row and opens a new one; ``sentinels`` are key values never touched (a null key is
    always one)."""

    key: str
    id: str
    attributes: tuple[str, ...]
    owner: str | None = None
    owner_id: str | None = None
    sentinels: tuple[str, ...] = ()

    def is_sentinel(self) -> Column:
        test = F.col(self.key).isNull()
        return test | F.col(self.key).isin(*self.sentinels) if self.sentinels else test


PRODUCERS = Dimension(
    "code_producteur",
    "id_producteur",
    ("id_rva", "commune", "code_insee", "type_producteur", "activite", "latitude", "longitude"),
)
BINS = Dimension(
    "code_puce",
    "id_bac",
    ("categorie_recipient", "type_recipient", "litrage_recipient", "type_puce", "nb_collecte"),
    owner="code_producteur",
    owner_id="id_producteur",
    sentinels=("null", "INCONNU"),
)


def compare(latest: DataFrame, incoming: DataFrame, dim: Dimension) -> DataFrame:
    """Columns ``old`` and ``new`` (structs of the stored columns) and ``action`` for
    every key that is active or in the snapshot. Keys are unique on both sides."""
    columns = latest.columns
    open_rows = latest.where(F.col("date_fin").isNull() & ~dim.is_sentinel())
    arrivals = incoming.where(F.col(dim.key).isNull() | ~dim.is_sentinel()) if dim.sentinels else incoming
    types = {f.name: f.dataType for f in latest.schema.fields}
    old = open_rows.select(F.col(dim.key).alias("_old"), F.struct(*columns).alias("old"))
    new = arrivals.select(
        F.col(dim.key).cast(types[dim.key]).alias("_new"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns]).alias("new"),
    )
    compared = [*dim.attributes] + ([dim.owner] if dim.owner else [])
    same = reduce(
        lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in compared]
    )
    action = F.when(F.col("new").isNull(), CLOSED).when(F.col("old").isNull(), CREATED).when(same, SAME)
    if dim.owner:
        moved = ~F.col(f"old.{dim.owner}").eqNullSafe(F.col(f"new.{dim.owner}"))
        action = action.when(moved, OWNER_CHANGED)
    return (
        old.join(new, F.col("_old") == F.col("_new"), "full_outer")
        .select("old", "new", action.otherwise(UPDATED).alias("action"))
    )


def _row(columns: Sequence[str], side: str, **changed: Column) -> Column:
    return F.struct(*[changed.get(c, F.col(f"{side}.{c}")).alias(c) for c in columns])


def merge(
    latest: DataFrame, incoming: DataFrame, dim: Dimension, photo: Column, now: Column
) -> DataFrame:
    """New dimension: closed, created, unchanged and updated members, owner changes as
    a closed and a created row, sentinels and closed history carried over.

    ``photo`` is the snapshot's instant (end of closed rows), ``now`` the run's.
    """
    columns = latest.columns
    types = {f.name: f.dataType for f in latest.schema.fields}
    photo, now = photo.cast(types["date_fin"]), now.cast(types["date_modif"])
    nothing = F.lit(None).cast(types["date_modif"])
    action = F.col("action")

    closed = _row(columns, "old", date_fin=photo, date_modif=now)
    created = _row(columns, "new", date_modif=nothing)
    kept = {c: F.col(f"old.{c}") for c in (dim.id, "date_debut", "date_crea", "year", "month", "day")}
    if dim.owner_id:
        kept[dim.owner_id] = F.col(f"old.{dim.owner_id}")
    updated = _row(columns, "new", date_modif=now, **kept)
    reopened = _row(columns, "new", date_crea=now, date_modif=nothing)

    rows = (
        F.when(action == CLOSED, F.array(closed))
        .when(action == CREATED, F.array(created))
        .when(action == SAME, F.array(_row(columns, "old")))
        .when(action == UPDATED, F.array(updated))
    )
    if dim.owner:
        rows = rows.otherwise(F.array(closed, reopened))
    current = compare(latest, incoming, dim).select(F.inline(rows))
    carried = latest.where(F.col("date_fin").isNotNull() | dim.is_sentinel())
    return current.unionByName(carried)


def one_row_per_id(dimension: DataFrame, dim: Dimension) -> DataFrame:
    """One row per surrogate key: the open one, then the last modified."""
    order = [F.col("date_fin").desc_nulls_first(), F.col("date_modif").desc_nulls_last()]
    rest = [F.col(c) for c in dimension.columns if c not in (dim.id, "date_fin", "date_modif")]
    return keep_one(dimension, dim.id, [*order, *rest])


# -- parts of the merge, as frames of their own ---------------------------------------


def closed_members(latest: DataFrame, incoming: DataFrame, dim: Dimension) -> DataFrame:
    return compare(latest, incoming, dim).where(F.col("action") == CLOSED).select("old.*")


def new_members(latest: DataFrame, incoming: DataFrame, dim: Dimension) -> DataFrame:
    return compare(latest, incoming, dim).where(F.col("action") == CREATED).select("new.*")


def split_changes(latest: DataFrame, incoming: DataFrame, dim: Dimension) -> DataFrame:
    """Members present on both sides with ``changed`` true or false."""
    both = compare(latest, incoming, dim).where(~F.col("action").isin(CLOSED, CREATED))
    return both.select("old.*", (F.col("action") != SAME).alias("changed"))


def owner_changes(latest: DataFrame, incoming: DataFrame, dim: Dimension) -> DataFrame:
    """Same key under another owner: the row to end and the owner that follows."""
    moved = compare(latest, incoming, dim).where(F.col("action") == OWNER_CHANGED)
    return moved.select("old.*", F.col(f"new.{dim.owner}").alias("next_owner"))


# -- foreign keys -----------------------------------------------------------------------


def preserve_owner_id(incoming: DataFrame, latest: DataFrame, dim: Dimension) -> DataFrame:
    """Incoming rows keep the stored owner id while (key, owner) stays the same; among
    several stored versions the most recent one counts."""
    known = (
        latest.where(F.col(dim.key).isNotNull() & F.col(dim.owner).isNotNull())
        .groupBy(dim.key, dim.owner)
        .agg(F.max_by(dim.owner_id, "date_debut").alias("_stored"))
    )
    joined = incoming.join(known, [dim.key, dim.owner], "left")
    return joined.withColumn(dim.owner_id, F.coalesce("_stored", dim.owner_id)).select(
        *incoming.columns
    )


def default_owner_id(bins: DataFrame, producers: DataFrame) -> DataFrame:
    """Owner ids missing from the producer dimension become the unknown producer's."""
    known = producers.select(F.col("id_producteur").alias("_known")).distinct()
    unknown = producers.where(F.col("code_producteur").isNull()).agg(F.min("id_producteur"))
    # most bins may share one owner, the unknown one
    joined = spread_left_join(
        bins, known.withColumn("_found", F.lit(True)), [("id_producteur", "_known")]
    )
    return joined.withColumn(
        "id_producteur", F.when(F.col("_found"), F.col("id_producteur")).otherwise(unknown.scalar())
    ).select(*bins.columns)


# -- intake and bootstrap -----------------------------------------------------------------


def intake_producers(prepared: DataFrame, run_date: str, now: Column) -> DataFrame:
    rows = prepared.select(
        surrogate_key(F.col("code_producteur"), F.col("date_photo")).alias("id_producteur"),
        "code_producteur",
        F.col("rva_adr").alias("id_rva"),
        F.col("nom_commune").alias("commune"),
        "code_insee", "type_producteur", "activite", "latitude", "longitude",
        compact_instant(F.col("date_photo"), F.lit("000000")).alias("date_debut"),
        F.lit(None).cast("timestamp").alias("date_fin"),
        now.alias("date_crea"),
        F.lit(None).cast("timestamp").alias("date_modif"),
    )
    return stamp_day(rows, run_date)


def intake_bins(prepared: DataFrame, run_date: str, now: Column) -> DataFrame:
    rows = prepared.select(
        surrogate_key(F.col("code_puce"), F.col("date_photo")).alias("id_bac"),
        "code_puce", "code_producteur", "categorie_recipient", "type_recipient",
        "litrage_recipient",
        chip_type(F.col("code_puce")).alias("type_puce"),
        pick_frequency(
            F.col("type_recipient"), F.col("frequence_om"), F.col("frequence_cs")
        ).alias("nb_collecte"),
        compact_instant(F.col("date_photo"), F.lit("000000")).alias("date_debut"),
        F.lit(None).cast("timestamp").alias("date_fin"),
        now.alias("date_crea"),
        F.lit(None).cast("timestamp").alias("date_modif"),
        surrogate_key(F.col("code_producteur"), F.col("date_photo")).alias("id_producteur"),
    )
    return stamp_day(rows, run_date).select(*BIN_DIM.names)


# Start of the sentinels' validity and their attributes.
SENTINEL_DAY = "20200101"


def bootstrap_producers(spark: SparkSession, date: str, now: Column) -> DataFrame:
    """First producer dimension: the unknown producer only."""
    compact = F.lit(date.replace("-", ""))
    values = {
        "id_producteur": surrogate_key(F.lit("null"), compact),
        "commune": F.lit("Indetermine"),
        "activite": F.lit("Indeterminee"),
        "date_debut": compact_instant(F.lit(SENTINEL_DAY), F.lit("000000"), LOCAL_ZONE),
        "date_crea": now,
    }
    return _literal_row(spark, PRODUCER_DIM, values)


def bootstrap_bins(spark: SparkSession, date: str, now: Column) -> DataFrame:
    """First bin dimension: the bin without chip and the bin of unknown chips, both
    owned by the unknown producer."""
    compact = F.lit(date.replace("-", ""))
    common = {
        "code_producteur": F.lit(0),
        "type_recipient": F.lit("Indetermine"),
        "litrage_recipient": F.lit(0),
        "date_debut": compact_instant(F.lit(SENTINEL_DAY), F.lit("000000"), LOCAL_ZONE),
        "date_crea": now,
        "id_producteur": surrogate_key(F.lit("null"), compact),
    }
    absent = {
        "id_bac": surrogate_key(F.lit("null"), compact),
        "code_puce": F.lit("null"),
        "categorie_recipient": F.lit("Indeterminee"),
        "type_puce": F.lit("Absent"),
    }
    unknown = {
        "id_bac": surrogate_key(F.lit("INCONNU"), compact),
        "code_puce": F.lit("INCONNU"),
        "categorie_recipient": F.lit("Indetermine"),
        "type_puce": F.lit("Inconnu"),
    }
    return _literal_row(spark, BIN_DIM, {**common, **absent}).unionByName(
        _literal_row(spark, BIN_DIM, {**common, **unknown})
    )


def _literal_row(spark: SparkSession, schema, values: dict[str, Column]) -> DataFrame:
    columns = [
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    return spark.range(1).select(*columns)
