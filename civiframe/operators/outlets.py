"""Outlet tickets: typed facts of the latest month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiframe.functions.dates import us_date
from civiframe.functions.text import comma_double

# Fixed value: tickets of on-board weighings are not outlet tickets.
ON_BOARD = "PESEE EMBARQUEE"


def outlet_columns(df: DataFrame, now: Column) -> DataFrame:
    return df.select(
        F.col("immat").alias("code_immat"),
        us_date(F.col("date_service_vehic")).alias("date_mesure"),
        F.col("description_tournee").alias("code_tournee"),
        comma_double(F.col("km_realise")).alias("distance"),
        "no_bon",
        F.col("lot").alias("secteur"),
        F.col("service").alias("nb_bac"),
        F.col("nom_rech_lieu_de_vidage").alias("localisation_vidage"),
        F.col("multiples_lignes").alias("poids"),
        F.col("cle_unique_ligne_ticket").alias("type_vehicule"),
        now.alias("date_crea"),
        F.lit(None).cast("timestamp").alias("date_modif"),
    )


def latest_month(df: DataFrame, date_text: str = "date_mesure") -> DataFrame:
    """Rows of the greatest month present; the month is a scalar subquery."""
    month = F.date_format(F.col(date_text).try_cast("timestamp_ntz"), "yyyy-MM")
    return df.where(month == df.agg(F.max(month)).scalar())


def outlet_tickets_only(df: DataFrame) -> DataFrame:
    """Without on-board weighings (an unknown place is kept), with a ticket number."""
    return df.where(
        ~F.col("localisation_vidage").eqNullSafe(ON_BOARD) & F.col("no_bon").isNotNull()
    )


def analyse_outlets(df: DataFrame, now: Column, replay: bool = False) -> DataFrame:
    """Outlet facts; a replay keeps all months."""
    facts = outlet_columns(df, now)
    if not replay:
        facts = latest_month(facts)
    return outlet_tickets_only(facts).drop("no_bon")
