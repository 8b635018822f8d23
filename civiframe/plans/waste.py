"""Waste collection: prepared files, dimensions, facts, correction, places, outlets."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.config import BIN, BIN_DIM, OUTLET, PRODUCER, PRODUCER_DIM, WEIGHING
from civiframe.functions.dates import compact_instant
from civiframe.functions.text import strip_accents
from civiframe.operators.clean import (
    drop_incomplete,
    duplicate_report,
    keep_one,
    prepare_bins,
    prepare_outlets,
    prepare_producers,
    prepare_weighings,
    single_batch_date,
    stamp_day,
)
from civiframe.operators.outlets import analyse_outlets
from civiframe.operators.scd import (
    BINS,
    PRODUCERS,
    bootstrap_bins,
    bootstrap_producers,
    default_owner_id,
    intake_bins,
    intake_producers,
    merge,
    one_row_per_id,
    preserve_owner_id,
)
from civiframe.operators.spatial import attribute_places
from civiframe.operators.temporal import interval_join
from civiframe.operators.weights import (
    UNUSABLE_REFERENCE_YEAR,
    correct_weights,
    merge_history,
    with_final_flow,
    with_first_flow,
    with_plausible_weight,
)
from civiframe.sources.readers import (
    between_dates,
    day_equals,
    day_folder,
    empty_frame,
    previous_year_window,
    read_csv_config,
    read_latest,
    read_orc,
    read_orc_below,
    read_orc_day,
    read_or_empty,
    reference_month,
    support_month,
)
from civiframe.session import Staged, folders, remove_path
from civiframe.sources.sinks import (
    full_reload,
    publish_to,
    replace_day,
    replace_partition,
    write_dual,
    write_snapshot,
)

UNKNOWN_CHIP = "INCONNU"

# What the correction reads of stored weighings.
HISTORY = T.StructType([
    T.StructField("id_bac", T.LongType()), T.StructField("poids", T.DoubleType()),
    T.StructField("poids_corr", T.DoubleType()), T.StructField("date_mesure", T.TimestampType()),
])
SUPPORT = T.StructType([
    T.StructField("id_bac", T.LongType()), T.StructField("code_tournee", T.StringType()),
    T.StructField("poids", T.DoubleType()), T.StructField("date_mesure", T.TimestampType()),
])
STAGED_WEIGHING = T.StructType([*HISTORY.fields, T.StructField("type_flux", T.StringType())])


# -- preparation ----------------------------------------------------------------------------


def run_preparation(spark: SparkSession, sources: dict[str, str], target: str, date: str) -> dict:
    """Prepare the raw tables of a day, each from that day's folder alone; returns the reason
    for each table that gave no row, the others replacing the day all the same."""
    steps = {
        "producer": (PRODUCER, prepare_producers),
        "bin": (BIN, prepare_bins),
        "outlet": (OUTLET, outlet_preparation),
        "weighing": (WEIGHING, lambda raw: prepare_weighings(raw, WEIGHING)),
    }
    failures = {}
    for name, base in sources.items():
        spec, prepare = steps[name]
        raw = read_or_empty(
            spark,
            lambda base=base, spec=spec: read_csv_config(spark, day_folder(base, date), spec, base=base),
            spec.raw_schema(),
        )
        prepared = stamp_day(prepare(raw.drop("year", "month", "day")), date)
        if prepared.isEmpty():
            failures[name] = "no file, no row or rejected batch"
        else:
            replace_partition(prepared, f"{target}/{name}")
    return failures


def outlet_preparation(raw: DataFrame) -> DataFrame:
    return drop_incomplete(prepare_outlets(raw), OUTLET.names)


# -- dimensions ------------------------------------------------------------------------------


def producer_dimension(
    latest: DataFrame, prepared: DataFrame, run_date: str, photo: str, now: Column
) -> DataFrame:
    """``photo`` is the batch's ``yyyyMMdd``; it dates the closed rows."""
    incoming = intake_producers(keep_one(prepared, PRODUCER.key), run_date, now)
    moment = compact_instant(F.lit(photo), F.lit("000000"))
    return one_row_per_id(merge(latest, incoming, PRODUCERS, moment, now), PRODUCERS)


def bin_dimension(
    latest: DataFrame,
    prepared: DataFrame,
    producers: DataFrame,
    run_date: str,
    photo: str,
    now: Column,
) -> DataFrame:
    incoming = intake_bins(keep_one(prepared, BIN.key), run_date, now)
    incoming = preserve_owner_id(incoming, latest, BINS)
    moment = compact_instant(F.lit(photo), F.lit("000000"))
    merged = merge(latest, incoming, BINS, moment, now)
    return one_row_per_id(default_owner_id(merged, producers), BINS)


def run_dimensions(
    spark: SparkSession, prepared: str, base: str, run_date: str, now: Column, moment
) -> None:
    """Producers, then bins against the new producers. A table without input keeps its
    latest snapshot. Rows that share a key are reported beside the snapshot."""
    day = "/".join(f"{n}={v}" for n, v in zip(("year", "month", "day"), run_date.split("-")))

    def incoming(spec) -> DataFrame:
        return read_orc_day(spark, f"{prepared}/{spec.name}", run_date, spec.schema()).select(*spec.names)

    def latest(spec, bootstrap) -> DataFrame:
        schema = PRODUCER_DIM if spec is PRODUCER else BIN_DIM
        stored = read_or_empty(spark, lambda: read_latest(spark, f"{base}/{spec.name}"), schema)
        return bootstrap(spark, run_date, now) if stored.isEmpty() else stored

    def report(spec, batch: DataFrame) -> None:
        full_reload(duplicate_report(batch, spec.key), f"{base}/{spec.name}/{day}/duplicates")

    producers = latest(PRODUCER, bootstrap_producers)
    batch = incoming(PRODUCER)
    photo = single_batch_date(batch)
    if photo:
        built = producer_dimension(producers, batch, run_date, photo, now)
        write_snapshot(built, f"{base}/producer", f"{day}/orc", moment)
        report(PRODUCER, batch)
        producers = read_latest(spark, f"{base}/producer")
    bins = latest(BIN, bootstrap_bins)
    batch = incoming(BIN)
    photo = single_batch_date(batch)
    if photo:
        built = bin_dimension(bins, batch, producers, run_date, photo, now)
        write_snapshot(built, f"{base}/bin", f"{day}/orc", moment)
        report(BIN, batch)


# -- facts -------------------------------------------------------------------------------------


def attach_bins(prepared: DataFrame, bins: DataFrame) -> DataFrame:
    """Weighings with the bin valid at their time; a chip without valid bin gets the bin
    of unknown chips, whose category it does not take."""
    timed = prepared.withColumn(
        "date_mesure", compact_instant(F.col("Date_de_la_levee"), F.col("Heure_de_la_levee"))
    )
    versions = bins.select(
        "id_bac", F.col("code_puce").alias("_chip"), "date_debut", "date_fin",
        # accents go once per bin here instead of once per weighing
        strip_accents(F.col("categorie_recipient")).alias("categorie_recipient"),
    )
    joined = interval_join(
        timed, versions, [("Code_puce", "_chip")], "date_mesure", "date_debut", "date_fin",
        null_safe=True,
    )
    unknown = bins.where(F.col("code_puce") == UNKNOWN_CHIP).agg(F.min("id_bac"))
    return joined.withColumn("id_bac", F.coalesce(F.col("id_bac"), unknown.scalar()))


def weighing_facts(
    prepared: DataFrame, bins: DataFrame, run_date: str, now: Column, ties: str = "all"
) -> DataFrame:
    """Analysed weighings: bin, flow and plausible weight (0 marks one to correct)."""
    named = attach_bins(prepared, bins).select(
        "date_mesure",
        F.col("Code_puce").alias("code_puce"),
        "id_bac",
        F.col("Tournee").alias("code_tournee"),
        F.col("Immatriculation").alias("code_immat"),
        F.col("Pesee_net").alias("poids"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        "categorie_recipient",
    )
    classified = with_final_flow(with_first_flow(named, plain=True), ties)
    weighed = with_plausible_weight(classified).select(
        "date_mesure", "code_puce", "id_bac", "code_tournee", "code_immat", "poids", "poids_corr",
        "latitude", "longitude", now.alias("date_crea"),
        F.lit(None).cast("timestamp").alias("date_modif"), "type_flux",
    )
    return stamp_day(weighed.distinct(), run_date)


def run_weighings(
    spark: SparkSession, prepared: str, dimensions: str, staging: str, run_date: str, now: Column
) -> int:
    """Prepared weighings of a day with the latest bins to the staging table, whose day is
    replaced; returns the number of rows."""
    rows = read_orc_day(spark, prepared, run_date, WEIGHING.schema())
    bins = read_latest(spark, f"{dimensions}/bin")
    with Staged(spark) as work:
        facts = work.put(weighing_facts(rows, bins, run_date, now), "weighings")
        if not facts.isEmpty():
            replace_partition(facts, staging)
        return facts.count()


def corrected_facts(
    staged: DataFrame, support: DataFrame, bins: DataFrame, history: DataFrame, date: str
) -> DataFrame:
    """The day's weighings with corrected weights. A reference month without usable
    weights leaves them as they are."""
    if UNUSABLE_REFERENCE_YEAR in reference_month(date):
        return staged
    day = staged.where(day_equals(date))
    window = previous_year_window(support, "date_mesure", date)
    until = F.to_timestamp(F.lit(date))
    return correct_weights(day, window, bins, history, until).drop("type_flux")


def correction_plan(
    staged: DataFrame,
    support: DataFrame,
    bins: DataFrame,
    history: DataFrame,
    municipalities: DataFrame,
    districts: DataFrame,
    date: str,
    work: Staged | None = None,
) -> DataFrame:
    corrected = corrected_facts(staged, support, bins, history, date)
    return attribute_places(corrected, municipalities, districts, staged.where(day_equals(date)), work)


def day_after(date: str, days: int = 1) -> str:
    return str(datetime.date.fromisoformat(date) + datetime.timedelta(days))


def kept_states(spark: SparkSession, state: str) -> list[str]:
    """Days for which a state is kept."""
    return sorted(path.rsplit("=", 1)[1] for path in folders(spark, f"{state}/upto=*"))


def kept_history(spark: SparkSession, target: str, state: str, date: str) -> DataFrame:
    """The last weighings of each bin before a day: the newest earlier state, and the target's
    days after it, which are usually none. Without a state the whole target is read once."""
    last = max((d for d in kept_states(spark, state) if d < date), default=None)
    if last is None:
        stored = read_or_empty(spark, lambda: spark.read.orc(target).where(between_dates("0001-01-01", day_after(date, -1))), HISTORY)
        base = empty_frame(spark, HISTORY)
    else:
        base = spark.read.schema(HISTORY).orc(f"{state}/upto={last}")
        between = (day_after(last, k) for k in range(1, (datetime.date.fromisoformat(date) - datetime.date.fromisoformat(last)).days))
        found = [path for day in between for path in folders(spark, day_folder(target, day))]
        stored = spark.read.option("basePath", target).orc(found) if found else empty_frame(spark, HISTORY)
    return merge_history(base, stored, F.to_timestamp(F.lit(date)))


def run_correction(
    spark: SparkSession,
    staging: str,
    support: str,
    dimensions: str,
    target: str,
    municipalities: DataFrame,
    districts: DataFrame,
    date: str,
    state: str | None = None,
) -> int:
    """Weighings of a day from the staging table to the target, weights corrected and
    places attributed; the day is replaced. Returns the number of rows.

    The reference weights come from the month (and in the format) that ``support_month``
    names below ``support``. A bin's history is what the target holds of earlier days: ``state``
    (by default beside the target) keeps it for each day, so a run opens its day and one state.
    A rerun starts from the state before its day, and states of later days, which know the old
    rows, go; their days are read from the target when next needed. A day without staged rows
    leaves the target alone.
    """
    state = state or f"{target}_history"
    with Staged(spark) as work:
        day = read_orc_day(spark, staging, date, STAGED_WEIGHING)
        if day.isEmpty():
            return 0
        month, fmt = support_month(date)
        folder = day_folder(support, month)
        if fmt == "csv":
            read = lambda: read_csv_config(spark, f"{folder}/*", WEIGHING, base=support)
        else:
            read = lambda: read_orc_below(spark, folder)
        found = read_or_empty(spark, read, SUPPORT)
        weights = found.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in SUPPORT])
        known = work.put(kept_history(spark, target, state, date), "history")
        history = known.where(F.col("date_mesure") < F.to_timestamp(F.lit(date)))
        bins = read_latest(spark, f"{dimensions}/bin")
        year, month_, day_ = date.split("-")
        day = day.withColumns({"year": F.lit(year), "month": F.lit(month_), "day": F.lit(day_)})
        corrected = correction_plan(day, weights, bins, history, municipalities, districts, date, work)
        result = work.put(corrected, "corrected")
        for later in kept_states(spark, state):
            if later >= date:
                remove_path(spark, f"{state}/upto={later}")
        replace_day(result, target, date)
        full_reload(merge_history(known, result, F.to_timestamp(F.lit(day_after(date)))), f"{state}/upto={date}")
        return result.count()


# -- outlets and publication ----------------------------------------------------------------------


def outlet_facts(prepared: DataFrame, run_date: str, now: Column, replay: bool = False) -> DataFrame:
    return stamp_day(analyse_outlets(prepared, now, replay), run_date)


def run_outlets(
    spark: SparkSession, prepared: str, target: str, published: str, run_date: str, now: Column
) -> None:
    """Outlet facts of a day: CSV and ORC copies under the day's folder, and that day
    replaced in the published table."""
    rows = read_orc_day(spark, prepared, run_date, OUTLET.schema()).select(*OUTLET.names)
    year, month, day = run_date.split("-")
    with Staged(spark) as work:
        facts = work.put(outlet_facts(rows, run_date, now), "outlets")
        write_dual(facts, f"{target}/year={year}/month={month}/day={day}", mode="overwrite")
        replace_partition(facts, published)


def run_exposure(
    spark: SparkSession, source: str, date: str, reloads: list[str], replaces: list[str] = (), snapshot: bool = False
) -> bool:
    """A day's stored rows (or with ``snapshot`` the ORC snapshot below the day's folder) to their
    published targets. Nothing is published, and False returned, if there is no row."""
    day = day_folder(source, date)
    stored = read_or_empty(
        spark, lambda: read_orc(spark, f"{day}/orc" if snapshot else day, base=source), T.StructType()
    )
    if not stored.columns or stored.isEmpty():
        return False
    publish_to(stored, reloads, replaces)
    return True
