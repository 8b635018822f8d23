"""Flow of each weighing, reference rates and weight correction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiframe.functions.flow import (
    DEFAULT_WEIGHT_LIMIT,
    OTHER,
    UNKNOWN,
    UNKNOWN_ON_KNOWN_TRUCK,
    classify_flow,
    final_flow,
    flow_for_truck_mode,
    plausible_weight,
    round_tells_flow,
)
from civiframe.functions.text import strip_accents
from civiframe.operators.joins import spread_left_join

# Default rates by bin category and volume.
VOLUME_RATES = [
    ("OM140", "Bacs ordures ménagères", "120-140", 9.7),
    ("OM180", "Bacs ordures ménagères", "180", 12.4),
    ("OM240", "Bacs ordures ménagères", "240", 17.6),
    ("OM360", "Bacs ordures ménagères", "330-340-360", 27.6),
    ("OM400", "Bacs ordures ménagères", "400", 22.0),
    ("OM660", "Bacs ordures ménagères", "500-660", 46.4),
    ("OM770", "Bacs ordures ménagères", "750-770-1000", 52.7),
    ("CS140", "Bacs collecte sélective", "120-140", 5.2),
    ("CS180", "Bacs collecte sélective", "180", 6.8),
    ("CS240", "Bacs collecte sélective", "240", 7.6),
    ("CS360", "Bacs collecte sélective", "330-340-360", 10.7),
    ("CS660", "Bacs collecte sélective", "500-660", 21.9),
    ("CS770", "Bacs collecte sélective", "750-770-1000", 24.1),
    ("BIO140", "Bacs biodéchets", "120-140", 34.9),
    ("BIO240", "Bacs biodéchets", "240", 29.1),
    ("BIO400", "Bacs biodéchets", "400", 64.5),
    ("VE240", "Bacs verre", "240", 46.6),
    ("VE400", "Bacs verre", "400", 71.6),
    ("VE770", "Bacs verre", "750-770-1000", 72.1),
]

# Default rates by flow code, for weighings without a known bin.
FLOW_RATES = [
    ("OMglobal", "OM", 17.8),
    ("CSglobal", "CS", 9.2),
    ("BIOglobal", "BIO", 53.5),
    ("VEglobal", "VE", 60.5),
]

# Which bin volumes use which rate.
RATE_VOLUMES = {
    "OM": {
        "OM140": ("1", "120", "140"), "OM180": ("180",), "OM240": ("240",),
        "OM360": ("330", "340", "360"), "OM400": ("400",), "OM660": ("500", "660"),
        "OM770": ("750", "770", "1000"),
    },
    "CS": {
        "CS140": ("1", "120", "140"), "CS180": ("180",), "CS240": ("240",),
        "CS360": ("330", "340", "360"), "CS660": ("500", "660"), "CS770": ("750", "770", "1000"),
    },
    "Verre": {"VE240": ("240",), "VE400": ("400", "660"), "VE770": ("750", "770", "1000")},
    "Biodechets": {"BIO140": ("120", "140"), "BIO240": ("240",), "BIO400": ("400",)},
}
FLOW_GLOBAL_RATE = {
    "OM": "OMglobal", "CS": "CSglobal", "Verre": "VEglobal", "Biodechets": "BIOglobal",
}

HISTORY_LENGTH = 6
MIN_SAMPLES = 50
# Reference months of this year hold no usable weights: nothing is corrected.
UNUSABLE_REFERENCE_YEAR = "2020"


def volume_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        VOLUME_RATES, "rate STRING, category STRING, volumes STRING, default_rate DOUBLE"
    )


def flow_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FLOW_RATES, "rate STRING, flow_code STRING, default_rate DOUBLE")


# -- flow classification ------------------------------------------------------------------


def with_first_flow(df: DataFrame, plain: bool = False) -> DataFrame:
    """First flow. ``plain`` says that the category is without accents already. The
    stripped text is a column of its own, so it is made once for all the rules."""
    category = F.col("categorie_recipient")
    stripped = df.withColumn("_plain", category if plain else strip_accents(category))
    flow = classify_flow(F.col("_plain"), F.col("code_tournee"), F.col("code_immat"))
    return stripped.withColumn("type_flux", flow).drop("_plain")


def truck_flow_mode(classified: DataFrame, ties: str = "all") -> DataFrame:
    """Most frequent flow of each truck that has unclassified weighings, counted on its
    weighings without a round. All tied flows are kept, or the first by name.

    Counts are aggregated before the window, which therefore sees at most one row per
    truck and flow. The trucks concerned come from the same aggregation.
    """
    # only these rounds can be missing or leave a weighing unclassified; the test needs
    # the weighing alone, so it filters before any join with the bins
    on_truck = classified.where(
        F.col("code_immat").isNotNull() & ~round_tells_flow(F.col("code_tournee"))
    )
    counted = (
        on_truck.groupBy("code_immat", flow_for_truck_mode(F.col("type_flux")).alias("flow"))
        .agg(
            F.count_if(F.col("code_tournee").isNull()).alias("n"),
            F.max(F.col("type_flux") == UNKNOWN_ON_KNOWN_TRUCK).alias("_unclassified"),
            F.min(F.when(F.col("code_tournee").isNull(), F.col("date_mesure"))).alias("_first"),
            F.max(F.when(F.col("code_tournee").isNull(), F.col("date_mesure"))).alias("_last"),
        )
    )
    truck = Window.partitionBy("code_immat")
    by_count = truck.orderBy(F.desc("n"), *(["flow"] if ties == "first" else []))
    rank = F.row_number() if ties == "first" else F.rank()
    return (
        counted.withColumns(
            {
                "_concerned": F.max("_unclassified").over(truck),
                "date_min": F.min("_first").over(truck),
                "date_max": F.max("_last").over(truck),
            }
        )
        .where(F.col("_concerned") & (F.col("n") > 0))
        .withColumn("_rank", rank.over(by_count))
        .where("_rank = 1")
        .select("code_immat", F.col("flow").alias("truck_flow"), "n", "date_min", "date_max")
    )


def with_final_flow(classified: DataFrame, ties: str = "all") -> DataFrame:
    """Unknown weighings take their truck's mode (one row per tied flow)."""
    mode = truck_flow_mode(classified, ties).select("code_immat", "truck_flow")
    joined = spread_left_join(classified, mode, [("code_immat", "code_immat")])
    return joined.withColumn(
        "type_flux", final_flow(F.col("type_flux"), F.col("truck_flow"))
    ).drop("truck_flow")


def with_plausible_weight(df: DataFrame) -> DataFrame:
    return df.withColumn("poids_corr", plausible_weight(F.col("poids"), F.col("type_flux")))


# -- reference rates ------------------------------------------------------------------------


def _usable(weight: Column) -> Column:
    return (weight > 0) & (weight < DEFAULT_WEIGHT_LIMIT)


#: Kinds of reference rates.
BY_VOLUME, BY_FLOW, OVERALL = "volume", "flow", "overall"


def reference_averages(support: DataFrame, bins: DataFrame) -> DataFrame:
    """``(kind, rate, average, n)``: every average of the usable reference weights in one pass.

    Weights are summed per bin and flow code, so bins join few rows; grouping sets then give the sums
    per category and volume, per flow code and overall. What is left is as small as the lists of
    volumes and rounds; each sum goes to the rates it belongs to. A volume is searched as a
    substring of the rate's volume list, so it may count for several.
    """
    flow_code = F.get(F.split("code_tournee", "-"), F.lit(2))
    sums = (
        support.where(_usable(F.col("poids")))
        .groupBy("id_bac", flow_code.alias("flow_code"))
        .agg(F.sum("poids").alias("total"), F.count("*").alias("n"))
    )
    # a bin that is listed twice counts twice for its volumes and once for the rest
    volumes = bins.groupBy("id_bac").agg(F.collect_list(F.struct("categorie_recipient", "litrage_recipient")).alias("v"))
    known = sums.join(volumes.hint("merge"), "id_bac", "left").select("flow_code", "total", "n", F.posexplode_outer("v"))
    once = F.coalesce("pos", F.lit(0)) == 0
    grouped = (
        known.select("*", "col.*")
        .groupingSets(
            [["categorie_recipient", "litrage_recipient"], ["flow_code"], []],
            "categorie_recipient", "litrage_recipient", "flow_code",
        )
        .agg(
            F.grouping_id().alias("_set"), F.sum("total").alias("total"), F.sum("n").alias("n"),
            F.sum(F.when(once, F.col("total"))).alias("total_once"), F.sum(F.when(once, F.col("n"))).alias("n_once"),
        )
    )
    by_volume = F.array_compact(F.array(*[
        F.when((F.col("categorie_recipient") == category) & F.contains(F.lit(volume), F.col("litrage_recipient").cast("string")), rate)
        for rate, category, volume, _ in VOLUME_RATES
    ]))
    by_flow = F.array_compact(F.array(*[F.when(F.col("flow_code") == code, rate) for rate, code, _ in FLOW_RATES]))
    # bits of the id stand for the columns that a set leaves out
    kind = F.when(F.col("_set") == 1, BY_VOLUME).when(F.col("_set") == 6, BY_FLOW).otherwise(OVERALL)
    rates = F.when(kind == BY_VOLUME, by_volume).when(kind == BY_FLOW, by_flow).otherwise(F.array(F.lit(None).cast("string")))
    return (
        grouped.select(
            kind.alias("kind"), F.explode(rates).alias("rate"),
            *[F.when(kind == BY_VOLUME, F.col(c)).otherwise(F.col(f"{c}_once")).alias(c) for c in ("total", "n")],
        )
        .groupBy("kind", "rate")
        .agg((F.sum("total") / F.sum("n")).alias("average"), F.sum("n").alias("n"))
        .where("n > 0")
    )


def rate_by_volume(averages: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Average weight per category and volume, where more than ``min_samples`` exist."""
    return averages.where((F.col("kind") == BY_VOLUME) & (F.col("n") > min_samples)).select("rate", "average", "n")


def rate_by_flow(averages: DataFrame) -> DataFrame:
    """Average weight per flow code found in the round name."""
    return averages.where(F.col("kind") == BY_FLOW).select("rate", "average", "n")


def rate_global(averages: DataFrame) -> DataFrame:
    return averages.where(F.col("kind") == OVERALL).select("average", "n")


def rates_with_default(rates: DataFrame, averages: DataFrame) -> DataFrame:
    """The fixed rate list with computed averages where they exist. Both sides hold at
    most one row per fixed rate."""
    return rates.join(F.broadcast(averages.select("rate", "average")), "rate", "left").select(
        "rate", F.coalesce("average", "default_rate").alias("weight")
    )


# -- history and correction -------------------------------------------------------------------


def last_weights(
    history: DataFrame, until: Column | None = None, length: int = HISTORY_LENGTH
) -> DataFrame:
    """The last ``length`` weighings of each bin that were not corrected. Ranking comes
    first, so a corrected weighing uses up its place. The rank limit is applied
    before the shuffle: a bin with most of the rows sends ``length`` of them."""
    rows = history.select("id_bac", "poids", "poids_corr", "date_mesure")
    if until is not None:
        rows = rows.where(F.col("date_mesure") <= until)
    recent = Window.partitionBy("id_bac").orderBy(F.desc("date_mesure"), "poids", "poids_corr")
    return (
        rows.withColumn("history_value", F.row_number().over(recent))
        .where(F.col("history_value") <= length)
        .where(F.col("poids") == F.col("poids_corr"))
    )


def merge_history(
    state: DataFrame, rows: DataFrame, before: Column, length: int = HISTORY_LENGTH
) -> DataFrame:
    """The kept state ``(id_bac, poids, poids_corr, date_mesure)`` after more rows: what
    ``last_weights`` needs of everything seen so far, ``length`` rows for each bin. Rows dated
    ``before`` or later stay beside them unranked, as they do not count yet."""
    columns = ["id_bac", "poids", "poids_corr", "date_mesure"]
    seen = state.select(*columns).unionByName(rows.select(*columns)).withColumn("_due", F.coalesce(F.col("date_mesure") < before, F.lit(True)))
    recent = Window.partitionBy("id_bac", "_due").orderBy(F.desc("date_mesure"), "poids", "poids_corr")
    ranked = seen.withColumn("_rank", F.when(F.col("_due"), F.row_number().over(recent)).otherwise(0))
    return ranked.where(F.col("_rank") <= length).select(*columns)


def history_average(last: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """Average of bins whose last ``length`` weighings were all valid."""
    return (
        last.groupBy("id_bac")
        .agg(F.avg("poids").alias("average"), F.count("poids").alias("n"))
        .where(F.col("n") == length)
    )


def short_history(last: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """Bins with some, but fewer than ``length``, valid weighings."""
    return last.groupBy("id_bac").agg(F.count("poids").alias("n")).where(F.col("n") < length)


def rate_name(flow: Column, volume: Column) -> Column:
    """Rate that replaces a weight: by flow and volume, else the flow's global rate;
    null means the overall average."""
    name = F.when(flow.isin(OTHER, UNKNOWN), F.lit(None).cast("string"))
    for label, by_volume in RATE_VOLUMES.items():
        for rate, volumes in by_volume.items():
            name = name.when((flow == label) & volume.isin(*volumes), rate)
    for label, rate in FLOW_GLOBAL_RATE.items():
        name = name.when(flow == label, rate)
    return name


def correct_weights(
    to_correct: DataFrame,
    support: DataFrame,
    bins: DataFrame,
    history: DataFrame,
    until: Column,
    *,
    min_samples: int = MIN_SAMPLES,
    length: int = HISTORY_LENGTH,
) -> DataFrame:
    """Implausible weights (stored as 0) replaced by the bin's own recent average, else
    by the rate of its flow and volume, else of its flow, else the overall average."""
    averages = reference_averages(support, bins)
    counted = averages.where((F.col("kind") != BY_VOLUME) | (F.col("n") > min_samples))
    # one row with an entry for each fixed rate and the overall average
    found = counted.agg(
        F.map_from_entries(F.collect_list(F.struct(F.coalesce("rate", F.lit(OVERALL)), "average"))).alias("m")
    ).scalar()
    default = F.create_map(*[F.lit(v) for rate, *_, weight in [*VOLUME_RATES, *FLOW_RATES] for v in (rate, weight)])
    own = history_average(last_weights(history, until, length), length).select(
        "id_bac", F.col("average").alias("own_average")
    )
    volumes = bins.select("id_bac", F.col("litrage_recipient").cast("string").alias("volume"))
    known = volumes.join(own, "id_bac", "full_outer").withColumnRenamed("id_bac", "_bin")
    joined = (
        spread_left_join(to_correct, known, [("id_bac", "_bin")], shuffled=True)
        .withColumn(
            "_weight",
            F.when(F.col("poids_corr") == 0, F.col("own_average")).otherwise(F.col("poids_corr")),
        )
        .withColumn("_rate", rate_name(F.col("type_flux"), F.col("volume")))
        .withColumn("_averages", found)
    )
    by_rate = F.when(
        F.col("_rate").isNotNull(),
        F.coalesce(F.try_element_at("_averages", F.col("_rate")), F.try_element_at(default, F.col("_rate"))),
    )
    corrected = F.coalesce(F.round("_weight", 2), by_rate, F.try_element_at("_averages", F.lit(OVERALL)))
    return joined.withColumn("poids_corr", corrected).select(*to_correct.columns)
