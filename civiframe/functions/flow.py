"""Waste-flow classification and weight plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flow labels and the texts that identify them.
CATEGORY_FLOW = {
    "Bacs ordures menageres": "OM",
    "Bacs collecte selective": "CS",
    "Bacs verre": "Verre",
    "Bacs biodechets": "Biodechets",
}
ROUND_SUFFIX_FLOW = {"OM": "OM", "CS": "CS", "VE": "Verre", "BIO": "Biodechets"}
OTHER_CATEGORIES = ("Bacs carton", "Bacs papier", "Composteurs")
OTHER = "Autres"
UNKNOWN = "Inconnu"
UNKNOWN_ON_KNOWN_TRUCK = "Inconnu_connu"
CHIP_KNOWN = "Connu"

# Exclusive upper weight limit per flow (the lower limit is 0).
WEIGHT_LIMIT = {"OM": 120.0, "CS": 40.0, "Verre": 240.0}
DEFAULT_WEIGHT_LIMIT = 250.0
DEFAULT_LIMIT_FLOWS = ("Biodechets", "Inconnu", "Autres")


def chip_type(chip: Column) -> Column:
    return F.when(chip.isNull(), UNKNOWN).otherwise(CHIP_KNOWN)


def pick_frequency(bin_type: Column, freq_om: Column, freq_cs: Column) -> Column:
    """Collections per week by the bin type's text. A missing selective-collection
    frequency makes the result null whatever the type."""
    return F.when(
        freq_cs.isNotNull(),
        F.when(F.contains(bin_type, F.lit(" CS ")), freq_cs.cast("double"))
        .when(F.contains(bin_type, F.lit(" OM ")), freq_om.cast("double"))
        .otherwise(0.0),
    )


def classify_flow(plain: Column, round_code: Column, truck: Column) -> Column:
    """First pass: bin category (without accents), then suffix of the round, then whether
    a truck is known."""
    rules = [(F.contains(plain, F.lit(text)), flow) for text, flow in CATEGORY_FLOW.items()]
    rules += [(F.endswith(round_code, F.lit(end)), flow) for end, flow in ROUND_SUFFIX_FLOW.items()]
    for text in OTHER_CATEGORIES:
        rules.append((F.contains(plain, F.lit(text)), OTHER))
    rules.append((plain.isNull() & truck.isNotNull(), UNKNOWN_ON_KNOWN_TRUCK))

    (first_test, first_flow), *others = rules
    flow = F.when(first_test, first_flow)
    for test, value in others:
        flow = flow.when(test, value)
    return flow.otherwise(UNKNOWN)


def round_tells_flow(round_code: Column) -> Column:
    """True when the round's suffix names a flow; false for a missing round."""
    tells = F.lit(False)
    for end in ROUND_SUFFIX_FLOW:
        tells = tells | F.endswith(round_code, F.lit(end))
    return F.coalesce(tells, F.lit(False))


def flow_for_truck_mode(flow: Column) -> Column:
    """Second pass, the value counted per truck. Rows still unknown carry no bin
    category, so they count as plain unknown."""
    return F.when(flow == UNKNOWN_ON_KNOWN_TRUCK, UNKNOWN).otherwise(flow)


def final_flow(flow: Column, truck_mode: Column) -> Column:
    """Last pass: unknown rows take their truck's most frequent flow; a flow outside
    the four main ones ends as unknown."""
    return (
        F.when(flow.isin(UNKNOWN, UNKNOWN_ON_KNOWN_TRUCK), F.coalesce(truck_mode, F.lit(UNKNOWN)))
        .when(flow.isin(*CATEGORY_FLOW.values()), flow)
        .otherwise(UNKNOWN)
    )


def plausible_weight(weight: Column, flow: Column) -> Column:
    """The weight when it lies in its flow's open range, else 0.0."""
    limit = F.when(flow.isNull(), DEFAULT_WEIGHT_LIMIT)
    for name, value in WEIGHT_LIMIT.items():
        limit = limit.when(flow == name, value)
    for name in DEFAULT_LIMIT_FLOWS:
        limit = limit.when(F.contains(flow, F.lit(name)), DEFAULT_WEIGHT_LIMIT)
    return F.when((weight > 0) & (weight < limit), weight).otherwise(F.lit(0.0))
