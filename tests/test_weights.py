import datetime
import random

from pyspark.sql import functions as F

from civiframe.operators import weights
from civiframe.plans.waste import weighing_facts

FACT = ("code_puce string, categorie_recipient string, code_tournee string, code_immat string, poids double,"
        " date_mesure timestamp_ntz")
AT = datetime.datetime(2022, 1, 1, 6)


def classified(spark, rows):
    return weights.with_first_flow(spark.createDataFrame([(*r, AT) for r in rows], FACT))


def test_mode_counts_rounds_missing_only_and_keeps_ties(spark):
    rows = [
        ("1", None, None, "T1", 1.0),  # unclassified: makes T1 a concerned truck
        ("2", "Bacs verre", None, "T1", 1.0),
        ("3", "Bacs verre", "R-1-VE", "T1", 1.0),  # has a round: not counted
        ("4", "Bacs verre", None, "T2", 1.0),  # T2 has nothing unclassified
    ]
    mode = weights.truck_flow_mode(classified(spark, rows)).collect()
    assert sorted((r.code_immat, r.truck_flow, r.n) for r in mode) == [("T1", "Inconnu", 1), ("T1", "Verre", 1)]
    first = weights.truck_flow_mode(classified(spark, rows), ties="first").collect()
    assert [(r.code_immat, r.truck_flow) for r in first] == [("T1", "Inconnu")]


def test_final_flow_takes_the_mode_and_drops_others(spark):
    rows = [("1", None, None, "T1", 1.0), ("2", "Bacs verre", None, "T1", 1.0), ("3", "Bacs verre", None, "T1", 1.0),
            ("4", "Bacs carton", "X", "T1", 1.0), ("5", None, None, None, 1.0)]
    flows = weights.with_final_flow(classified(spark, rows)).collect()
    assert {r.code_puce: r.type_flux for r in flows} == {
        "1": "Verre", "2": "Verre", "3": "Verre", "4": "Inconnu", "5": "Inconnu",
    }


def test_history_ranks_before_dropping_corrected_rows(spark):
    day = [datetime.datetime(2022, 1, d) for d in range(1, 9)]
    rows = [("full", 10.0 + d, 10.0 + d, day[d]) for d in range(8)]
    rows += [("gap", 10.0, 10.0 if d != 6 else 0.0, day[d]) for d in range(8)]
    history = spark.createDataFrame(rows, "id_bac string, poids double, poids_corr double, date_mesure timestamp_ntz")
    last = weights.last_weights(history, F.lit("2022-01-07 00:00:00").cast("timestamp_ntz"))
    full = weights.history_average(last).collect()
    assert [(r.id_bac, r.average) for r in full] == [("full", 13.5)]  # days 2 to 7
    assert [(r.id_bac, r.n) for r in weights.short_history(last).collect()] == [("gap", 5)]


def test_correction_chain(spark):
    bins = spark.createDataFrame(
        [(1, "Bacs ordures ménagères", 240), (2, "Bacs ordures ménagères", 240), (3, "Bacs verre", 660),
         (4, "Bacs ordures ménagères", 9999)],
        "id_bac long, categorie_recipient string, litrage_recipient int",
    )
    support = spark.createDataFrame(
        [(2, "R-1-OM", 20.0)] * 51 + [(3, "R-1-VE", 30.0), (3, "R-1-VE", 300.0), (9, "R-1-XX", 100.0)],
        "id_bac long, code_tournee string, poids double",
    )
    history = spark.createDataFrame(
        [(1, 11.111, 11.111, datetime.datetime(2022, 1, d)) for d in range(1, 8)],
        "id_bac long, poids double, poids_corr double, date_mesure timestamp_ntz",
    )
    facts = spark.createDataFrame(
        [("kept", 1, "OM", 7.126), ("own", 1, "OM", 0.0), ("volume", 2, "OM", 0.0), ("default", 3, "Verre", 0.0),
         ("flow", 4, "OM", 0.0), ("no bin", 77, "CS", 0.0), ("overall", 77, "Inconnu", 0.0)],
        "name string, id_bac long, type_flux string, poids_corr double",
    )
    until = F.lit("2022-02-01 00:00:00").cast("timestamp_ntz")
    out = weights.correct_weights(facts, support, bins, history, until)
    overall = (51 * 20 + 30 + 100) / 53
    got = {r.name: round(r.poids_corr, 6) for r in out.collect()}
    assert got == {
        "kept": 7.13, "own": 11.11, "volume": 20.0, "default": 71.6, "flow": 20.0, "no bin": 9.2,
        "overall": round(overall, 6),
    }


def test_rates_are_looked_up_by_substring(spark):
    rng = random.Random(3)
    bins = [(i, "Bacs ordures ménagères", rng.choice([1, 120, 140, 33, 1000, 770, 5])) for i in range(200)]
    support = [(b, "R-1-OM", rng.randrange(-5, 300) / 1.0) for b in (rng.randrange(220) for _ in range(4000))]
    volume_of = {b: str(v) for b, _, v in bins}
    expected = {}
    for rate, category, volumes, _ in weights.VOLUME_RATES:
        if category == "Bacs ordures ménagères":
            values = [w for b, _, w in support if 0 < w < 250 and b in volume_of and volume_of[b] in volumes]
            if len(values) > 50:
                expected[rate] = (round(sum(values) / len(values), 6), len(values))
    averages = weights.reference_averages(
        spark.createDataFrame(support, "id_bac long, code_tournee string, poids double"),
        spark.createDataFrame(bins + bins[:3], "id_bac long, categorie_recipient string, litrage_recipient int"),
    )
    twice = [(b, r, w) for b, r, w in support if 0 < w < 250 and b < 3]
    usable = [w for _, _, w in support if 0 < w < 250]
    rates = {r.rate: (round(r.average, 6), r.n) for r in weights.rate_by_volume(averages).collect()}
    assert set(rates) == set(expected) and len(expected) > 2
    touched = {r for r, c, v, _ in weights.VOLUME_RATES if c == bins[0][1] for b, _, _ in twice if volume_of[b] in v}
    assert {r: v for r, v in rates.items() if r not in touched} == {r: v for r, v in expected.items() if r not in touched}
    overall = weights.rate_global(averages).first()
    assert (round(overall.average, 6), overall.n) == (round(sum(usable) / len(usable), 6), len(usable))
    by_flow = weights.rate_by_flow(averages).collect()
    assert [(r.rate, r.n) for r in by_flow] == [("OMglobal", len(usable))]


def test_support_is_read_once(spark, tmp_path):
    path = str(tmp_path / "support")
    spark.createDataFrame([(1, "R-1-OM", 3.0)], "id_bac long, code_tournee string, poids double").write.parquet(path)
    bins = spark.createDataFrame([(1, "Bacs verre", 240)], "id_bac long, categorie_recipient string, litrage_recipient int")
    facts = spark.createDataFrame([(1, "Inconnu", 0.0)], "id_bac long, type_flux string, poids_corr double")
    history = spark.createDataFrame([], "id_bac long, poids double, poids_corr double, date_mesure timestamp")
    out = weights.correct_weights(facts, spark.read.parquet(path), bins, history, F.current_timestamp())
    assert out.collect()[0].poids_corr == 3.0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count(f"Location: InMemoryFileIndex(1 paths)[file:{path}") == 1


def test_kept_state_equals_all_rows(spark):
    """Random days, ties, corrected and early rows: the state of a day gives what all rows before it give."""
    rng = random.Random(8)
    first = datetime.datetime(2022, 1, 1)
    rows = [(rng.randrange(12), float(rng.randrange(3)), float(rng.randrange(3)), first + datetime.timedelta(days=rng.randrange(9)), rng.randrange(9)) for _ in range(600)]
    df = spark.createDataFrame(rows, "id_bac long, poids double, poids_corr double, date_mesure timestamp, stored int")
    state = df.drop("stored").where("false")
    for day in range(9):
        until = F.lit(first + datetime.timedelta(days=day))
        seen = df.where(F.col("stored") < day)
        wanted = weights.last_weights(seen.where(F.col("date_mesure") < until))
        got = weights.last_weights(state.where(F.col("date_mesure") < until))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
        state = weights.merge_history(state, df.where(F.col("stored") == day), F.lit(first + datetime.timedelta(days=day + 1)))
        state = spark.createDataFrame(state.collect(), state.schema)
    assert state.where(F.col("date_mesure") < until).count() <= 6 * 12


def test_weighing_facts_of_a_day(spark):
    midnight = datetime.datetime(2022, 2, 25, 23)  # 26 February in Paris
    bins = spark.createDataFrame(
        [(5, "KNOWN", "Bacs collecte sélective", midnight, None), (6, "OLD", "Bacs verre", datetime.datetime(2020, 1, 1), midnight),
         (7, "INCONNU", "Indetermine", datetime.datetime(2019, 12, 31, 23), None)],
        "id_bac long, code_puce string, categorie_recipient string, date_debut timestamp, date_fin timestamp",
    )
    rows = [("20220227", "54746", "KNOWN", 99.0, "ET1", "MEA-140-OM"), ("20220227", "62140", "OTHER", 58.0, "ET1", "LU-140-OM"),
            ("20220226", "000000", "OLD", 7.0, "ET1", None), ("20220226", "000001", "OLD", 7.0, "ET1", "X"),
            ("20220227", "62140", "OTHER", 58.0, "ET1", "LU-140-OM")]
    raw = spark.createDataFrame(
        rows, "Date_de_la_levee string, Heure_de_la_levee string, Code_puce string, Pesee_net double,"
        " Immatriculation string, Tournee string"
    ).withColumns({"Latitude": F.lit(48.1), "Longitude": F.lit(-1.7)})
    now = F.lit("2022-02-27 13:00:00").cast("timestamp")
    facts = weighing_facts(raw, bins, "2022-02-27", now).collect()
    assert sorted((r.code_puce, str(r.date_mesure)[8:], r.id_bac, r.type_flux, r.poids_corr) for r in facts) == [
        ("KNOWN", "27 04:47:46", 5, "CS", 0.0),
        ("OLD", "25 23:00:00", 6, "Verre", 7.0),
        ("OLD", "25 23:00:01", 7, "Verre", 7.0),  # the truck's mode
        ("OTHER", "27 05:21:40", 7, "OM", 58.0),
    ]


def test_the_correction_query_uses_all_weights_and_the_whole_history(spark):
    """As does the query that corrects weights alone."""
    from civiframe.catalog import QUERIES

    columns = ["code_puce", "id_bac", "type_flux", "poids", "poids_corr"]
    folder = "/root/testdata/sf0.001"

    def summed(name):
        return QUERIES[name](spark, folder).groupBy(*columns).agg(F.sum("n").alias("n"))

    placed, alone = summed("pipe_correction").localCheckpoint(), summed("weight_correct").localCheckpoint()
    assert placed.exceptAll(alone).isEmpty() and alone.exceptAll(placed).isEmpty()
