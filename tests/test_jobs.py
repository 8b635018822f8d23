"""Jobs end to end on folders: read, build, write, run again."""

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from civiframe.operators import melt, outlets
from civiframe.plans import lora, traffic, waste
from civiframe.sources import readers, sinks


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def by_day(spark, rows):
    return spark.createDataFrame(rows, "deveui string, value int, year string, month string, day string")


def test_replace_partition_twice(spark, tmp_path):
    base = str(tmp_path / "t")
    sinks.replace_partition(by_day(spark, [("a", 1, "2022", "01", "01"), ("a", 2, "2022", "01", "02")]), base)
    again = by_day(spark, [("a", 9, "2022", "01", "02")])
    for _ in range(2):
        sinks.replace_partition(again, base)
    assert rows_of(spark.read.orc(base), "value", "day") == [(1, 1), (9, 2)]
    assert sorted(os.listdir(f"{base}/year=2022/month=01")) == ["day=01", "day=02"]


def test_replace_range_drops_emptied_days(spark, tmp_path):
    base = str(tmp_path / "t")
    stored = [("a", d, "2022", "01", f"{d:02d}") for d in (1, 2, 3, 4)] + [("b", 30, "2022", "01", "03")]
    sinks.replace_partition(sinks.in_buckets(by_day(spark, stored), "deveui"), base, sinks.BUCKET)
    new = by_day(spark, [("a", 100, "2022", "01", "03")])
    for _ in range(2):
        sinks.replace_key_range(spark, new, base, "2022-01-02", "2022-01-03", "deveui", "a")
    assert rows_of(spark.read.orc(base), "deveui", "value", "day") == [
        ("a", 1, 1), ("a", 100, 3), ("a", 4, 4), ("b", 30, 3),
    ]
    assert "day=02" not in os.listdir(f"{base}/year=2022/month=01")
    sinks.replace_key_day(spark, new.where("false"), base, "2022-01-04", "deveui", "a")
    assert rows_of(spark.read.orc(base), "value") == [(1,), (100,), (30,)]


def test_a_named_day_without_rows_is_cleared(spark, tmp_path):
    for by in (sinks.DAY, sinks.BUCKET):
        base = str(tmp_path / by[-1])
        rows = sinks.in_buckets(by_day(spark, [(s, d, "2022", "01", f"{d:02d}") for d in (1, 2) for s in "abcdef"]), "deveui")
        rows = rows if by == sinks.BUCKET else rows.drop("bucket")
        sinks.replace_partition(rows, base, by)
        sinks.replace_day(rows.where("day = '01' and deveui = 'c'"), base, "2022-01-01", by)
        assert rows_of(spark.read.orc(base).where("day = 1"), "deveui") == [("c",)]
        for _ in range(2):
            sinks.replace_day(rows.where("false"), base, "2022-01-01", by)
        assert rows_of(spark.read.orc(base), "deveui", "day") == [(s, 2) for s in "abcdef"]
        assert os.listdir(f"{base}/year=2022/month=01") == ["day=02"]
        with pytest.raises(ValueError):
            sinks.replace_day(rows, base, "2022-01-01", by)
        sinks.replace_day(rows.where("false"), str(tmp_path / "none" / by[-1]), "2022-01-01", by)


def files_below(base):
    """Every data file with its time of change."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(base) for f in names if f.endswith(".orc")}


def test_replaying_one_of_many_sensors_touches_its_buckets_only(spark, tmp_path):
    base = str(tmp_path / "t")
    sensors = [f"s{k}" for k in range(40)]
    days = [("2022", "01", f"{d:02d}") for d in range(1, 7)]
    rows = by_day(spark, [(s, 1, *d) for s in sensors for d in days])
    sinks.replace_partition(sinks.in_buckets(rows, "deveui"), base, sinks.BUCKET)
    own = rows.select(sinks.bucket_of(F.lit("s7"))).first()[0]
    before = files_below(base)
    new = rows.where("deveui = 's7'").withColumn("value", F.lit(2))
    sinks.replace_key_range(spark, new.where("day between '02' and '05' and day <> '04'"), base, "2022-01-02", "2022-01-05", "deveui", "s7")
    after = files_below(base)
    untouched = {f for f in before if f"bucket={own:03d}" not in f or "day=01" in f or "day=06" in f}
    assert len(untouched) > len(before) - 5 and all(after[f] == before[f] for f in untouched)
    assert set(before) - set(after) == set(before) - untouched
    stored = spark.read.orc(base)
    assert stored.where("deveui <> 's7'").count() == 39 * 6
    assert rows_of(stored.where("deveui = 's7'"), "day", "value") == [(1, 1), (2, 2), (3, 2), (5, 2), (6, 1)]


def test_pruned_scan_of_day_month_and_week(spark, tmp_path):
    base = str(tmp_path / "t")
    sinks.replace_partition(by_day(spark, [("a", d, "2022", "01", f"{d:02d}") for d in (1, 9, 10)]), base)
    stored = spark.read.orc(base)
    assert rows_of(stored.where(readers.on_date("2022-01-09")), "value") == [(9,)]
    assert stored.where(readers.on_date("2022-01")).count() == 3
    assert rows_of(readers.scan_days(stored, "2022-01-09", "2022-01-10"), "value") == [(10,), (9,)]
    plan = stored.where(readers.on_date("2022-01-09"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan


def test_latest_pointer_and_missing_paths(spark, tmp_path):
    base = str(tmp_path / "dim")
    schema = spark.range(1).schema
    assert readers.read_or_empty(spark, lambda: readers.read_latest(spark, base), schema).count() == 0
    for day in (1, 2):
        sinks.write_snapshot(spark.range(day), base, f"day={day}", datetime.datetime(2022, 1, day))
    assert readers.read_latest(spark, base).count() == 2


def test_day_columns_and_schema_drift(spark):
    first = spark.createDataFrame([("a", "2022")], "deveui string, year string")
    filled = readers.fill_day_columns(first, "2021-02-03").first()
    assert (filled.year, filled.month, filled.day) == ("2022", "02", "03")
    union = readers.union_days(first, spark.createDataFrame([("b", 1.0)], "deveui string, extra double"))
    assert rows_of(union, "deveui", "year", "extra") == [("a", "2022", None), ("b", None, 1.0)]


@pytest.mark.parametrize("date, support", [("2022-07-01", ("2021-01", "csv")), ("2023-07-01", ("2022-07", "orc_below"))])
def test_reference_month(date, support):
    assert readers.support_month(date) == support
    assert readers.reference_month("2022-07-01") == "2021-07"


def test_traffic_job(spark, tmp_path):
    raw, target = tmp_path / "raw" / "year=2021" / "month=02" / "week=04", str(tmp_path / "out")
    raw.mkdir(parents=True)
    (raw / "a.csv").write_text(
        "2021-02-25T14:22:00+02:00;213_D;46;10;0;freeFlow\n2021-02-25T14:31:00+02:00;213_D;50;10;0;freeFlow\n"
    )
    for _ in range(2):
        traffic.run_traffic(spark, str(tmp_path / "raw"), target, "2021-02-25")
    assert rows_of(spark.read.orc(target), "id", "speed_min", "week") == [("213_D", 46, 4), ("213_D", 50, 4)]
    empty = str(tmp_path / "none")
    traffic.run_traffic(spark, str(tmp_path / "missing"), empty, "2021-02-25")


def frame(deveui, stamp, value):
    year, month, day = stamp[:10].split("-")
    return {"deveui": deveui, "timestamp": stamp, "year": year, "month": month, "day": day, "data": {"EAP": f"{value}kWh"}}


def test_sensor_replay_replaces_its_days_only(spark, tmp_path):
    parameters = spark.createDataFrame([(s, [], [], ["EAP"], [], ["EAP"], []) for s in ("s1", "s2")], melt.PARAMETERS)
    referential = spark.createDataFrame(
        [(s, "EAP", "2022-01-01", None, 1, 1, None) for s in ("s1", "s2")],
        "deveui string, dataparameter string, enabledon string, disabledon string, measurenatureid int, unitid int, step int",
    )
    sensor_schema = "deveui string, enabledon string, disabledon string, updatedon string, reprisedon string"
    sensors = spark.createDataFrame(
        [("s1", "2022-01-01", "2022-01-03", "2022-02-01", None), ("s2", "2022-01-01", None, None, None)], sensor_schema
    )
    days = ("2022-01-01", "2022-01-02", "2022-01-03")
    folder = tmp_path / "frames"
    folder.mkdir()
    lines = [json.dumps(frame(s, f"{d}T10:00:00+01:00", 1)) for d in days for s in ("s1", "s2")]
    (folder / "a.json").write_text("\n".join(lines))
    frames = readers.read_frames(spark, str(folder), multi_line=False)
    target, sensors_target = str(tmp_path / "measures"), str(tmp_path / "sensors")
    for day in days:
        plan = lora.daily_plan(
            frames.where(readers.day_equals(day)), sensors, parameters, referential, day, F.lit("first")
        )
        sinks.replace_day(sinks.in_buckets(plan, "deveui"), target, day, sinks.BUCKET)
    (folder / "b.json").write_text("\n".join(line.replace('"1kWh"', '"5kWh"') for line in lines[:3]))
    (folder / "a.json").write_text("\n".join(lines[3:]))
    frames = readers.read_frames(spark, str(folder), multi_line=False)
    lora.run_replay(
        spark, frames, target, sensors, sensors_target, parameters, referential, "2022-02-02", F.lit("second")
    )
    assert rows_of(spark.read.orc(target), "deveui", "day", "value", "inserteddate") == [
        ("s1", 1, 5.0, "second"), ("s1", 2, 5.0, "second"), ("s1", 3, 1.0, "first"),
        ("s2", 1, 1.0, "first"), ("s2", 2, 1.0, "first"), ("s2", 3, 1.0, "first"),
    ]
    assert rows_of(spark.read.orc(sensors_target), "deveui", "reprisedon") == [("s1", "2022-02-02"), ("s2", None)]


def test_preparation_and_dimension_jobs(spark, tmp_path):
    for name, header, lines in (
        ("producer", "Code producteur;RVA ADR;Code INSEE;Nom commune;Type producteur;Activité;Longitude;Latitude;date photo",
         ["1;7;35000;Ville;Ménage;Pavillon;-1.7;48.1;20220225"]),
        ("bin", "Code producteur;Catégorie récipient;Type de récipient;Litrage récipient;Code puce;Fréquence OM;Fréquence CS;date_photo",
         ["1;Bacs verre;Bac;240;C1;1;1,5;20220225"]),
    ):
        folder = tmp_path / "raw" / name / "year=2022" / "month=02" / "day=25"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text("\n".join([header, *lines]), encoding="utf-8")
    sources = {n: str(tmp_path / "raw" / n) for n in ("producer", "bin")} | {"outlet": str(tmp_path / "absent")}
    prepared, base = str(tmp_path / "prepared"), str(tmp_path / "dim")
    failures = waste.run_preparation(spark, sources, prepared, "2022-02-25")
    assert list(failures) == ["outlet"]
    now = F.lit("2022-02-25 13:00:00").cast("timestamp")
    waste.run_dimensions(spark, prepared, base, "2022-02-25", now, datetime.datetime(2022, 2, 25, 13))
    bins = readers.read_latest(spark, f"{base}/bin")
    producers = readers.read_latest(spark, f"{base}/producer")
    assert rows_of(bins, "code_puce") == [("C1",), ("INCONNU",), ("null",)]
    assert bins.where("code_puce = 'C1'").first().id_producteur == producers.where("code_producteur = 1").first().id_producteur


def test_outlet_rules(spark):
    rows = [("T1", "1/13/22", "R", "104,5", "J1", "L", 33, "USINE", 2.28, "BOM"), ("T2", "12/13/21", "R", "x", "J2", "L", 1, None, 1.0, "BOM"),
            ("T3", "2022-01-02 00:00:00", "R", "1", "J3", "L", 1, None, 1.0, "BOM"),
            ("T4", "1/14/22", "R", "1", None, "L", 1, None, 1.0, "BOM"), ("T5", "1/14/22", "R", "1", "J5", "L", 1, "PESEE EMBARQUEE", 1.0, "BOM")]
    raw = spark.createDataFrame(
        rows, "immat string, date_service_vehic string, description_tournee string, km_realise string, no_bon string, lot string,"
        " service int, nom_rech_lieu_de_vidage string, multiples_lignes double, cle_unique_ligne_ticket string",
    )
    now = F.lit("2022-01-15 13:00:00").cast("timestamp")
    assert rows_of(outlets.analyse_outlets(raw, now), "code_immat", "distance") == [("T1", 104.5), ("T3", 1.0)]
    assert rows_of(outlets.analyse_outlets(raw, now, replay=True), "code_immat") == [("T1",), ("T2",), ("T3",)]


OUTLET_ROW = ("T1", "1/13/22", "R", 104, "J1", "L", 33, "USINE", 2.28, "BOM", "2022", "01", "15")


def test_outlet_job_replaces_its_day(spark, tmp_path):
    prepared, target, published = (str(tmp_path / n) for n in ("prepared", "target", "published"))
    schema = ("immat string, date_service_vehic string, description_tournee string, km_realise int, no_bon string, lot string,"
              " service int, nom_rech_lieu_de_vidage string, multiples_lignes double, cle_unique_ligne_ticket string,"
              " year string, month string, day string")
    sinks.append_day(spark.createDataFrame([OUTLET_ROW], schema), prepared)
    now = F.lit("2022-01-15 13:00:00").cast("timestamp")
    for _ in range(2):
        waste.run_outlets(spark, prepared, target, published, "2022-01-15", now)
    assert rows_of(spark.read.orc(published), "code_immat", "date_mesure", "month", "day") == [
        ("T1", "2022-01-13 00:00:00", 1, 15)
    ]
    assert spark.read.orc(f"{target}/year=2022/month=01/day=15/orc").count() == 1


def test_correction_of_a_day(spark):
    from civiframe.operators import spatial

    at = datetime.datetime(2022, 7, 1, 6)
    staged = spark.createDataFrame(
        [(at, "C1", 1, "R-1-OM", "T", 500.0, 0.0, "48.004", "3.006", "OM", "2022", "07", "01"),
         (at, "C1", 1, "R-1-OM", "T", 9.0, 9.0, None, None, "OM", "2022", "07", "01"),
         (at, "C1", 1, "R-1-OM", "T", 500.0, 0.0, "48.004", "3.006", "OM", "2022", "07", "02")],
        "date_mesure timestamp, code_puce string, id_bac long, code_tournee string, code_immat string, poids double,"
        " poids_corr double, latitude string, longitude string, type_flux string, year string, month string, day string",
    )
    support = spark.createDataFrame(
        [(1, "R-1-OM", 30.0, datetime.datetime(2021, 7, 5)), (1, "R-1-OM", 90.0, datetime.datetime(2021, 8, 5))],
        "id_bac long, code_tournee string, poids double, date_mesure timestamp",
    )
    bins = spark.createDataFrame([(1, "Bacs ordures ménagères", 9999)], "id_bac long, categorie_recipient string, litrage_recipient int")
    history = spark.createDataFrame([], "id_bac long, poids double, poids_corr double, date_mesure timestamp")
    square = [[{"x": 1_700_000.0 + a, "y": 7_200_000.0 + b} for a, b in ((0, 0), (900, 0), (900, 900), (0, 900))]]
    areas = spatial.prepare_polygons(
        spark.createDataFrame([(35001, 1, 7, square)], "code_insee int, commune_agglo int, nuquart int, rings array<array<struct<x:double,y:double>>>")
    )
    out = waste.correction_plan(staged, support, bins, history, areas, areas, "2022-07-01")
    assert rows_of(out, "poids_corr", "code_insee", "code_quartier") == [(30.0, 35001, 7), (9.0, None, None)]
    assert "type_flux" not in out.columns
    untouched = waste.corrected_facts(staged, support, bins, history, "2021-07-01")
    assert untouched.count() == 3
