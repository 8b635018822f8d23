"""Jobs from folders to folders, and the faults that once hid behind green operators."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiframe.config import BIN, PRODUCER
from civiframe.operators import melt, spatial
from civiframe.plans import lora, waste
from civiframe.session import shared_dir
from civiframe.sources import readers, sinks

def now():
    return F.lit("2022-02-25 13:00:00").cast("timestamp")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def staged_folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/civiframe")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {str(f.getPath()) for f in store.listStatus(path)} if store.exists(path) else set()


# -- sensors ------------------------------------------------------------------------------

FRAME = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("deveui", "timestamp", "year", "month", "day")],
    T.StructField("data", T.StructType([
        T.StructField("kind", T.StringType()),
        *[T.StructField(n, T.ArrayType(T.DoubleType())) for n in ("past", "older")],
    ])),
])
REFERENTIAL = (
    "deveui string, dataparameter string, enabledon string, disabledon string, measurenatureid int, unitid int, step int"
)
SENSORS = "deveui string, enabledon string, disabledon string, updatedon string, reprisedon string"


def sensor_frames(spark, names=("s1", "s2")):
    rows = []
    for name in names:
        for day in ("01", "02", "03"):
            rows.append((name, f"2022-01-{day}T10:00:00+01:00", "2022", "01", day, ("k", [1.0, 2.0], [5.0, None, 7.0])))
    return spark.createDataFrame(rows, FRAME)


def sensor_tables(spark, names=("s1", "s2")):
    parameters = spark.createDataFrame([(s, [], [], ["a", "b"], [], ["past", "older"], []) for s in names], melt.PARAMETERS)
    referential = spark.createDataFrame(
        [(s, n, "2021-01-01", None, 1, 1, None) for s in names for n in ("a", "b")]
        + [(s, c, "2021-01-01", None, 1, 1, step) for s in names for c, step in (("past", 3600), ("older", 1800))],
        REFERENTIAL,
    )
    return parameters, referential


def test_two_history_columns_keep_all_values_and_their_day(spark):
    parameters, referential = sensor_tables(spark)
    steps = referential.select("deveui", "dataparameter", "step")
    plan = lora.analyse(sensor_frames(spark), parameters, steps, F.lit("now"), ["past", "older"])
    got = rows_of(plan.where("deveui = 's1' and day = '02'"), "tramedate", "name", "value", "year", "month")
    assert got == [
        ("2022-01-02T09:00:00+01:00", "a", 2.0, "2022", "01"), ("2022-01-02T09:00:00+01:00", "b", 7.0, "2022", "01"),
        ("2022-01-02T10:00:00+01:00", "a", 1.0, "2022", "01"), ("2022-01-02T10:00:00+01:00", "b", 5.0, "2022", "01"),
    ]
    assert plan.where("day is null").isEmpty()


def test_history_columns_do_not_repeat_the_frames(spark):
    parameters, referential = sensor_tables(spark)
    steps = referential.select("deveui", "dataparameter", "step")

    def scans(columns):
        plan = lora.analyse(sensor_frames(spark), parameters, steps, F.lit("now"), columns)
        return plan._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")

    assert scans(["past", "older"]) == scans(["past"])


def test_replaying_one_sensor_after_the_other_keeps_all_rows(spark, tmp_path):
    parameters, referential = sensor_tables(spark)
    target, sensors_target = str(tmp_path / "measures"), str(tmp_path / "sensors")
    before = staged_folders(spark)
    for name in ("s1", "s2"):
        sensors = spark.createDataFrame(
            [(s, "2022-01-01", "2022-01-04", "2022-02-01" if s == name else None, None) for s in ("s1", "s2")], SENSORS
        )
        lora.run_replay(
            spark, sensor_frames(spark), target, sensors, sensors_target, parameters, referential, "2022-02-02",
            F.lit("replayed"), ["past", "older"],
        )
    counts = spark.read.orc(target).groupBy("deveui").count()
    assert rows_of(counts, "deveui", "count") == [("s1", 12), ("s2", 12)]
    assert staged_folders(spark) == before


def test_replacement_refuses_rows_of_other_days(spark, tmp_path):
    base = str(tmp_path / "t")
    day = "v int, year string, month string, day string, bucket int"
    sinks.append_day(spark.createDataFrame([(1, "2022", "01", "01", 3), (2, "2022", "01", "05", 3)], day), base, by=sinks.BUCKET)
    touched = spark.createDataFrame([(2022, 1, 1, 3), (2022, 1, 2, 3)], "year int, month int, day int, bucket int")
    for bad in (("2022", "01", "05", 3), ("2022", "01", "01", 4), (None, None, None, 3)):
        new = spark.createDataFrame([(9, *bad)], day)
        with pytest.raises(ValueError):
            sinks.replace_touched(spark, new, base, touched, lambda stored: stored.limit(0))
    assert rows_of(spark.read.orc(base), "v") == [(1,), (2,)]


def test_null_and_empty_arrays_keep_their_places(spark):
    frames = spark.createDataFrame(
        [("s1", "t1", "2022", "01", "01", ("k", None, [5.0])), ("s1", "t2", "2022", "01", "01", ("k", [], [6.0]))], FRAME
    )
    parameters, _ = sensor_tables(spark, ("s1",))
    assert rows_of(melt.melt_measures(melt.expand_data(frames), parameters, F.lit("x")), "name", "value") == [("b", 5.0), ("b", 6.0)]


def test_unnamed_sensors_name_every_value_alike(spark):
    frames = spark.createDataFrame([("s1", "t1", "2022", "01", "01", ("k", [1.0, 2.0, 3.0], None))], FRAME)
    parameters = spark.createDataFrame([("s1", [], [], [], [], ["past"], ["label"])], melt.PARAMETERS)
    measures = melt.melt_measures(melt.expand_data(frames), parameters, F.lit("x"))
    assert rows_of(measures, "name", "value") == [("label:", 1.0), ("label:", 2.0), ("label:", 3.0)]


def test_daily_job_reads_its_folder_and_reports_silent_sensors(spark, tmp_path):
    base, target, report = (str(tmp_path / n) for n in ("frames", "measures", "silent"))
    for day, names in (("01", ("s1", "s2")), ("02", ("s1",))):
        folder = tmp_path / "frames" / "year=2022" / "month=01" / f"day={day}"
        folder.mkdir(parents=True)
        lines = [{"deveui": s, "timestamp": f"2022-01-{day}T10:00:00+01:00", "data": {"kind": "k", "past": [1.0], "older": None}} for s in names]
        (folder / "f.json").write_text(json.dumps(lines, indent=1))
    (tmp_path / "frames" / "year=2022" / "month=01" / "day=03").mkdir()
    parameters, referential = sensor_tables(spark, ("s1",))
    sensors = spark.createDataFrame([(s, "2022-01-01", None, None, None) for s in ("s1", "s2")], SENSORS)
    for _ in range(2):
        lora.run_daily(
            spark, base, target, "2022-01-01", sensors, parameters, referential, F.lit("n"), FRAME, report=report
        )
    assert rows_of(spark.read.orc(target), "deveui", "name", "value", "day") == [("s1", "a", 1.0, 1)]
    assert rows_of(spark.read.orc(report), "deveui", "day") == [("s2", 1)]
    everyone, names = sensor_tables(spark)
    lora.run_daily(spark, base, target, "2022-01-01", sensors, everyone, names, F.lit("n"), FRAME, report=report)
    assert rows_of(spark.read.orc(target), "deveui") == [("s1",), ("s2",)]
    assert not (tmp_path / "silent" / "year=2022" / "month=01" / "day=01").exists()
    lora.run_daily(spark, base, target, "2022-01-01", sensors, parameters, referential, F.lit("n"), FRAME)
    lora.run_daily(spark, base, target, "2022-01-09", sensors, parameters, referential, F.lit("n"), FRAME)
    assert spark.read.orc(target).count() == 1


# -- waste --------------------------------------------------------------------------------

PRODUCER_HEADER = "Code producteur;RVA ADR;Code INSEE;Nom commune;Type producteur;Activité;Longitude;Latitude;date photo"
BIN_HEADER = "Code producteur;Catégorie récipient;Type de récipient;Litrage récipient;Code puce;Fréquence OM;Fréquence CS;date_photo"


def raw_file(tmp_path, name, day, header, *lines, file="f.csv"):
    folder = tmp_path / "raw" / name / "year=2022" / "month=02" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / file).write_text("\n".join([header, *lines]), encoding="utf-8")


def test_a_day_is_read_under_its_own_header(spark, tmp_path):
    raw_file(tmp_path, "producer", "25", PRODUCER_HEADER, "1;7;35000;Ville;Ménage;Pavillon;-1.7;48.1;20220225")
    swapped = "RVA ADR;Code producteur;Nom commune;Code INSEE;Type producteur;Activité;Longitude;Latitude;date photo"
    raw_file(tmp_path, "producer", "26", swapped, "7;2;Ville;35000;Ménage;Pavillon;-1.7;48.1;20220226")
    target = str(tmp_path / "prepared")
    for day in ("25", "26", "25"):
        assert waste.run_preparation(spark, {"producer": str(tmp_path / "raw" / "producer")}, target, f"2022-02-{day}") == {}
    stored = spark.read.orc(f"{target}/producer")
    assert rows_of(stored, "day", "code_producteur", "rva_adr", "code_insee", "nom_commune") == [
        (25, 1, 7, 35000, "Ville"), (26, 2, 7, 35000, "Ville")
    ]


def test_files_of_one_day_with_different_headers_fail(spark, tmp_path):
    raw_file(tmp_path, "bin", "25", "a;b", "1;2", file="f1.csv")
    raw_file(tmp_path, "bin", "25", "b;a", "1;2", file="f2.csv")
    base = str(tmp_path / "raw" / "bin")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv_config(spark, readers.day_folder(base, "2022-02-25"), BIN, base=base).collect()


def test_dimension_job_reports_duplicates(spark, tmp_path):
    raw_file(tmp_path, "producer", "25", PRODUCER_HEADER, *["1;7;35000;Ville;Ménage;Pavillon;-1.7;48.1;20220225"] * 2)
    prepared, base = str(tmp_path / "prepared"), str(tmp_path / "dim")
    waste.run_preparation(spark, {"producer": str(tmp_path / "raw" / "producer")}, prepared, "2022-02-25")
    waste.run_dimensions(spark, prepared, base, "2022-02-25", now(), datetime.datetime(2022, 2, 25, 13))
    report = spark.read.orc(f"{base}/producer/year=2022/month=02/day=25/duplicates")
    assert rows_of(report, PRODUCER.key, "n_rows") == [(1, 2), (1, 2)]


def test_exposure_skips_an_empty_day(spark, tmp_path):
    source, reload, replace = (str(tmp_path / n) for n in ("source", "reload", "replace"))
    sinks.append_day(spark.createDataFrame([(1, "2022", "01", "05")], "v int, year string, month string, day string"), source)
    before = staged_folders(spark)
    assert not waste.run_exposure(spark, source, "2022-01-06", [reload])
    assert waste.run_exposure(spark, source, "2022-01-05", [reload], [replace])
    assert rows_of(spark.read.orc(reload), "v") == rows_of(spark.read.orc(replace), "v") == [(1,)]
    spark.createDataFrame([(4,)], "v int").write.orc(f"{source}/year=2022/month=01/day=07/orc")
    assert waste.run_exposure(spark, source, "2022-01-07", [reload], snapshot=True)
    assert rows_of(spark.read.orc(reload), "v") == [(4,)] and staged_folders(spark) == before


def test_weighing_and_correction_jobs_run_twice(spark, tmp_path):
    from civiframe.config import WEIGHING

    prepared, dimensions, staging, support, target = (
        str(tmp_path / n) for n in ("prepared", "dim", "staging", "support", "target")
    )
    bins = spark.createDataFrame(
        [(1, "C1", "Bacs ordures ménagères", 240, datetime.datetime(2020, 1, 1), None),
         (-2, "INCONNU", "Indetermine", 0, datetime.datetime(2020, 1, 1), None)],
        "id_bac long, code_puce string, categorie_recipient string, litrage_recipient int, date_debut timestamp, date_fin timestamp",
    )
    sinks.write_snapshot(bins, f"{dimensions}/bin", "year=2022/month=07/day=01/orc", datetime.datetime(2022, 7, 1))
    known = {"Date_de_la_levee": "20220701", "Heure_de_la_levee": "060000", "Code_puce": "C1", "Tournee": "R-1-OM",
             "Immatriculation": "T", "Latitude": 48.004, "Longitude": 3.006}
    columns = [
        F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) if f.name != "Pesee_net" else F.col("w").cast(f.dataType).alias(f.name)
        for f in WEIGHING.schema()
    ]
    day = spark.createDataFrame([(500.0,), (9.0,)], "w double").select(*columns)
    sinks.append_day(day.withColumns({"year": F.lit("2022"), "month": F.lit("07"), "day": F.lit("01")}), prepared)
    month = spark.createDataFrame(
        [(1, "R-1-OM", 30.0, datetime.datetime(2021, 1, 5))], "id_bac long, code_tournee string, poids double, date_mesure timestamp"
    )
    month.write.options(header=True, sep=";").csv(f"{support}/year=2021/month=01/day=05")
    areas = spatial.prepare_polygons(
        spark.createDataFrame([], "code_insee int, commune_agglo int, nuquart int, rings array<array<struct<x:double,y:double>>>")
    )
    before = staged_folders(spark)
    for _ in range(2):
        assert waste.run_weighings(spark, prepared, dimensions, staging, "2022-07-01", now()) == 2
        assert waste.run_correction(spark, staging, support, dimensions, target, areas, areas, "2022-07-01") == 2
    assert waste.run_correction(spark, staging, support, dimensions, target, areas, areas, "2022-07-02") == 0
    assert rows_of(spark.read.orc(staging), "id_bac", "poids") == [(1, 500.0), (1, 9.0)]
    stored = spark.read.orc(target)
    assert stored.count() == 2 and stored.where("poids_corr <= 0 or poids_corr is null").isEmpty()
    assert staged_folders(spark) == before
    assert waste.kept_states(spark, f"{target}_history") == ["2022-07-01"]


def test_correction_opens_one_state(spark, tmp_path):
    """Days corrected one by one, out of order and again: the history of a day is what the target holds before it."""
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    day = "id_bac long, poids double, poids_corr double, date_mesure timestamp, year string, month string, day string"

    def store(n, weight):
        rows = [(1, weight, weight, datetime.datetime(2022, 7, n, 6), "2022", "07", f"{n:02d}")]
        sinks.replace_day(spark.createDataFrame(rows, day), target, f"2022-07-{n:02d}")

    def weights_before(date):
        return sorted(r.poids for r in waste.kept_history(spark, target, state, date).collect())

    assert weights_before("2022-07-01") == []
    for n in (1, 2, 4):
        store(n, float(n))
    assert weights_before("2022-07-04") == [1.0, 2.0]  # no state yet
    waste.merge_history(waste.empty_frame(spark, waste.HISTORY), waste.kept_history(spark, target, state, "2022-07-03"), F.to_timestamp(F.lit("2022-07-03"))).write.orc(f"{state}/upto=2022-07-02")
    for n in (1, 2):
        store(n, 50.0 + n)  # not looked at again
    assert weights_before("2022-07-03") == weights_before("2022-07-04") == [1.0, 2.0]
    store(3, 3.0)
    assert weights_before("2022-07-05") == [1.0, 2.0, 3.0, 4.0]
    assert weights_before("2022-07-02") == [51.0]  # only states of earlier days count
