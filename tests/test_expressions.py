import pytest
from pyspark.sql import functions as F

from civiframe.functions import dates, flow, geo, keys, text


def evaluate(spark, column, value=None):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, number",
    [("12", 12), ("1.9", 1), ("-1.9", -1), ("abc", 0), (None, 0), ("1,5", 0), (" 5", 0), ("99999999999.5", 2147483647)],
)
def test_lenient_int(spark, raw, number):
    assert evaluate(spark, text.lenient_int(F.col("x")), raw) == number


@pytest.mark.parametrize(
    "raw, number",
    [("1,5", 1.5), ("1.5", 1.5), ("3e2", 300.0), ("x", 0.0), (None, 0.0), ("NaN", 0.0),
     ("1.1234567890123459", 1.123456789012345)],
)
def test_lenient_double(spark, raw, number):
    assert evaluate(spark, text.lenient_double(F.col("x")), raw) == number


def test_lenient_boolean_and_float(spark):
    assert evaluate(spark, text.lenient_boolean(F.col("x")), "TRUE") is True
    assert evaluate(spark, text.lenient_boolean(F.col("x")), "yes") is False
    assert evaluate(spark, text.lenient_boolean(F.col("x")), None) is False
    assert evaluate(spark, text.lenient_float(F.col("x")), "1,5") == 0.0


@pytest.mark.parametrize(
    "raw, number",
    [("81469kWh", 81469.0), ("", 0.0), ("none", 0.0), (None, 0.0), ("-3.5 C", -3.5), ("1-2", None)],
)
def test_extract_number(spark, raw, number):
    assert evaluate(spark, text.extract_number(F.col("x")), raw) == number


def test_headers():
    assert text.clean_header("Catégorie récipient") == "categorie_recipient"
    assert text.clean_header("Nom |'[%$(x) 2") == "nom_x_2"


@pytest.mark.parametrize("day, week", [(1, "01"), (7, "01"), (8, "02"), (29, "05"), (31, "05"), (36, "-1"), (0, "-1")])
def test_week_of_month(spark, day, week):
    assert evaluate(spark, dates.week_of_month(F.lit(day))) == week
    assert dates.week_of_month_text(day) == week


def test_local_timestamp_drops_the_offset(spark):
    local = dates.local_timestamp(F.col("x")).cast("string")
    assert evaluate(spark, local, "2021-02-25T15:22:00+02:00") == "2021-02-25 15:22:00"
    assert evaluate(spark, local, "25/02/2021") is None
    assert evaluate(spark, local, "2021-13-25T15:22:00+02:00") is None


def test_floor_minutes(spark):
    quarter = dates.floor_minutes(dates.local_timestamp(F.col("x")), 15).cast("string")
    assert evaluate(spark, quarter, "2021-02-25T15:29:59+02:00") == "2021-02-25 15:15:00"


@pytest.mark.parametrize(
    "day, time, utc",
    [
        ("20220227", "54746", "2022-02-27 04:47:46"),
        ("20220701", "000000", "2022-06-30 22:00:00"),
        ("20220327", "023000", "2022-03-27 01:30:00"),  # skipped hour moves forward
        ("20221030", "023000", "2022-10-30 00:30:00"),  # repeated hour: earlier offset
        ("2022", "1", None),
    ],
)
def test_compact_instant(spark, day, time, utc):
    instant = dates.compact_instant(F.lit(day), F.lit(time))
    assert evaluate(spark, F.date_format(instant, "yyyy-MM-dd HH:mm:ss")) == utc


def test_compact_local(spark):
    assert str(evaluate(spark, dates.compact_local(F.lit("20220327"), F.lit("23000")))) == "2022-03-27 02:30:00"
    assert evaluate(spark, dates.compact_local(F.lit("20221345"), F.lit("1"))) is None


@pytest.mark.parametrize(
    "raw, day",
    [("1/13/22", "2022-01-13 00:00:00"), ("12/1/2022", "2022-12-01 00:00:00"),
     ("2020-01-13 00:00:00", "2020-01-13 00:00:00"), (None, None)],
)
def test_us_date(spark, raw, day):
    assert evaluate(spark, dates.us_date(F.col("x")), raw) == day


def test_back_dated_text_keeps_the_offset(spark):
    moved = dates.back_dated_text(F.col("x"), F.lit(2), F.lit(3600))
    assert evaluate(spark, moved, "2022-09-01T01:22:00+02:00") == "2022-08-31T23:22:00+02:00"


@pytest.mark.parametrize(
    "parts, key",
    [
        (("041A8D67F6", "20220101"), 5535109055518735565),
        (("169904", "20220101"), -3383476979751539603),
        (("null", "20220225"), 4592346621047744323),
        ((None, "20220225"), 4592346621047744323),
    ],
)
def test_surrogate_key(spark, parts, key):
    columns = [F.lit(p).cast("string") for p in parts]
    assert evaluate(spark, keys.surrogate_key(*columns)) == key


def test_surrogate_key_of_empty_and_mixed_batch(spark):
    df = spark.createDataFrame([("",), ("a",), ("ab",), ("é😀x",)], "x string")
    together = [r[0] for r in df.select(keys.surrogate_key(F.col("x"))).collect()]
    alone = [evaluate(spark, keys.surrogate_key(F.col("x")), v) for v in ("", "a", "ab", "é😀x")]
    assert together == alone and len(set(together)) == 4


@pytest.mark.parametrize(
    "category, round_code, truck, expected",
    [
        ("Bacs ordures ménagères", "LU-140-CS", "T", "OM"),
        ("Bacs verre", None, None, "Verre"),
        (None, "LU-140-OM", "T", "OM"),
        (None, "LU-140-BIO", None, "Biodechets"),
        ("Bacs carton", "LU-140-CS", "T", "CS"),
        ("Bacs papier", "XX", "T", "Autres"),
        (None, "XX", "T", "Inconnu_connu"),
        (None, None, None, "Inconnu"),
        ("Indetermine", "XX", "T", "Inconnu"),
    ],
)
def test_classify_flow(spark, category, round_code, truck, expected):
    plain = text.strip_accents(F.lit(category).cast("string"))
    others = [F.lit(v).cast("string") for v in (round_code, truck)]
    assert evaluate(spark, flow.classify_flow(plain, *others)) == expected


@pytest.mark.parametrize(
    "weight, kind, expected",
    [(119.0, "OM", 119.0), (120.0, "OM", 0.0), (40.0, "CS", 0.0), (239.0, "Verre", 239.0),
     (249.0, "Inconnu", 249.0), (249.0, None, 249.0), (250.0, None, 0.0), (-1.0, "OM", 0.0), (None, "OM", 0.0),
     (10.0, "other", 0.0)],
)
def test_plausible_weight(spark, weight, kind, expected):
    got = flow.plausible_weight(F.lit(weight).cast("double"), F.lit(kind).cast("string"))
    assert evaluate(spark, got) == expected


def test_pick_frequency(spark):
    def pick(kind, om, cs):
        return evaluate(
            spark,
            flow.pick_frequency(F.lit(kind), F.lit(om).cast("int"), F.lit(cs).cast("double")),
        )

    assert pick("Bac CS 360 l", 1, 2.0) == 2.0
    assert pick("Bac PNM OM 240 l", 1, 2.0) == 1.0
    assert pick("Bac biodéchets 400 l", 1, 2.0) == 0.0
    assert pick("Bac PNM OM 240 l", 1, None) is None


def test_projection_origin_and_scale(spark):
    x, y = geo.project_point(F.lit(48.0), F.lit(3.0))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(row.x - 1700000) < 1e-6 and abs(row.y - 7200000) < 1e-6
    x, y = geo.project_point(F.lit(48.1), F.lit(3.1))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert 7000 < row.x - 1700000 < 8000 and 11000 < row.y - 7200000 < 11300
