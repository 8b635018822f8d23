import pytest
from pyspark.sql import functions as F

from civiframe.config import BIN, OUTLET, PRODUCER, WEIGHING
from civiframe.operators import clean
from civiframe.plans.waste import outlet_preparation

PRODUCER_HEADERS = ["Code producteur", "RVA ADR", "Code INSEE", "Nom commune", "Type producteur", "Activité",
                    "Longitude", "Latitude", "date photo"]
GOOD = [("101", "7", "35000", "Ville", "Ménage", "Pavillon", "-1.7", "48.1", "20220101"),
        ("102", "x", None, "Ville", None, "Pavillon", "bad", "48.2", "20220101")]


def raw(spark, rows, headers):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))


def test_good_producers_keep_all_rows_and_null_bad_optionals(spark):
    rows = clean.prepare_producers(raw(spark, GOOD, PRODUCER_HEADERS)).orderBy("code_producteur").collect()
    assert [r.code_producteur for r in rows] == [101, 102]
    assert rows[1].rva_adr is None and rows[1].longitude is None and rows[1].latitude == 48.2


@pytest.mark.parametrize(
    "rows, headers",
    [
        ([], PRODUCER_HEADERS),
        (GOOD, [*PRODUCER_HEADERS[:3], "Autre nom", *PRODUCER_HEADERS[4:]]),
        ([GOOD[0], ("103", "7", "1", "V" * 501, "M", "P", "1", "2", "20220101")], PRODUCER_HEADERS),
        ([GOOD[0], ("code", "7", "1", "V", "M", "P", "1", "2", "20220101")], PRODUCER_HEADERS),
        ([r[:8] for r in GOOD], PRODUCER_HEADERS[:8]),
    ],
    ids=["header only", "wrong name", "too long", "required not a number", "column missing"],
)
def test_rejected_producer_batches(spark, rows, headers):
    prepared = clean.prepare_producers(raw(spark, rows, headers))
    assert prepared.count() == 0
    assert set(PRODUCER.names) <= set(prepared.columns)


def test_bins_take_extra_columns_alias_and_zero_frequencies(spark):
    headers = ["Code producteur", "Catégorie récipient", "Type de récipient", "Litrage récipient", "extra", "Code puce",
               "Fréquence OM", "Fréquence CS", "date_photo"]
    rows = [("1", "Bacs verre", "Bac", "240", "?", "CHIP1", None, "1,50", "20220101"),
            ("2", "Bacs verre", "Bac", "400", "?", "CHIP2", "bad", None, "20220101")]
    out = clean.prepare_bins(raw(spark, rows, headers)).orderBy("code_puce").collect()
    assert [(r.frequence_om, r.frequence_cs, r.type_recipient) for r in out] == [(0, 1.5, "Bac"), (0, 0.0, "Bac")]
    too_long = [(*rows[0][:5], "C" * 11, *rows[0][6:])]
    assert clean.prepare_bins(raw(spark, too_long + rows, headers)).count() == 0


def test_weighings_ignore_surplus_columns(spark):
    headers = [*WEIGHING.names[:3], "in the middle", *WEIGHING.names[3:], "at the end"]
    row = ["20220101", "54746", "CHIP", "?", "3,5", "1", "48.1", "bad", "0", "0", "1", "0", "0", "0", None, "T1", "R-1-OM", "?"]
    out = clean.prepare_weighings(raw(spark, [tuple(row)], headers), WEIGHING)
    assert out.columns == WEIGHING.names
    first = out.first()
    assert (first.Pesee_net, first.Statut_de_la_levee, first.Longitude) == (3.5, 1, 0.0)


def test_outlets_drop_incomplete_rows(spark):
    headers = ["Immat", "Date Service Véhic.", "Description Tournée", "Km Réalisé", "No Bon", "Lot", "Service",
               "Nom Rech. Lieu de vidage", "Multiples Lignes", "Clé unique ligne ticket"]
    rows = [("T1", "1/13/22", "R", "104.0", "J1", "L", "33", "USINE", "2,28", "BOM"),
            ("T2", "1/13/22", "R", "32", None, "L", "0", "USINE", "1,22", "BOM")]
    out = outlet_preparation(raw(spark, rows, headers)).collect()
    assert [(r.immat, r.km_realise, r.multiples_lignes) for r in out] == [("T1", 104, 2.28)]
    missing = [(None, *rows[0][1:]), rows[1]]
    assert clean.prepare_outlets(raw(spark, missing, headers)).count() == 0
    assert OUTLET.names == out[0].__fields__


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 3), (None, 4)], "k string, v int")
    report = clean.duplicate_report(df, "k").collect()
    assert sorted((r.k or "", r.v, r.n_rows) for r in report) == [("", 3, 2), ("", 4, 2), ("a", 1, 2), ("a", 2, 2)]
    kept = clean.keep_one(df, "k").collect()
    assert sorted((r.k or "", r.v) for r in kept) == [("", 3), ("a", 1), ("b", 1)]


def test_keep_one_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = clean.keep_one(df, "k")._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_mixed_batch_date_is_an_error(spark):
    df = spark.createDataFrame([("20220101",), ("20220102",)], "date_photo string")
    with pytest.raises(ValueError):
        clean.single_batch_date(df)
    assert clean.single_batch_date(df.limit(0)) is None


def test_frame_difference_counts_duplicates(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    right = spark.createDataFrame([(1,), (3,)], "v int")
    rows = sorted((r.v, r.side) for r in clean.frame_difference(left, right).collect())
    assert rows == [(1, "left"), (2, "left"), (3, "right")]


def test_bin_spec_keeps_unsupported_types_as_text():
    assert BIN.schema()["code_puce"].nullable is False
