"""Three daily snapshots: attribute change, two owner changes, removal, arrival, return."""

import pytest
from pyspark.sql import functions as F

from civiframe.config import BIN, PRODUCER
from civiframe.operators import scd
from civiframe.plans.waste import bin_dimension, producer_dimension
from civiframe.session import stage

DAYS = ("2022-02-25", "2022-02-26", "2022-02-27")


def producers_of(spark, rows, photo):
    full = [(c, None, 35000, name, "Ménage", act, -1.7, 48.1, photo) for c, name, act in rows]
    return spark.createDataFrame(full, PRODUCER.schema())


def bins_of(spark, rows, photo):
    full = [(o, "Bacs collecte sélective", kind, vol, chip, 1, 1.5, photo) for chip, o, kind, vol in rows]
    return spark.createDataFrame(full, BIN.schema())


@pytest.fixture(scope="module")
def chain(spark):
    producers = {
        0: [(1, "V", "A"), (2, "V", "A"), (3, "V", "A")],
        1: [(1, "V", "A"), (2, "V", "B"), (4, "V", "A")],  # 2 changes, 3 leaves, 4 arrives
        2: [(1, "V", "A"), (2, "V", "A"), (3, "V", "A"), (4, "V", "A")],  # 2 changes back, 3 returns
    }
    bins = {
        0: [("SAME", 1, "Bac CS 360 l", 360), ("ATTR", 2, "Bac CS 360 l", 360), ("OWNER", 1, "Bac CS 360 l", 360),
            ("GONE", 3, "Bac", 240), ("ORPHAN", 99, "Bac", 240)],
        1: [("SAME", 1, "Bac CS 360 l", 360), ("ATTR", 2, "Bac CS 360 l", 180), ("OWNER", 2, "Bac CS 360 l", 360),
            ("ORPHAN", 99, "Bac", 240), ("NEW", 4, "Bac", 240)],
        2: [("SAME", 1, "Bac CS 360 l", 360), ("ATTR", 2, "Bac CS 360 l", 180), ("OWNER", 4, "Bac CS 360 l", 360),
            ("ORPHAN", 99, "Bac", 240), ("NEW", 4, "Bac", 240)],
    }
    out = []
    now = F.lit("2022-02-25 13:00:00").cast("timestamp")
    p, b = scd.bootstrap_producers(spark, DAYS[0], now), scd.bootstrap_bins(spark, DAYS[0], now)
    for n, day in enumerate(DAYS):
        photo = day.replace("-", "")
        now = F.lit(f"{day} 13:00:00").cast("timestamp")
        p = stage(producer_dimension(p, producers_of(spark, producers[n], photo), day, photo, now), "p")
        b = stage(bin_dimension(b, bins_of(spark, bins[n], photo), p, day, photo, now), "b")
        out.append((p, b))
    return out


def local(ts):
    return F.date_format(F.from_utc_timestamp(ts, "Europe/Paris"), "MM-dd HH")


def view(df, key):
    return sorted(
        (
            tuple(r)
            for r in df.select(
                F.coalesce(F.col(key).cast("string"), F.lit("?")),
                local("date_debut"), F.coalesce(local("date_fin"), F.lit("open")), "day",
                F.coalesce(F.date_format("date_modif", "dd HH"), F.lit("never")),
            ).collect()
        ),
        key=str,
    )


def test_producers_after_two_days(chain):
    assert view(chain[1][0], "code_producteur") == [
        ("1", "02-25 00", "open", "25", "never"),
        ("2", "02-25 00", "open", "25", "26 13"),
        ("3", "02-25 00", "02-26 00", "25", "26 13"),
        ("4", "02-26 00", "open", "26", "never"),
        ("?", "01-01 00", "open", None, "never"),
    ]


def test_returning_producer_gets_a_new_row(chain):
    rows = view(chain[2][0], "code_producteur")
    assert [r for r in rows if r[0] == "3"] == [
        ("3", "02-25 00", "02-26 00", "25", "26 13"),
        ("3", "02-27 00", "open", "27", "never"),
    ]
    assert ("2", "02-25 00", "open", "25", "27 13") in rows


def test_bins_after_three_days(chain):
    assert view(chain[2][1], "code_puce") == [
        ("ATTR", "02-25 00", "open", "25", "26 13"),
        ("GONE", "02-25 00", "02-26 00", "25", "26 13"),
        ("INCONNU", "01-01 00", "open", None, "never"),
        ("NEW", "02-26 00", "open", "26", "never"),
        ("ORPHAN", "02-25 00", "open", "25", "never"),
        ("OWNER", "02-25 00", "02-26 00", "25", "26 13"),
        ("OWNER", "02-26 00", "02-27 00", "26", "27 13"),
        ("OWNER", "02-27 00", "open", "27", "never"),
        ("SAME", "02-25 00", "open", "25", "never"),
        ("null", "01-01 00", "open", None, "never"),
    ]


def test_bin_owner_ids(chain):
    producers, bins = chain[2]
    unknown = producers.where("code_producteur is null").first().id_producteur
    by_chip = {(r.code_puce, r.code_producteur): r for r in bins.collect()}
    first_day = {r.code_producteur: r.id_producteur for r in chain[0][0].collect()}
    assert by_chip["SAME", 1].id_producteur == first_day[1]
    assert by_chip["ORPHAN", 99].id_producteur == unknown
    assert by_chip["INCONNU", 0].id_producteur == unknown
    # the id of owner 2 made with day 26 exists in no producer row (2 dates from day 25)
    assert by_chip["OWNER", 2].id_producteur == unknown
    assert by_chip["ATTR", 2].litrage_recipient == 180 and by_chip["ATTR", 2].nb_collecte == 1.5


def test_ids_are_the_stored_ones(chain):
    producers, bins = chain[0]
    assert producers.where("code_producteur is null").first().id_producteur == 4592346621047744323
    assert bins.where("code_puce = 'INCONNU'").first().id_bac == 927456228716636942


def test_duplicate_codes_keep_one(spark):
    now = F.lit("2022-03-07 13:00:00").cast("timestamp")
    rows = [("C1", 1, "Bac CS 1", 360), ("C1", 1, "Bac CS 2", 50), ("C2", 1, "Bac", 50)]
    latest = scd.bootstrap_bins(spark, "2022-03-07", now)
    owners = scd.bootstrap_producers(spark, "2022-03-07", now)
    built = bin_dimension(latest, bins_of(spark, rows, "20220307"), owners, "2022-03-07", "20220307", now)
    assert sorted(r.code_puce for r in built.collect()) == ["C1", "C2", "INCONNU", "null"]


def test_same_photo_twice_changes_nothing(chain, spark):
    """A second run on the same day keeps every row."""
    producers, bins = chain[0]
    now = F.lit("2022-02-25 15:00:00").cast("timestamp")
    rows = [(1, "V", "A"), (2, "V", "A"), (3, "V", "A")]
    again = producer_dimension(producers, producers_of(spark, rows, "20220225"), DAYS[0], "20220225", now)
    assert again.exceptAll(producers).count() == 0 and again.count() == producers.count()
