import pytest
from pyspark.sql import functions as F

from civiframe.operators.joins import spread_left_join
from civiframe.operators.temporal import interval_join


def hot_facts(spark):
    """One key holds nine tenths of the rows."""
    return spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 50 > 0, F.col("id").cast("string")).alias("k"),
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def test_a_hot_key_is_split_beside_an_aggregated_lookup(spark):
    facts = hot_facts(spark)
    lookup = facts.groupBy("k").agg(F.count("*").alias("n")).where("k = 'hot' or n = 1 and k < '3'")
    plain = facts.join(lookup, "k", "left").select("k", "id", "n", "payload")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = spread_left_join(facts, lookup, [("k", "k")])

        def parts(frame):
            placed = frame.select(F.spark_partition_id().alias("p"), "k", "n", "payload")
            return [r.rows for r in placed.where("k = 'hot'").groupBy("p").agg(F.count("*").alias("rows"), F.max("n"), F.max("payload")).collect()]

        sizes = parts(joined)
        assert len(sizes) > 4 and sum(sizes) == 36_000 and max(sizes) < 12_000
        assert parts(plain) == [36_000]  # a plain join leaves them together
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert joined.select("k", "id", "n", "payload").exceptAll(plain).count() == 0 and joined.count() == plain.count() == 40_000


def test_keys_of_different_types(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    lookup = spark.createDataFrame([(1, 10), (3, 30)], "k long, w int")
    assert {r.v: r.w for r in spread_left_join(facts, lookup, [("k", "k")]).collect()} == {"a": 10, "b": None, "c": None}


def test_null_safe(spark):
    facts = spark.createDataFrame([(None, 1), ("a", 2)], "k string, id int")
    lookup = spark.createDataFrame([(None, 7)], "k string, v int")
    assert {r.id: r.v for r in spread_left_join(facts, lookup, [("k", "k")], null_safe=True).collect()} == {1: 7, 2: None}
    assert {r.id: r.v for r in spread_left_join(facts, lookup, [("k", "k")]).collect()} == {1: None, 2: None}


@pytest.fixture
def shuffled(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings if name != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name, value in before.items():
        spark.conf.set(name, value)


def keyless(spark):
    """Three quarters of the rows have no key."""
    return spark.range(0, 40_000, 1, 8).select(F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("k"), "id")


def most_in_a_task(joined):
    return max(r["count"] for r in joined.where("k is null").select(F.spark_partition_id().alias("p"), "id", "v").groupBy("p").count().collect())


@pytest.mark.parametrize("null_safe", [False, True])
def test_facts_without_a_key_are_dealt(spark, shuffled, null_safe):
    facts = keyless(spark)
    lookup = spark.createDataFrame([(None, 7), ("4", 8), ("8", 9)], "o string, v int")
    joined = spread_left_join(facts, lookup, [("k", "o")], null_safe=null_safe)
    assert most_in_a_task(joined) < 6_000
    found = {(r.v, r["count"]) for r in joined.groupBy("v").count().collect()}
    assert found == ({(7, 30_000), (8, 1), (9, 1), (None, 9_998)} if null_safe else {(8, 1), (9, 1), (None, 39_998)})


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("versions_of_two", [1, 40])
def test_facts_without_a_key_are_dealt_over_intervals(spark, shuffled, null_safe, versions_of_two):
    """Also beside an indexed key, which makes all facts go through the second join."""
    facts = keyless(spark)
    rows = [(None, 7, 0, 19_999), (None, 70, 20_000, None), ("4", 8, 0, 100)]
    rows += [("8", 100 + i, i * 10, i * 10 + 9) for i in range(versions_of_two)]
    versions = spark.createDataFrame(rows, "o string, v int, first long, last long")
    joined = interval_join(facts, versions, [("k", "o")], "id", "first", "last", null_safe=null_safe)
    assert most_in_a_task(joined) < 6_000
    found = {(r.v, r["count"]) for r in joined.groupBy("v").count().collect()}
    assert found == ({(7, 15_000), (70, 15_000), (8, 1), (100, 1), (None, 9_998)} if null_safe else {(8, 1), (100, 1), (None, 39_998)})
