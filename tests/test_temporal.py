import random

import pytest
from pyspark.sql import functions as F

from civiframe.operators.temporal import interval_join, traffic_statistics
from civiframe.plans.traffic import traffic_plan


def brute_force(facts, versions, closed, null_safe, how):
    out = []
    for fid, key, ts in facts:
        hits = [
            vid
            for vid, vkey, start, end in versions
            if (key == vkey if null_safe or key is not None else False)
            and (vkey is not None or null_safe)
            and ts >= start
            and (end is None or ts < end or (closed and ts == end))
        ]
        out += [(fid, v) for v in hits] or ([(fid, None)] if how == "left" else [])
    return sorted(out, key=str)


@pytest.mark.parametrize("closed, null_safe, how", [(True, True, "left"), (False, False, "inner"), (True, False, "left")])
def test_interval_join_equals_brute_force(spark, closed, null_safe, how):
    rng = random.Random(7)
    keys = ["hot"] * 6 + ["a", "b", None]
    facts = [(i, rng.choice(keys), rng.randrange(0, 4000)) for i in range(400)]
    versions = []
    for n, key in enumerate(["hot"] * 40 + ["a"] * 3 + ["b", None, "unused"]):
        start = rng.randrange(0, 3500)
        versions.append((n, key, start, rng.choice([None, start, start + rng.randrange(0, 900)])))
    day = F.lit("2022-01-01").cast("timestamp_ntz")

    def moment(name):
        return day + F.make_dt_interval(hours=F.col(name))

    left = spark.createDataFrame(facts, "fid int, key string, ts int").withColumn("ts", moment("ts"))
    right = spark.createDataFrame(versions, "vid int, vkey string, start int, end int").withColumns(
        {"start": moment("start"), "end": moment("end")}
    )
    joined = interval_join(
        left, right, [("key", "vkey")], "ts", "start", "end",
        how=how, closed=closed, null_safe=null_safe,
    )
    got = sorted(((r.fid, r.vid) for r in joined.collect()), key=str)
    assert got == brute_force(facts, versions, closed, null_safe, how)
    assert not [c for c in joined.columns if c.startswith("_")]


def test_many_versions_and_malformed_times(spark):
    """A key with 1,000 versions; malformed and null times lie in no interval and disturb no other row."""
    versions = spark.range(1000).selectExpr(
        "'s1' as vkey", "id as vid", "cast(date_add(date'2020-01-01', cast(id as int)) as string) as start",
        "cast(date_add(date'2020-01-01', cast(id as int) + 1) as string) as end",
    ).unionAll(spark.createDataFrame([("s2", 5000, "2020-01-01", None), ("s2", 5001, "worse", None), ("s3", 6000, "2020-01-01", "bad")],
                                     "vkey string, vid long, start string, end string"))
    facts = spark.createDataFrame(
        [(1, "s1", "2020-03-01T10:00:00"), (2, "s2", "zz bad"), (3, "s1", None), (4, "s2", "2021-01-01"), (5, "s3", "2021-01-01")],
        "fid int, key string, ts string",
    )
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    joined = interval_join(facts, versions, [("key", "vkey")], "ts", "start", "end", closed=False)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == len(jobs)
    assert sorted((r.fid, r.vid) for r in joined.collect() if r.vid is not None) == [(1, 60), (4, 5000)]
    assert joined.count() == 5


@pytest.mark.parametrize("how, closed", [("left", True), ("left", False), ("inner", True)])
def test_indexed_keys_equal_brute_force(spark, how, closed):
    """Overlapping, touching and distant versions, gaps, open ends and times at the very borders."""
    rng = random.Random(17)
    versions, n = [], 0
    for key in ("touching", "overlapping", "apart", None):
        for k in range(60):
            start = 50 * k if key == "touching" else rng.randrange(0, 3000)
            size = {"touching": 50, "overlapping": rng.choice([1, 30, 2500]), "apart": 3}.get(key, rng.randrange(1, 90))
            versions.append((n, key, start, None if key == "overlapping" and k == 7 else start + size))
            n += 1
    facts = [(i, rng.choice(["touching", "overlapping", "apart", None, "unknown"]), rng.randrange(-100, 3200)) for i in range(1500)]
    day = F.lit("2022-01-01").cast("timestamp_ntz")
    left = spark.createDataFrame(facts, "fid int, key string, ts int").withColumn("ts", day + F.make_dt_interval(hours=F.col("ts")))
    moments = {c: day + F.make_dt_interval(hours=F.col(c)) for c in ("start", "end")}
    right = spark.createDataFrame(versions, "vid int, vkey string, start int, end int").withColumns(moments)
    joined = interval_join(left, right, [("key", "vkey")], "ts", "start", "end", how=how, closed=closed, null_safe=True)
    assert joined.columns == ["fid", "key", "ts", "vid", "vkey", "start", "end"]
    assert sorted(((r.fid, r.vid) for r in joined.collect()), key=str) == brute_force(facts, versions, closed, True, how)


def test_a_key_with_many_versions_meets_few(spark):
    """Rows that the tree brings together for each fact hardly grow with the versions of its key."""
    from civiframe.operators import temporal

    met = []
    for n in (1_000, 10_000):
        versions = spark.range(n).select(
            F.lit("k").alias("vkey"), F.col("id").alias("vid"), (F.col("id") * 10).alias("start"), (F.col("id") * 10 + 10).alias("end")
        )
        facts = spark.range(2_000).select(F.lit("k").alias("key"), F.col("id").alias("fid"), (F.col("id") * (n * 10 // 2_000)).alias("ts"))
        every = temporal.interval_join(facts, versions, [("key", "vkey")], "ts", "start", "end", closed=False)
        assert every.where("vid = ts div 10").count() == every.count() == 2_000
        met.append(pairs_before_the_residual(every) / 2_000)
    assert met[1] < met[0] + 10 and met[1] < 40


def pairs_before_the_residual(frame):
    """Pairs that agree in key and node, from the two inputs of the last join (all of one key here)."""
    from pyspark.sql import DataFrame

    node = frame._jdf.queryExecution().analyzed()
    while node.nodeName() != "Join":
        node = node.children().head()
    spark = frame.sparkSession

    def side(child, name):
        rows = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, child), spark)
        return rows.groupBy(F.col(name).alias("node")).agg(F.count("*").alias(f"n{name}"))

    left, right = side(node.left(), "_node"), side(node.right(), "_listed")
    return left.join(right, "node").agg(F.sum(F.col("n_node") * F.col("n_listed"))).first()[0]


def test_fifteen_equal_readings_fall_into_two_windows(spark):
    rows = [(f"2021-02-25T14:{22 + m}:00+02:00", "213_D", 46, 10, 0, "freeFlow") for m in range(5)]
    rows += [(f"2021-02-25T14:{30 + m}:00+02:00", "213_D", 46, 10, 0, "freeFlow") for m in range(10)]
    rows += [("2021-02-25T04:59:00+02:00", "213_D", 1, 1, 1, "night"), ("bad date", "213_D", 1, 1, 1, "bad")]
    raw = spark.createDataFrame(
        rows,
        "datetime string, predefinedLocationReference string, averageVehicleSpeed int, travelTime int,"
        " travelTimeReliability int, trafficStatus string",
    )
    out = traffic_plan(raw, "2021-02-25").orderBy("start_time").collect()
    assert [(str(r.start_time), r.nb_values, r.speed_avg, r.speed_std) for r in out] == [
        ("2021-02-25 14:15:00", 5, 46.0, 0.0),
        ("2021-02-25 14:30:00", 10, 46.0, 0.0),
    ]
    assert out[0].technical_key == "213_D_2021-02-25 14:15:00_2021_02_04"


def test_statistics_shuffle_once(spark):
    df = spark.range(100).select(
        F.lit("s").alias("segment"), F.lit("2021-02-25 14:00:00").cast("timestamp_ntz").alias("date"),
        F.col("id").cast("int").alias("avgSpeed"), F.col("id").cast("int").alias("reliability"),
    )
    plan = traffic_statistics(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan
