"""Hot keys: the balanced LAG equals the plain window and spreads a hot person."""

import random

import pytest
from pyspark.sql import functions as F

from wayfarer.operators import relational as rel


def _trips(spark, seed=5):
    rng = random.Random(seed)
    rows = []
    tid = 0
    for _ in range(3000):                       # one person with half of all rows
        tid += 1
        rows.append((7, 70, tid, rng.choice([None, 10, 20, 30])))
    for p in range(300):
        for _ in range(rng.randint(1, 8)):
            tid += 1
            rows.append((rng.choice([p, p, p, None]), rng.choice([1, 2]), tid, rng.choice([None, 5, 50])))
    return spark.createDataFrame(rows, "person_id bigint, hh_id bigint, trip_id bigint, v int")


@pytest.fixture()
def small_pieces(spark):
    spark.conf.set("wayfarer.skew.hotKeyRows", "40")
    yield
    spark.conf.unset("wayfarer.skew.hotKeyRows")


def _text_ids(df):
    return df.withColumns({c: F.concat(F.lit("k"), F.lpad(F.col(c).cast("string"), 6, "0")) for c in ("person_id", "hh_id", "trip_id")})


ORDER = ["hh_id", "person_id", "trip_id"]


@pytest.mark.parametrize("text_ids", [False, True])
def test_balanced_lag_equals_window(spark, small_pieces, text_ids):
    df = _text_ids(_trips(spark)) if text_ids else _trips(spark)
    plain = rel.previous_value(df, F.col("v"), ["person_id"], [F.col(c).asc() for c in ORDER], "lag")
    a = sorted((tuple(r) for r in plain.select("trip_id", "lag").collect()), key=repr)
    for range_keys in (None, 1):
        bal = rel.previous_value_balanced(df, F.col("v"), "person_id", ORDER, "lag", range_keys=range_keys)
        assert sorted((tuple(r) for r in bal.select("trip_id", "lag").collect()), key=repr) == a
    bal = rel.previous_value_balanced(df, F.col("v"), "person_id", ORDER, "lag", key_source=df)
    assert sorted((tuple(r) for r in bal.select("trip_id", "lag").collect()), key=repr) == a


def test_hot_null_person(spark, small_pieces):
    df = _trips(spark).withColumn("person_id", F.when(F.col("person_id") != 7, F.col("person_id")))
    plain = rel.previous_value(df, F.col("v"), ["person_id"], [F.col(c).asc() for c in ORDER], "lag")
    bal = rel.previous_value_balanced(df, F.col("v"), "person_id", ORDER, "lag")
    assert rel.HotRanges.find(df, "person_id", ["hh_id", "trip_id"]).table.where("__lead is null").count() == 1
    assert sorted(map(repr, plain.select("trip_id", "lag").collect())) == sorted(map(repr, bal.select("trip_id", "lag").collect()))


def test_thousands_of_pieces(spark):
    """Many pieces of one person: built fast (no per-piece literals) and exact."""
    import time
    df = spark.range(6000).select(F.lit(1).cast("long").alias("person_id"), (F.col("id") * 7919 % 6007).alias("hh_id"),
                                  F.col("id").alias("trip_id"), F.col("id").cast("int").alias("v"))
    spark.conf.set("wayfarer.skew.hotKeyRows", "8")
    t = time.time()
    try:
        ranges = rel.HotRanges.find(df, "person_id", ["hh_id", "trip_id"])
        assert ranges.table.first()["__pieces"] >= 4096
        bal = rel.previous_value_balanced(df, F.col("v"), "person_id", ORDER, "lag")
        got = sorted(tuple(r) for r in bal.select("trip_id", "lag").collect())
    finally:
        spark.conf.unset("wayfarer.skew.hotKeyRows")
    assert time.time() - t < 120
    want = sorted(((a[1], b[1] if b else None) for a, b in _pairs(sorted((i * 7919 % 6007, i) for i in range(6000)))))
    assert got == want


def _pairs(x):
    return [(a, x[i - 1] if i else None) for i, a in enumerate(x)]


def test_hot_person_is_spread_over_tasks(spark, small_pieces):
    df = _trips(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        ranges = rel.HotRanges.find(df, "person_id", ["hh_id", "trip_id"])
        per_task = (ranges.with_piece(df, "__piece").repartition("person_id", "__piece").where(F.col("person_id") == 7)
                    .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(per_task) >= 6
    assert max(r["count"] for r in per_task) <= 3000 / 3


def test_unlinked_trips_shuffle_once_for_join_and_window(spark):
    """The person join and the window share one partitioning; nothing is planned per range."""
    import re

    import __spark_entry__ as E
    df = E.queries()["trip_unlinked"](spark, "/root/testdata/sf0.001")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("Window [") == 1
    above = p[p.index("Window ["):p.index("l_orderkey", p.index("Window ["))]
    assert len(re.findall(r"Exchange hashpartitioning\(person_id", above)) <= 1


def test_builds_fast_at_cluster_shuffle_width(spark):
    import time

    import __spark_entry__ as E
    spark.conf.set("spark.sql.shuffle.partitions", "8000")
    t = time.time()
    try:
        E.queries()["trip_unlinked"](spark, "/root/testdata/sf0.001")
        E.queries()["activity_gap"](spark, "/root/testdata/sf0.001")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert time.time() - t < 60


def _linked_join(spark, sf):
    from wayfarer.plans.queries import Inputs
    from wayfarer.plans import tables as T
    from wayfarer.functions import recode as R
    i = Inputs(spark, sf)
    t = i.trip_linked_src.withColumn("linked_trip_mode_t", R.linked_mode_label())
    return T.attach_unlinked(t, i.core_trip)


def test_salted_six_key_join_equals_plain(spark):
    from wayfarer.functions import codes
    sf = "/root/testdata/sf0.001"
    cols = ["linked_trip_id", *codes.GUARDED_TRIP_ATTRS]
    spark.conf.set("wayfarer.skew.hotKeyRows", "1000000000")
    base = sorted(tuple(r) for r in _linked_join(spark, sf).select(*cols).collect())
    spark.conf.set("wayfarer.skew.hotKeyRows", "2")      # every repeated key counts as hot
    spark.conf.set("wayfarer.skew.sampleFraction", "1.0")
    try:
        hot = rel.SaltedKeys.detect(spark.createDataFrame([(1, 2)] * 3 + [(3, 4), (5, None), (5, None)], "a long, b long"), ["a", "b"]).hot
        assert [(r["__h0"], r["__h1"]) for r in hot.collect()] == [(1, 2)]
        df = _linked_join(spark, sf)
        salted = sorted(tuple(r) for r in df.select(*cols).collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("wayfarer.skew.hotKeyRows")
        spark.conf.unset("wayfarer.skew.sampleFraction")
    assert salted == base
    assert "__salt" in plan


def test_six_key_join_shuffles_each_side_once(spark):
    """Without hot keys too the salt stays a join key: no second exchange behind the explicit one."""
    from wayfarer.plans.queries import registry
    df = registry()["composite_trip_join"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    by_keys = [x for x in plan.splitlines() if "hashpartitioning(" in x and "depart_seconds" in x and "arrive" not in x]
    # linked trips, unlinked trips, and the window that keeps one unlinked trip per key
    assert len(by_keys) == 3, plan
