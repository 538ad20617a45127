"""W4, A12, D1 (property: upsert is idempotent)."""
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from costlake.operators.keys import assign_surrogate_keys, max_key
from costlake.operators.upsert import upsert, upsert_partitions
from tests.conftest import rows


def test_range_keys_equal_row_number(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10_000_000), 5000)
    df = spark.createDataFrame([(i, f"n{i}") for i in ids], "cid long, name string").repartition(7)
    got = assign_surrogate_keys(df, ["cid"], "k", start=100, method="range")
    ref = df.withColumn("k", F.row_number().over(Window.orderBy("cid")) + 100)
    assert rows(got, "cid", "k") == rows(ref, "cid", "k")
    g = assign_surrogate_keys(df, ["cid"], "k", start=100, method="global")
    assert rows(g, "cid", "k") == rows(ref, "cid", "k")


def test_range_keys_empty(spark):
    df = spark.createDataFrame([], "cid long")
    assert assign_surrogate_keys(df, ["cid"], "k", 5).count() == 0


def test_max_key(spark):
    assert max_key(None, "k") == 0
    assert max_key(spark.createDataFrame([], "k long"), "k") == 0
    assert max_key(spark.createDataFrame([(3,), (9,)], "k long"), "k") == 9


def _t(spark, data):
    return spark.createDataFrame(data, "k1 string, k2 int, a int, b string")


def test_upsert_semantics(spark):
    t = _t(spark, [("x", 1, 10, "old"), ("y", 1, 20, "old")])
    s = _t(spark, [("x", 1, 11, "new"), ("z", 1, 30, "new")])
    got = rows(upsert(t, s, ["k1", "k2"], ["a"]))
    # x: a updated, b kept; y kept (never deleted); z inserted
    assert got == [("x", 1, 11, "old"), ("y", 1, 20, "old"), ("z", 1, 30, "new")]


def test_upsert_idempotent_random(spark):
    rng = random.Random(11)
    for _ in range(3):
        t = _t(spark, [(rng.choice("abcdef"), k, rng.randint(0, 9), "t") for k in range(20)])
        t = t.dropDuplicates(["k1", "k2"])
        s = _t(spark, [(rng.choice("abcdefg"), k, rng.randint(0, 9), "s") for k in range(10, 30)])
        s = s.dropDuplicates(["k1", "k2"])
        once = upsert(t, s, ["k1", "k2"], ["a", "b"])
        twice = upsert(once, s, ["k1", "k2"], ["a", "b"])
        assert rows(once) == rows(twice)


def test_upsert_partitions_only_touched(spark):
    t = spark.createDataFrame([("d1", 1, 5), ("d2", 1, 6)], "usage_date string, k int, v int")
    s = spark.createDataFrame([("d2", 1, 7), ("d2", 2, 8)], "usage_date string, k int, v int")
    got = rows(upsert_partitions(t, s, ["usage_date", "k"], ["v"], "usage_date"))
    assert got == [("d2", 1, 7), ("d2", 2, 8)]


def test_upsert_duplicate_source_key_fails(spark):
    import pytest
    t = _t(spark, [("x", 1, 10, "old")])
    s = _t(spark, [("x", 1, 11, "a"), ("x", 1, 12, "b")])
    with pytest.raises(Exception, match="duplicate key in upsert source"):
        upsert(t, s, ["k1", "k2"], ["a"]).collect()


def test_unique_rows_hot_key_fails_and_clean_passes(spark):
    import pytest
    from costlake.operators.upsert import unique_rows
    hot = spark.range(30000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "CAST(id AS STRING) AS v")
    with pytest.raises(Exception, match="duplicate key in hot: 7"):
        unique_rows(hot, ["k"], "hot").collect()
    clean = spark.range(1000).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    assert unique_rows(clean, ["k"], "clean").count() == 1000
