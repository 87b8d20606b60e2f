import re

import pytest
from pyspark.sql import functions as F

from rillflow.operators import joins


@pytest.fixture
def big(spark):
    """A third of the rows has key 1, a third none, the others one key each."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN NULL ELSE id END")
    return spark.range(3000).select(F.col("id").alias("row_index"), key.alias("k"))


@pytest.fixture
def small(spark):
    return spark.range(0, 3000, 2).union(spark.range(1, 2)).select(
        F.col("id").alias("k"), (F.col("id") * 10).alias("v")
    )


def shuffle_keys(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    return [re.findall(r"(\w+)#", keys) for keys in found]


def result(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_spread_join_equals_plain_join(big, small, how):
    want = result(big.join(small, "k", how))
    assert result(joins.lookup(big, small, "k", how, small_fits=False)) == want
    assert result(joins.lookup(big, small, "k", how, small_fits=True)) == want


def test_only_the_hot_key_is_sliced(big):
    assert joins.hot_keys(big, "k", 8) == [(1, 4)]
    assert joins.hot_keys(big, "k", 1) == []


def test_hot_and_null_rows_spread_evenly(big, small):
    left, right = joins.spread(big, small, "k", "row_index", 8, joins.hot_keys(big, "k", 8))
    hot = left.where("k = 1").groupBy("_slice").count().collect()
    lost = left.where("k IS NULL").groupBy("_slice").count().collect()
    assert len(hot) == 4 and max(r["count"] for r in hot) < 400
    assert len(lost) == 8 and max(r["count"] for r in lost) < 250
    assert right.where("k = 1").count() == 4
    assert right.where("k <> 1").count() == small.where("k <> 1").count()


def test_all_unique_keys_need_no_hot_table(spark, small):
    even = spark.range(1000).select(F.col("id").alias("row_index"), F.col("id").alias("k"))
    left, right = joins.spread(even, small, "k", "row_index", 8, joins.hot_keys(even, "k", 8))
    assert {r["_slice"] for r in left.collect()} == {r["_slice"] for r in right.collect()} == {0}


def test_null_keys_spread_without_a_hot_key(spark, small, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    key = F.expr("CASE WHEN id % 2 = 0 THEN id END")
    df = spark.range(1000).select(F.col("id").alias("row_index"), key.alias("k"))
    try:
        for how in ("left", "left_anti"):
            assert shuffle_keys(joins.lookup(df, small, "k", how)) == [["k", "_slice"]] * 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_size_is_measured_with_its_text(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "k long, t string")
    assert joins.measured_bytes(df) == 2 * 16 + 3
    assert joins.fits_broadcast(df, 35) and not joins.fits_broadcast(df, 34)
    assert joins.measured_bytes(df.where("k > 5")) == 0


def test_too_large_a_side_is_not_broadcast(big, small, monkeypatch, spark):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = joins.lookup(big, small, "k")
        assert shuffle_keys(df) == [["k", "_slice"]] * 2
        assert result(df) == result(big.join(small, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
