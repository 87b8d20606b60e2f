"""Classification that moves ids instead of rows, and load guards that leave history in place."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators import joins
from rillflow.operators.joins import already_in, frequent_keys
from rillflow.operators.quality import classify, clean
from rillflow.sources.testtables import RAW_FRAMES
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def frames(spark):
    raw = {s: build(spark, SF_DIR).repartition(3) for s, build in RAW_FRAMES.items()}
    return raw["weblogs"], *(clean(classify(raw[s], s), s) for s in ("users", "products"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_move_once_where_tables_are_large(frames, spark, monkeypatch):
    logs, users, products = frames
    want = classify(logs, "weblogs", users=users, products=products)
    assert plan_of(want).count("raw#") > 0
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = classify(logs, "weblogs", users=users, products=products)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        exchanges = [
            line for line in got._jdf.queryExecution().toString().split("Physical Plan")[-1].splitlines()
            if "Exchange hashpartitioning" in line
        ]
        assert sum("row_index" in e.split("hashpartitioning(")[1].split(",")[0] for e in exchanges) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))


def test_frequent_keys_finds_all_hot_ones(spark):
    rows = spark.range(40_000).select(
        F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id END").alias("a"),
        F.expr("id % 2").alias("b"),
        F.col("id").alias("c"),
    )
    hot = frequent_keys(rows, ["a", "b", "c"])
    assert [k for k, _ in hot["a"]] == [7] and hot["a"][0][1] == 2
    assert sorted(hot["b"]) == [(0, 2), (1, 2)] and hot["c"] == []
    assert frequent_keys(rows.where("false"), ["a"]) == {"a": []}


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_already_in(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    history = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    new = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (None, "n")], "k long, v string")
    assert [r.k for r in already_in(history, new, "k").collect()] == [2]
    assert already_in(history.where("false"), new, "k").isEmpty()
