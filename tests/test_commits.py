"""Writes that count once they are listed, and the store of seen ids."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from rillflow.operators.quality import classify, clean, quarantine
from rillflow.sources.lake import Lake
from rillflow.streaming import idstore
from rillflow.streaming.idstore import IdStore
from tests.conftest import PRODUCTS, USERS


@pytest.fixture(params=["parquet", "csv"])
def lake(spark, tmp_path, request):
    return Lake(spark, str(tmp_path / "lake"), request.param)


@pytest.fixture
def users(raw):
    return clean(classify(raw("users", USERS), "users"), "users")


def ids(df, key="user_id"):
    return sorted(r[0] for r in df.select(key).collect())


def test_a_failed_second_write_leaves_the_first_data(lake, users, raw, ctx):
    lake.write_bronze(users, "users", ctx)
    judged = classify(raw("products", [*PRODUCTS, (None, "x", "y", 1.0)]), "products")
    lake.write_quarantine(quarantine(judged, "products", "p.csv", ctx), "products", ctx)
    fails = F.when(F.col("row_index") >= 0, F.raise_error(F.lit("disk is gone")))
    with pytest.raises(Exception, match="disk is gone"):
        lake.write_bronze(users.withColumn("user_name", fails.cast("string")), "users", ctx)
    with pytest.raises(Exception, match="disk is gone"):
        records = quarantine(judged, "products", "p.csv", ctx)
        lake.write_quarantine(records.withColumn("raw_row", fails.cast("string")), "products", ctx)
    assert ids(lake.read_bronze("users", ctx)) == ids(users)
    assert lake.read_quarantine().count() == 1
    assert lake.vacuum() == 0


def test_runs_of_one_day_stay_apart(lake, users, ctx):
    other = replace(ctx, run_id="run-c")
    lake.write_bronze(users.where("user_id = 1"), "users", ctx)
    lake.write_bronze(users.where("user_id > 1"), "users", other)
    # the day has its last batch load, a run its own
    assert ids(lake.read_bronze("users", ctx)) == ids(lake.read_bronze("users", other)) == ids(users)[1:]
    assert ids(lake.read_bronze("users", other, own=True)) == ids(users)[1:]
    # parts of streams stand beside it, run by run
    for n, run in enumerate((ctx, other)):
        lake.write_bronze(users.where("user_id = 1").withColumn("user_id", F.lit(70 + n).cast("long")), "users", run, part_id=0)
    assert ids(lake.read_bronze("users", ctx)) == [*ids(users)[1:], 70, 71]
    lake.write_bronze(users.where("user_id = 1"), "users", ctx)
    assert ids(lake.read_bronze("users", ctx)) == [1, 70, 71]
    files = lake.inventory("bronze", "users").agg(F.sum("rows")).first()[0]
    assert files == 3  # what was replaced does not count
    assert lake.vacuum() == 2 and ids(lake.read_bronze("users", ctx)) == [1, 70, 71]


def test_days_and_a_replayed_part(lake, users, ctx, ctx_next):
    lake.write_bronze(users, "users", ctx)
    assert lake.read_bronze("users", ctx_next).isEmpty()
    for keep in (3, 2):
        lake.write_bronze(users.where(F.col("user_id") < keep), "users", ctx_next, part_id=5)
    assert ids(lake.read_bronze("users", ctx_next)) == [1]
    assert lake.commits.superseded("bronze") and lake.vacuum("bronze") == 1
    assert lake.exists("bronze") and not lake.exists("silver")


def test_known_ids_over_merged_parts(spark, tmp_path, ctx, monkeypatch):
    monkeypatch.setattr(idstore, "FAN", 3)
    store = IdStore(Lake(spark, str(tmp_path / "lake")), ctx)
    frame = lambda rows: spark.createDataFrame([(x,) for x in rows], "log_id long")
    assert store.known(frame([1]), 0) is None
    seen = set()
    for batch in range(11):
        mine = [None, *range(batch * 10, batch * 10 + 12), -batch]
        known = store.known(frame(mine), batch)
        got = set() if known is None else {r[0] for r in known.collect()}
        assert got == seen & set(mine)
        store.add(frame(mine + mine[:4]), batch)
        store.merge(batch)
        # a replay of this batch sees what it saw before
        again = store.known(frame(mine), batch)
        assert (set() if again is None else {r[0] for r in again.collect()}) == got
        seen |= set(mine) - {None}
    sizes = [high - low + 1 for low, high, _ in store.parts()]
    assert sum(sizes) == 11 and sizes == [9, 1, 1]
    assert {r[0] for r in store.known(frame(range(-50, 200)), 11).collect()} == seen


def test_a_batch_reads_its_own_buckets(spark, tmp_path, ctx):
    store = IdStore(Lake(spark, str(tmp_path / "lake")), ctx)
    store.add(spark.range(5000).withColumnRenamed("id", "log_id"), 0)
    few = spark.createDataFrame([(17,), (4_000,), (99_999,)], "log_id long")
    known = store.known(few, 1)
    assert {r[0] for r in known.collect()} == {17, 4000}
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan.split("PartitionFilters:")[1][:120]
    assert "hashpartitioning(bucket" not in plan  # the store does not move
