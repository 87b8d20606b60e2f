from pyspark.sql import functions as F

from rillflow.operators import joins
from rillflow.operators.dedupe import flag_repeats, keep_first, keep_latest


def frame(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row_index long, k long")


def flags(df, name="again"):
    return [r[name] for r in df.orderBy("row_index").collect()]


def test_repeats_within(spark):
    df = flag_repeats(frame(spark, [1, 2, 1, 3, 2, None, None]), "k", "again")
    assert flags(df) == [False, False, True, False, True, False, False]


def test_repeats_against_seen(spark):
    seen = spark.createDataFrame([(11,), (99,), (11,), (None,)], "k long")
    df = flag_repeats(frame(spark, [10, 11, 12, None]), "k", "again", seen=seen)
    assert flags(df) == [False, True, False, False]


def test_repeats_do_not_depend_on_partitions(spark):
    df = frame(spark, [7] * 50 + list(range(50)) + [7, 49])
    want = flags(flag_repeats(df, "k", "again"))
    for n in (1, 3, 13):
        mixed = df.repartition(n, F.rand(1))
        assert flags(flag_repeats(mixed, "k", "again")) == want


def test_repeats_with_a_hot_key_and_no_broadcast(spark, monkeypatch):
    key = F.expr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id % 500 END")
    df = spark.range(3000).select(F.col("id").alias("row_index"), key.alias("k"))
    want = flags(flag_repeats(df, "k", "again"))
    firsts = {}
    for row in df.orderBy("row_index").collect():
        firsts.setdefault(row.k, row.row_index)
    rows = df.orderBy("row_index").collect()
    assert want == [r.k is not None and firsts[r.k] < r.row_index for r in rows]
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10)
    marked = flag_repeats(df, "k", "again")
    assert flags(marked) == want
    plan = marked._jdf.queryExecution().toString()
    assert "Window" not in plan and "_slices" in plan


def test_keep_first_takes_null_as_one_key(spark):
    df = spark.createDataFrame(
        [(0, 1, "a"), (1, 1, "b"), (2, 2, "c"), (3, 3, "d"), (4, 3, "e"), (5, None, "f"),
         (6, None, "g")],
        "row_index long, k long, v string",
    )
    kept = keep_first(df, ["k"]).orderBy("row_index")
    assert [r.v for r in kept.collect()] == ["a", "c", "d", "f"]


def test_keep_latest_leaves_null_keys(spark):
    df = frame(spark, [3, None, 3, 4, None])
    assert flags(keep_latest(df, "k"), "row_index") == [1, 2, 3, 4]


def test_keep_latest_limits_before_the_shuffle(spark):
    plan = keep_latest(frame(spark, [1]), "k")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
