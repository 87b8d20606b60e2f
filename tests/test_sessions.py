import pytest
from pyspark.sql import functions as F

from rillflow.operators import sessions as S
from rillflow.plans.silver import enrich, in_session_order, to_silver


def logs(spark, rows):
    df = spark.createDataFrame(rows, "session_id string, action string, t string")
    return df.select("session_id", "action", F.col("t").cast("timestamp_ntz").alias("action_ts"))


DAY = "2024-06-01 "
THREE = [
    ("s1", "view", DAY + "10:00:00"), ("s1", "add_to_cart", DAY + "10:05:00"),
    ("s1", "purchase", DAY + "10:10:00"), ("s2", "view", DAY + "11:00:00"),
    ("s2", "view", DAY + "11:01:00"), ("s3", "view", DAY + "12:00:00"),
]


def by_session(df):
    return {r.session_id: r for r in df.collect()}


def test_metrics_by_hand(spark):
    got = by_session(S.session_metrics(logs(spark, THREE)))
    assert {k: r.session_duration_s for k, r in got.items()} == {"s1": 600.0, "s2": 60.0, "s3": 0.0}
    assert got["s1"].total_actions == 3 and got["s1"].conversion_rate == 1.0
    assert got["s2"].conversion_rate == 0.0 and not got["s2"].is_abandoned_cart
    assert len(got["s1"]) == 11


def test_unknown_actions_are_null_in_silver_and_counted_in_gold(spark):
    rows = [("s1", None, DAY + "10:00:00.9"), ("s1", None, DAY + "10:00:02.1")]
    silver = by_session(S.session_metrics(logs(spark, rows)))["s1"]
    assert silver.total_actions is None and silver.is_abandoned_cart is False
    assert abs(silver.session_duration_s - 1.2) < 1e-9
    frame = logs(spark, rows).withColumns(
        {"user_id": F.lit(1).cast("long"), "etl_run_date": F.lit("2024-06-07").cast("date")}
    )
    dim = spark.createDataFrame([(7, 1)], "user_sk long, user_id long")
    gold = S.gold_session_metrics(frame, dim).collect()
    assert len(gold) == 1
    assert (gold[0].total_actions, gold[0].total_views, gold[0].session_duration_s) == (2, 0, 2.0)
    assert gold[0].conversion_rate is None and gold[0].user_sk == 7


def test_shared_session_has_a_gold_row_per_user(spark):
    frame = logs(spark, THREE[:3]).withColumns(
        {
            "user_id": F.when(F.col("action") == "view", 1).otherwise(2).cast("long"),
            "etl_run_date": F.lit("2024-06-07").cast("date"),
        }
    )
    dim = spark.createDataFrame([(7, 1), (8, 2)], "user_sk long, user_id long")
    got = S.gold_session_metrics(frame, dim)
    assert sorted(r.user_sk for r in got.collect()) == [7, 8]
    assert S.gold_session_metrics(frame, dim, got).count() == 0


def test_long_sessions(spark):
    df = spark.createDataFrame(
        [(float(x),) for x in (100, 105, 95, 102, 98, 101, 99, 1000)], "session_duration_s double"
    )
    assert [r[0] for r in S.flag_long(df).where("is_long_session").collect()] == [1000.0]
    assert S.flag_long(df.limit(1)).where("is_long_session").count() == 0


def test_silver_by_hand(spark, ctx):
    bronze = spark.createDataFrame(
        [
            (1, 1, 10, "s1", "purchase", "2024-06-01T10:10:00", 0),
            (2, 1, 20, "s1", "view", "2024-06-01T10:00:00", 1),
            (3, 2, 10, "s2", "view", "2024-06-01T11:00:00", 2),
            (4, 2, 20, "s2", " ADD_TO_CART ", "2024-06-01T11:05:00", 3),
            (5, 1, None, "s1", "purchase", "2024-06-01T10:20:00", 4),
        ],
        "log_id long, user_id long, product_id long, session_id string, action string, "
        "timestamp string, row_index long",
    )
    users = spark.createDataFrame(
        [(1, "Alice", "alice@x.com"), (2, "Bob", "bob@x.com")],
        "user_id long, user_name string, email string",
    )
    products = spark.createDataFrame(
        [(10, "Widget", "Electronics", 9.99), (20, "Gadget", "Home", 19.99)],
        "product_id long, product_name string, category string, price double",
    )
    plain = to_silver(bronze, ctx)
    silver = in_session_order(enrich(plain, users, products))
    rows = silver.collect()
    assert [r.action for r in rows if r.session_id == "s1"] == ["view", "purchase", "purchase"]
    first = next(r for r in rows if r.log_id == 1)
    assert (first.user_name, first.product_name, first.category, first.price) == (
        "Alice", "Widget", "Electronics", 9.99,
    )
    assert next(r for r in rows if r.log_id == 5).product_name is None
    got = by_session(S.session_metrics(plain))
    assert (got["s1"].session_duration_s, got["s1"].total_actions) == (1200.0, 3)
    assert got["s1"].conversion_rate == pytest.approx(2.0)
    assert got["s2"].session_duration_s == 300.0 and got["s2"].is_abandoned_cart
    counts = S.anomaly_counts(S.session_metrics(plain)).first()
    assert (counts.abandoned_cart, counts.high_activity) == (1, 0)


def test_busy_session_is_split_over_partitions(spark):
    df = spark.range(20000).select(
        F.lit("sess_1").alias("session_id"),
        F.expr("timestampadd(SECOND, cast(id AS int), TIMESTAMP_NTZ'2024-01-01')").alias("action_ts"),
        F.col("id").alias("row_index"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = in_session_order(df).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 10000
