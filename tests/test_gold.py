from pyspark.sql import functions as F

from rillflow.operators import joins
from rillflow.operators.keys import dense_numbers
from rillflow.plans import bi, checks, gold
from rillflow.plans.silver import to_silver
from rillflow.schemas import DIM_PRODUCT, DIM_USER, FACT
from rillflow.session import pin


def users_of(spark, rows):
    return spark.createDataFrame(rows, "user_id long, user_name string, email string, s string, d string").select(
        "user_id", "user_name", "email", F.col("s").cast("date").alias("signup_date"),
        F.col("d").cast("date").alias("etl_run_date"),
    )


def test_dense_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = dense_numbers(df.repartition(5), ["k"], "n", 11).orderBy("k").collect()
    assert [r.n for r in got] == list(range(11, 1011))


def test_user_upsert(spark, ctx, ctx_next):
    empty = spark.createDataFrame([], DIM_USER)
    one = users_of(spark, [(5, "E", "e@x", "2024-01-05", "2024-06-07"), (2, "B", "b@x", "2024-01-02", "2024-06-07")])
    first = gold.user_dimension(empty, one, ctx)
    assert {(r.user_sk, r.user_id, r._change) for r in first.collect()} == {(1, 2, "insert"), (2, 5, "insert")}
    two = one.unionByName(
        users_of(spark, [(5, "E2", "e2@x", "2020-01-01", "2024-06-08"), (1, "A", "a@x", "2024-01-01", "2024-06-08")])
    )
    second = gold.user_dimension(first.drop("_change"), two, ctx_next)
    rows = {r.user_id: r for r in second.collect()}
    assert rows[5].user_sk == 2 and rows[5].user_name == "E2"
    assert str(rows[5].signup_date) == "2024-01-05"  # set on insert only
    assert rows[5].dw_created_at == ctx.run_ts and rows[5].dw_updated_at == ctx_next.run_ts
    assert rows[1].user_sk == 3 and rows[1].dw_created_at == ctx_next.run_ts
    assert {k: r._change for k, r in rows.items()} == {1: "insert", 2: "update", 5: "update"}


def test_rows_missing_from_the_source_are_kept(spark, ctx, ctx_next):
    one = users_of(spark, [(1, "A", "a", "2024-01-01", "2024-06-07")])
    first = gold.user_dimension(spark.createDataFrame([], DIM_USER), one, ctx).drop("_change")
    row = gold.user_dimension(first, one.where("false"), ctx_next).first()
    assert row._change == "keep" and row.dw_updated_at == ctx.run_ts


def test_product_upsert_refreshes_price(spark, ctx, ctx_next):
    def source(price, day):
        df = spark.createDataFrame([(10, "W", "C", price)], "product_id long, product_name string, category string, price double")
        return df.withColumn("etl_run_date", F.lit(day).cast("date"))

    first = gold.product_dimension(spark.createDataFrame([], DIM_PRODUCT), source(1.0, "2024-06-07"), ctx)
    second = gold.product_dimension(first.drop("_change"), source(2.0, "2024-06-08"), ctx_next)
    assert [(r.product_sk, r.price) for r in second.collect()] == [(1, 2.0)]


def silver_logs(spark, ctx, rows):
    df = spark.createDataFrame(
        rows,
        "log_id long, user_id long, product_id long, session_id string, action string, "
        "timestamp string, row_index long",
    )
    return to_silver(df, ctx)


def stars(spark):
    users = spark.createDataFrame([(7, 1), (8, 2)], "user_sk long, user_id long")
    products = spark.createDataFrame([(70, 10), (80, 20)], "product_sk long, product_id long")
    return users, products


LOGS = [
    (1, 1, 10, "sess_1", "view", "2024-06-01T10:00:00", 0),
    (2, 1, None, "sess_1", "view", "2024-06-01T10:01:00", 1),
    (None, 2, 20, "sess_2", "purchase", "2024-06-01T10:02:00", 2),
    (4, 9, 20, "sess_2", "purchase", "2024-06-01T10:02:00", 3),
]


def test_facts_and_their_load_guard(spark, ctx, monkeypatch):
    users, products = stars(spark)
    logs = silver_logs(spark, ctx, LOGS)
    for limit in (joins.BROADCAST_BYTES, 0):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        rows = gold.fact_rows(logs, users, products)
        got = {(r.log_id, r.user_sk, r.product_sk) for r in rows.collect()}
        assert got == {(1, 7, 70), (None, 8, 80)}
        again = gold.fact_rows(logs, users, products, rows)
        assert [r.log_id for r in again.collect()] == [None]  # NULL is never loaded already


def test_activity_ids_are_unique_and_go_on(spark, ctx):
    users, products = stars(spark)
    none = spark.createDataFrame([], FACT)
    rows = gold.fact_rows(silver_logs(spark, ctx, LOGS * 10).repartition(3), users, products)
    one = pin(gold.number_facts(rows, none).select(*FACT.names))  # ids are fixed once written
    ids = [r.activity_id for r in one.collect()]
    assert len(set(ids)) == len(ids) == 20
    two = [r.activity_id for r in gold.number_facts(rows, one).collect()]
    assert min(two) > max(ids)


def test_checks_find_broken_keys(spark, ctx):
    users, products = stars(spark)
    broken = gold.fact_rows(silver_logs(spark, ctx, LOGS + LOGS[:1]), users, products, how="left")
    assert checks.orphan_users(broken, users).first()[0] == 1
    assert checks.null_keys(broken).first().asDict() == {"null_user_sk": 1, "null_product_sk": 1}
    assert [tuple(r) for r in checks.duplicate_log_ids(broken).collect()] == [(1, 2)]
    plan = checks.orphan_users(broken, users)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan


def test_daily_stats_and_conversion(spark, ctx):
    users, products = stars(spark)
    fact = gold.fact_rows(silver_logs(spark, ctx, LOGS), users, products)
    got = {(r.product_sk, r.views, r.purchases) for r in gold.product_daily_stats(fact).collect()}
    assert got == {(70, 1, 0), (80, 0, 1)}
    named = products.withColumn("product_name", F.lit("same"))
    assert bi.product_conversion(fact, named).first().product_cvr == 1.0
    assert bi.most_viewed_products(fact, named).collect()[0].view_count == 1
