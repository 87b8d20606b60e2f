"""Dirty raw sources derived from the given test tables by arithmetic on their keys.

``events`` become the web logs, ``customer`` the users and ``part`` the products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.schemas import RAW_COLUMNS


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _finish(df: DataFrame, source: str) -> DataFrame:
    text = [F.col(c).cast("string").alias(c) for c in RAW_COLUMNS[source]]
    return df.select(F.col("row_index").cast("bigint").alias("row_index"), *text)


def raw_weblogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "row_index": "event_id",
        "log_id": "CASE WHEN event_id > 0 AND event_id % 33 = 0 THEN event_id % 200 ELSE event_id END",
        "user_id": """CASE WHEN event_id % 20 = 7 THEN NULL
                           WHEN event_id % 13 = 5 THEN 1000000 + user_id
                           WHEN user_id <= 5 THEN 1 ELSE user_id END""",
        "product_id": """CASE WHEN event_id % 17 = 3 THEN 1000000
                              WHEN event_id % 41 = 6 THEN NULL
                              ELSE cast(get_json_object(props, '$.k') AS bigint) END""",
        "session_id": """CASE WHEN event_id % 19 = 2 THEN NULL
                              WHEN event_id % 19 = 11 THEN 'bad-session'
                              WHEN user_id <= 5 THEN 'sess_1'
                              WHEN event_id % 50 = 1 THEN 'sess_2'
                              ELSE concat('sess_', 1000 + user_id * 100 + day(ts)) END""",
        "action": """CASE event_type WHEN 'view' THEN ' View ' WHEN 'click' THEN 'Add_To_Cart'
                                     WHEN 'purchase' THEN 'PURCHASE' WHEN 'signup' THEN 'view'
                                     ELSE 'bogus' END""",
        "timestamp": """CASE WHEN event_id % 23 = 4 THEN 'invalid_timestamp'
                             ELSE cast(ts AS string) END""",
    }
    events = _read(spark, sf_dir, "events")
    return _finish(events.select(*[F.expr(e).alias(n) for n, e in rules.items()]), "weblogs")


def _copies(df: DataFrame, key: str) -> DataFrame:
    """Explode each row into its base copy and, for some keys, a second and a null-id copy."""
    part = F.filter(
        F.array(
            F.lit("base"),
            F.when(F.col(key), F.lit("second")),
            F.when(F.col("_lost"), F.lit("lost")),
        ),
        lambda p: p.isNotNull(),
    )
    return df.withColumn("part", F.explode(part))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "row_index": """CASE part WHEN 'base' THEN c_custkey * 2 WHEN 'second' THEN c_custkey * 2 + 1
                                  ELSE 1000000000 + c_custkey END""",
        "user_id": "CASE WHEN part <> 'lost' THEN c_custkey END",
        "user_name": """CASE part WHEN 'base' THEN CASE WHEN c_custkey % 20 <> 3 THEN c_name END
                                  WHEN 'second' THEN concat(c_name, ' v2') ELSE c_name END""",
        "email": """CASE part WHEN 'lost' THEN concat('n', c_custkey, '@x.com')
                              WHEN 'second' THEN concat('u', c_custkey, '@x.com')
                              ELSE CASE WHEN c_custkey % 10 = 4 THEN 'invalid_email'
                                        WHEN c_custkey % 15 = 6 THEN 'shared@x.com'
                                        WHEN c_custkey % 50 = 11 THEN NULL
                                        ELSE concat('u', c_custkey, '@x.com') END END""",
        "signup_date": """CASE WHEN part = 'base' AND c_custkey % 20 = 9 THEN 'invalid_date'
                               WHEN part = 'base' THEN cast(date_add(DATE'2019-01-01',
                                    cast(c_custkey * 7 % 1825 AS int)) AS string)
                               WHEN part = 'second' AND c_custkey % 74 = 0 THEN 'invalid_date'
                               ELSE '2024-01-01' END""",
    }
    keyed = _read(spark, sf_dir, "customer").withColumns(
        {"_second": F.expr("c_custkey % 37 = 0"), "_lost": F.expr("c_custkey % 100 = 50")}
    )
    rows = _copies(keyed, "_second").select(*[F.expr(e).alias(n) for n, e in rules.items()])
    return _finish(rows, "users")


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "row_index": """CASE part WHEN 'base' THEN p_partkey * 2 WHEN 'second' THEN p_partkey * 2 + 1
                                  ELSE 1000000000 + p_partkey END""",
        "product_id": "CASE WHEN part <> 'lost' THEN p_partkey END",
        "product_name": "CASE WHEN part = 'second' THEN concat(p_name, ' v2') ELSE p_name END",
        "category": "p_type",
        "price": """CASE WHEN part = 'base' AND p_partkey % 10 = 6 THEN NULL
                         WHEN part = 'second' THEN p_retailprice * 2 ELSE p_retailprice END""",
    }
    keyed = _read(spark, sf_dir, "part").withColumns(
        {"_second": F.expr("p_partkey % 50 = 0"), "_lost": F.expr("p_partkey % 100 = 50")}
    )
    rows = _copies(keyed, "_second").select(*[F.expr(e).alias(n) for n, e in rules.items()])
    return _finish(rows, "products")


RAW_FRAMES = {"users": raw_users, "products": raw_products, "weblogs": raw_weblogs}


def order_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six times as many logs, from order lines: for load tests."""
    lines = _read(spark, sf_dir, "lineitem").select("*", F.col("_metadata.row_index").alias("at"))
    lines = lines.join(
        _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    rules = {
        "row_index": "at",
        "log_id": "l_orderkey * 10 + l_linenumber",
        "user_id": "o_custkey",
        "product_id": "l_partkey",
        "session_id": "concat('sess_', l_orderkey)",
        "action": "CASE l_returnflag WHEN 'A' THEN 'view' WHEN 'N' THEN 'purchase' ELSE 'add_to_cart' END",
        "timestamp": "cast(l_shipdate AS string)",
    }
    return _finish(lines.select(*[F.expr(e).alias(n) for n, e in rules.items()]), "weblogs")
