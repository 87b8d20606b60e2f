"""Post-load checks of the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_users(fact: DataFrame, dim_user: DataFrame) -> DataFrame:
    """Facts with a NULL user key or one the dimension lacks.

    Both questions are about the key alone, so the facts are counted per key before the join.
    """
    per_key = fact.groupBy("user_sk").agg(F.count(F.lit(1)).alias("_rows"))
    lost = per_key.join(dim_user.select("user_sk"), "user_sk", "left_anti")
    return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_users"))


def duplicate_log_ids(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy("log_id").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.where(F.col("cnt") > 1)


def negative_durations(agg: DataFrame) -> DataFrame:
    return agg.where(F.col("session_duration_s") < 0).agg(
        F.count(F.lit(1)).alias("invalid_duration_count")
    )


def null_keys(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_if(F.col("user_sk").isNull()).alias("null_user_sk"),
        F.count_if(F.col("product_sk").isNull()).alias("null_product_sk"),
    )


def run_checks(fact: DataFrame, agg: DataFrame, dim_user: DataFrame) -> DataFrame:
    """``check_name, violations, passed`` of all four checks."""
    keys = null_keys(fact).select((F.col("null_user_sk") + F.col("null_product_sk")).alias("n"))
    results = [
        ("orphan_user_sk_check", orphan_users(fact, dim_user).toDF("n")),
        ("duplicate_log_id_check", duplicate_log_ids(fact).agg(F.count(F.lit(1)).alias("n"))),
        ("negative_session_duration_check", negative_durations(agg).toDF("n")),
        ("null_sk_check", keys),
    ]
    rows = [
        df.select(
            F.lit(name).alias("check_name"),
            F.col("n").cast("bigint").alias("violations"),
            (F.col("n") == 0).alias("passed"),
        )
        for name, df in results
    ]
    return reduce(DataFrame.unionByName, rows)
