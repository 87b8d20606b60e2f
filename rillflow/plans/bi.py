"""The ten business questions on the Gold tables.

Facts are summed up by surrogate key before a dimension joins in: one popular product or user
is then one row at the join.  Equal totals are ordered by name, so top lists are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.functions.scalars import safe_ratio
from rillflow.operators.sessions import long_limit
from rillflow.schemas import LONG_SESSION_STDDEVS
from rillflow.sources.lake import Lake


def most_viewed_products(fact: DataFrame, dim_product: DataFrame, top: int = 20) -> DataFrame:
    views = (
        fact.where(F.col("action") == "view")
        .groupBy("product_sk")
        .agg(F.count(F.lit(1)).alias("_views"))
    )
    named = views.join(dim_product.select("product_sk", "product_name"), "product_sk")
    return (
        named.groupBy("product_name")
        .agg(F.sum("_views").alias("view_count"))
        .orderBy(F.desc("view_count"), F.asc("product_name"))
        .limit(top)
    )


def overall_conversion_rate(agg: DataFrame) -> DataFrame:
    """A session counts once however many users share it."""
    per_session = (
        agg.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.max(F.when(F.col("total_purchases") > 0, 1).otherwise(0)).alias("_buys"))
    )
    return per_session.agg(
        safe_ratio(F.coalesce(F.sum("_buys"), F.lit(0)), F.count(F.lit(1))).alias(
            "overall_conversion_rate"
        )
    )


def average_session_minutes(agg: DataFrame) -> DataFrame:
    kept = agg.where(F.col("session_duration_s") >= 0)
    return kept.agg((F.avg("session_duration_s") / 60).alias("avg_duration_minutes"))


def _purchases_by_user(agg: DataFrame) -> DataFrame:
    return agg.groupBy("user_sk").agg(F.sum("total_purchases").alias("_purchases"))


def top_users(agg: DataFrame, dim_user: DataFrame, top: int = 10) -> DataFrame:
    named = _purchases_by_user(agg).join(dim_user.select("user_sk", "user_name"), "user_sk")
    return (
        named.groupBy("user_name")
        .agg(F.sum("_purchases").alias("total_purchases"))
        .orderBy(F.desc("total_purchases"), F.asc("user_name"))
        .limit(top)
    )


def abandoned_rate_by_load_date(agg: DataFrame) -> DataFrame:
    return (
        agg.groupBy("etl_run_date")
        .agg(
            safe_ratio(F.count_if("is_abandoned_cart"), F.count(F.lit(1))).alias(
                "abandoned_cart_rate"
            )
        )
        .orderBy("etl_run_date")
    )


def product_conversion(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_key = fact.groupBy("product_sk").agg(
        F.count_if(F.col("action") == "purchase").alias("_buys"),
        F.count_if(F.col("action") == "view").alias("_views"),
    )
    named = per_key.join(dim_product.select("product_sk", "product_name"), "product_sk")
    return (
        named.groupBy("product_name")
        .agg(safe_ratio(F.sum("_buys"), F.sum("_views")).alias("product_cvr"))
        .orderBy(F.desc_nulls_last("product_cvr"), F.asc("product_name"))
    )


def average_actions(agg: DataFrame) -> DataFrame:
    return agg.agg(F.avg("total_actions").alias("avg_actions_per_session"))


def activity_by_hour(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.hour("action_ts").cast("bigint").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("action_count"))
        .orderBy("hour_of_day")
    )


def long_sessions(agg: DataFrame) -> DataFrame:
    limit = long_limit(agg).scalar()
    return agg.where(F.col("session_duration_s") > limit).select("session_id", "session_duration_s")


def long_sessions_running(lake: Lake, std_devs: float = LONG_SESSION_STDDEVS) -> DataFrame:
    """The same from the moments that the loads noted: one pass, which the limit prunes."""
    agg = lake.read_gold("agg_session_metrics")
    limit = lake.gold_moments("agg_session_metrics").limit(std_devs)
    longer = F.col("session_duration_s") > F.lit(limit).cast("double")
    return agg.where(longer).select("session_id", "session_duration_s")


def signup_cohorts(agg: DataFrame, dim_user: DataFrame) -> DataFrame:
    """After the sum each user is one row, so the row count is the number of active users."""
    dated = _purchases_by_user(agg).join(dim_user.select("user_sk", "signup_date"), "user_sk")
    return (
        dated.groupBy(F.trunc("signup_date", "month").alias("signup_cohort"))
        .agg(
            F.sum("_purchases").alias("total_purchases"),
            F.count("user_sk").alias("active_users"),
        )
        .orderBy("signup_cohort")
    )
