"""Session metrics at two grains, kept apart on purpose.

*Silver grain*: one row per session.  Actions are the sum of the three known ones, duration has
fractions of a second, and a session without any known action has NULL counts.

*Gold grain*: one row per session, user and load date.  Actions count every row, and duration
counts whole-second boundaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.scalars import elapsed_seconds, elapsed_whole_seconds, safe_ratio
from rillflow.operators.joins import already_in, lookup
from rillflow.schemas import AGG, HIGH_ACTIVITY_ACTIONS, LONG_SESSION_STDDEVS


def _count_of(action: str) -> Column:
    return F.count_if(F.col("action") == action)


def _bounds() -> list[Column]:
    return [F.min("action_ts").alias("session_start"), F.max("action_ts").alias("session_end")]


def abandoned_cart(cart_adds: Column, purchases: Column) -> Column:
    return F.coalesce((cart_adds > 0) & (purchases == 0), F.lit(False))


def high_activity(actions: Column, threshold: int = HIGH_ACTIVITY_ACTIONS) -> Column:
    return F.coalesce(actions > threshold, F.lit(False))


def session_bounds(logs: DataFrame) -> DataFrame:
    return (
        logs.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(*_bounds())
        .withColumn("session_duration_s", elapsed_seconds("session_start", "session_end"))
    )


def session_metrics(logs: DataFrame) -> DataFrame:
    """Silver grain, in one aggregation."""
    has_known = F.count("action") > 0
    sums = (
        logs.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            *_bounds(),
            F.when(has_known, _count_of("view")).alias("total_views"),
            F.when(has_known, _count_of("add_to_cart")).alias("total_cart_adds"),
            F.when(has_known, _count_of("purchase")).alias("total_purchases"),
        )
    )
    total = F.col("total_views") + F.col("total_cart_adds") + F.col("total_purchases")
    return sums.select(
        "session_id",
        "session_start",
        "session_end",
        elapsed_seconds("session_start", "session_end").alias("session_duration_s"),
        "total_views",
        "total_cart_adds",
        "total_purchases",
        total.alias("total_actions"),
        safe_ratio(F.col("total_purchases"), F.col("total_views")).alias("conversion_rate"),
        abandoned_cart(F.col("total_cart_adds"), F.col("total_purchases")).alias(
            "is_abandoned_cart"
        ),
        high_activity(total).alias("is_high_activity"),
    )


def gold_session_metrics(
    silver: DataFrame,
    dim_user: DataFrame,
    loaded: DataFrame | None = None,
    *,
    users_fit: bool | None = None,
) -> DataFrame:
    """Gold grain; sessions whose id is in ``loaded`` already are left out.

    The logs are summed up by ``user_id`` first: the user table maps each id to one key, and the
    load guard looks at the session alone, so both joins see session rows instead of log rows.
    """
    sums = silver.groupBy("session_id", "user_id", "etl_run_date").agg(
        *_bounds(),
        F.count(F.lit(1)).alias("total_actions"),
        _count_of("view").alias("total_views"),
        _count_of("add_to_cart").alias("total_cart_adds"),
        _count_of("purchase").alias("total_purchases"),
    )
    sums = sums.withColumn(
        "_group", F.xxhash64("session_id", "user_id", "etl_run_date")
    )
    keyed = lookup(
        sums, dim_user.select("user_id", "user_sk"), "user_id", "inner",
        row_id="_group", small_fits=users_fit, count_on=silver,
    ).where(F.col("user_sk").isNotNull())
    if loaded is not None:
        done = already_in(loaded, silver, "session_id")
        keyed = lookup(keyed, done, "session_id", "left_anti", row_id="_group", count_on=silver)
    return keyed.withColumns(
        {
            "session_duration_s": elapsed_whole_seconds("session_start", "session_end"),
            "conversion_rate": safe_ratio(F.col("total_purchases"), F.col("total_views")),
            "is_abandoned_cart": abandoned_cart(
                F.col("total_cart_adds"), F.col("total_purchases")
            ),
            "is_high_activity": high_activity(F.col("total_actions")),
        }
    ).select(*AGG.names)


def long_limit(durations: DataFrame, std_devs: float = LONG_SESSION_STDDEVS) -> DataFrame:
    """One row: mean plus ``std_devs`` sample deviations of ``session_duration_s``."""
    seconds = "session_duration_s"
    return durations.agg(
        (F.avg(seconds) + F.lit(float(std_devs)) * F.stddev_samp(seconds)).alias("limit_s")
    )


def flag_long(sessions: DataFrame, std_devs: float = LONG_SESSION_STDDEVS) -> DataFrame:
    limit = long_limit(sessions, std_devs).scalar()
    return sessions.withColumn(
        "is_long_session", F.coalesce(F.col("session_duration_s") > limit, F.lit(False))
    )


def anomaly_counts(sessions: DataFrame, std_devs: float = LONG_SESSION_STDDEVS) -> DataFrame:
    """One row of flag totals over Silver-grain sessions."""
    return flag_long(sessions, std_devs).agg(
        F.count_if("is_abandoned_cart").alias("abandoned_cart"),
        F.count_if("is_high_activity").alias("high_activity"),
        F.count_if("is_long_session").alias("long_session"),
    )
