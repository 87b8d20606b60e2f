"""Silver to Gold: the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators.joins import already_in, lookup
from rillflow.operators.keys import sparse_number
from rillflow.operators.upsert import newest_per_key, next_key, upsert
from rillflow.schemas import FACT, PRODUCT_DAILY


def user_dimension(target: DataFrame, silver_users: DataFrame, ctx: RunContext) -> DataFrame:
    """``signup_date`` is set on insert only."""
    return upsert(
        target,
        newest_per_key(silver_users, "user_id", "etl_run_date"),
        key="user_id",
        sk="user_sk",
        refresh=["user_name", "email"],
        insert=["user_id", "user_name", "email", "signup_date"],
        ctx=ctx,
    )


def product_dimension(target: DataFrame, silver_products: DataFrame, ctx: RunContext) -> DataFrame:
    columns = ["product_name", "category", "price"]
    return upsert(
        target,
        newest_per_key(silver_products, "product_id", "etl_run_date"),
        key="product_id",
        sk="product_sk",
        refresh=columns,
        insert=["product_id", *columns],
        ctx=ctx,
    )


def fact_rows(
    silver: DataFrame,
    dim_user: DataFrame,
    dim_product: DataFrame,
    loaded: DataFrame | None = None,
    *,
    users_fit: bool | None = None,
    products_fit: bool | None = None,
    how: str = "inner",
) -> DataFrame:
    """Fact rows without ``activity_id``; log ids in ``loaded`` are left out.

    A NULL log id never counts as loaded.  ``how="left"`` keeps rows without dimension match,
    for the checks on broken keys.
    """
    scan = silver
    rows = silver.select(
        "row_index", "log_id", "user_id", "product_id", "session_id", "action", "action_ts",
        "etl_run_id", "etl_run_date",
    )
    if loaded is not None:
        done = already_in(loaded, scan, "log_id")
        rows = lookup(rows, done, "log_id", "left_anti", count_on=scan)
    users = dim_user.select("user_id", "user_sk")
    products = dim_product.select("product_id", "product_sk")
    rows = lookup(rows, users, "user_id", how, small_fits=users_fit, count_on=scan)
    rows = lookup(rows, products, "product_id", how, small_fits=products_fit, count_on=scan)
    return rows.select(*[c for c in FACT.names if c != "activity_id"])


def number_facts(rows: DataFrame, fact: DataFrame) -> DataFrame:
    return rows.withColumn("activity_id", sparse_number(next_key(fact, "activity_id")))


def product_daily_stats(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("product_sk", "etl_run_date")
        .agg(
            F.count_if(F.col("action") == "view").alias("views"),
            F.count_if(F.col("action") == "purchase").alias("purchases"),
        )
        .select(*PRODUCT_DAILY.names)
    )
