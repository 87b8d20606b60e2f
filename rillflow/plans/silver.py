"""Bronze to Silver: typed, normalised, enriched logs and the dimension snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.functions.scalars import known_action, parse_timestamp
from rillflow.operators.joins import lookup
from rillflow.schemas import SILVER
from rillflow.session import pin, reducers


def to_silver(bronze: DataFrame, ctx: RunContext) -> DataFrame:
    return bronze.withColumns(
        {
            "action_ts": parse_timestamp(F.col("timestamp")),
            "action": known_action(F.col("action")),
            "etl_run_id": ctx.id_col(),
            "etl_run_date": ctx.date_col(),
        }
    )


def enrich(
    logs: DataFrame,
    users: DataFrame,
    products: DataFrame,
    *,
    users_fit: bool | None = None,
    products_fit: bool | None = None,
) -> DataFrame:
    """Left joins: a log without product keeps NULL product columns."""
    who = users.select("user_id", "user_name", "email")
    what = products.select("product_id", "product_name", "category", "price")
    out = lookup(logs, who, "user_id", small_fits=users_fit, count_on=logs)
    out = lookup(out, what, "product_id", small_fits=products_fit, count_on=logs)
    return out.select(*SILVER["weblogs_clean"].names)


_SESSION_ORDER = ["session_id", "action_ts", "row_index"]


def in_session_order(logs: DataFrame) -> DataFrame:
    """Sorted by session and time over range partitions, so a long session spans several."""
    return logs.repartitionByRange(*_SESSION_ORDER).sortWithinPartitions(*_SESSION_ORDER)


def ordered(logs: DataFrame, users: DataFrame, products: DataFrame, *, users_fit: bool, products_fit: bool) -> DataFrame:
    """Enriched logs in session order, with the joins run once.

    Range partitioning takes a sample of what is below it.  Broadcast joins leave the logs where they
    are, so these are dealt into ranges first, and the sample reads three columns of Bronze; they are
    sorted after the joins, below which Spark drops a sort.  Rows of shuffled joins are written before
    they are put in order, and the sample reads that.
    """
    fits = {"users_fit": users_fit, "products_fit": products_fit}
    if not (users_fit and products_fit):
        return in_session_order(pin(enrich(logs, users, products, **fits)))
    # with their number given, the ranges are not dealt anew below the joins
    ranges = logs.repartitionByRange(reducers(logs.sparkSession), *_SESSION_ORDER)
    return enrich(ranges, users, products, **fits).sortWithinPartitions(*_SESSION_ORDER)


def snapshot(clean: DataFrame, dataset: str, ctx: RunContext) -> DataFrame:
    return clean.withColumn("etl_run_date", ctx.date_col()).select(*SILVER[dataset].names)
