"""Dimension upsert and load guards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators.keys import dense_numbers

CHANGE = "_change"


def newest_per_key(source: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one of the newest ``version``."""
    window = Window.partitionBy(key).orderBy(F.col(version).desc())
    return source.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def next_key(target: DataFrame, sk: str) -> int:
    return int(target.agg(F.max(sk)).first()[0] or 0) + 1


def upsert(
    target: DataFrame,
    source: DataFrame,
    *,
    key: str,
    sk: str,
    refresh: list[str],
    insert: list[str],
    ctx: RunContext,
) -> DataFrame:
    """New version of ``target`` plus the column ``_change`` (insert, update or keep).

    A match refreshes ``refresh`` (and ``dw_updated_at``, where the table has it); all else of the
    row stays.  New ids take ``insert`` and the next surrogate keys, in id order.
    """
    touched = "dw_updated_at" in target.columns
    incoming = source.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in refresh]
    )
    hit = F.col("_hit").isNotNull()
    merged = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in refresh}
    if touched:
        merged["dw_updated_at"] = F.when(hit, ctx.ts_col()).otherwise(F.col("dw_updated_at"))
    merged[CHANGE] = F.when(hit, F.lit("update")).otherwise(F.lit("keep"))
    kept = target.join(incoming, key, "left").withColumns(merged)
    kept = kept.select(*target.columns, CHANGE)

    fresh = source.join(target.select(key), key, "left_anti").select(*insert)
    fresh = dense_numbers(fresh, [key], sk, next_key(target, sk))
    stamps = {c: ctx.ts_col() for c in ("dw_created_at", "dw_updated_at") if c in target.columns}
    fresh = fresh.withColumns({**stamps, CHANGE: F.lit("insert")})
    return kept.unionByName(fresh.select(*target.columns, CHANGE))
