"""Audit rows, rule outcomes and the quality report, all from one small metrics frame.

The metrics frame has ``kind, layer, name, detail, value`` and a few rows per run.  Kinds:
extracted, quarantined, reason, path, loaded, anomaly, observation, check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.schemas import AUDIT, METRICS, QUARANTINE_RATE_LIMIT, REPORT

LAYERS = ["bronze", "silver", "gold"]


def metric_rows(
    df: DataFrame, kind: str, name: Column, value: Column, *, layer: str | None = None,
    detail: Column | None = None,
) -> DataFrame:
    text = F.lit(None).cast("string")
    return df.select(
        F.lit(kind).alias("kind"),
        (F.lit(layer) if layer else text).alias("layer"),
        name.cast("string").alias("name"),
        (text if detail is None else detail).alias("detail"),
        value.cast("double").alias("value"),
    )


def metrics_frame(spark, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, METRICS)


def combine(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _total(kind: str, *more: Column) -> Column:
    holds = reduce(lambda a, b: a & b, more, F.col("kind") == kind)
    return F.coalesce(F.sum(F.when(holds, F.col("value"))), F.lit(0.0))


def audit_rows(
    metrics: DataFrame,
    ctx: RunContext,
    *,
    source_file: str,
    status: str,
    error: str | None = None,
    first_id: int = 1,
) -> DataFrame:
    """One row per layer; what was read and rejected belongs to bronze."""
    paths = F.array_join(
        F.sort_array(F.collect_set(F.when(F.col("kind") == "path", F.col("detail")))), ";"
    )
    sums = metrics.agg(
        _total("extracted").alias("extracted"),
        _total("quarantined").alias("quarantined"),
        paths.alias("paths"),
        *[_total("loaded", F.col("layer") == layer).alias(layer) for layer in LAYERS],
    )
    zero = F.lit(0.0)
    rows = F.array(
        *[
            F.struct(
                F.lit(first_id + i).cast("bigint").alias("audit_id"),
                F.lit(layer).alias("layer"),
                (F.col("extracted") if i == 0 else zero).cast("bigint").alias("rows_extracted"),
                (F.col("quarantined") if i == 0 else zero).cast("bigint").alias("rows_quarantined"),
                F.col(layer).cast("bigint").alias("rows_loaded"),
                (F.col("paths") if i == 0 else F.lit("")).alias("quarantine_path"),
            )
            for i, layer in enumerate(LAYERS)
        ]
    )
    return (
        sums.select(F.inline(rows))
        .withColumns(
            {
                "etl_run_id": ctx.id_col(),
                "etl_run_date": ctx.date_col(),
                "etl_run_timestamp": ctx.ts_col(),
                "source_file": F.lit(source_file),
                "status": F.lit(status),
                "error_message": F.lit(error).cast("string"),
                "created_at": ctx.ts_col(),
            }
        )
        .select(*AUDIT.names)
    )


def recommendations(metrics: DataFrame, status: str = "SUCCESS") -> DataFrame:
    """``rule, observed, threshold, triggered``; every rule is triggered above its threshold."""
    anomaly = lambda name: _total("anomaly", F.col("name") == name)
    rate = F.coalesce(
        F.try_divide(_total("quarantined"), _total("extracted")), F.lit(0.0)
    )
    rules = [
        ("quarantine_rate", rate, QUARANTINE_RATE_LIMIT),
        ("abandoned_cart_sessions", anomaly("abandoned_cart"), 0.0),
        ("long_sessions", anomaly("long_session"), 0.0),
        ("high_activity_sessions", anomaly("high_activity"), 0.0),
        ("run_failed", F.lit(1.0 if status == "FAILED" else 0.0), 0.0),
    ]
    sums = metrics.agg(*[value.alias(rule) for rule, value, _ in rules])
    rows = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.col(rule).alias("observed"),
                F.lit(limit).alias("threshold"),
                (F.col(rule) > limit).alias("triggered"),
            )
            for rule, _, limit in rules
        ]
    )
    return sums.select(F.inline(rows))


_SECTION_OF = {
    "extracted": "row_counts",
    "quarantined": "row_counts",
    "loaded": "rows_loaded",
    "reason": "quarantine_breakdown",
    "path": "quarantine_paths",
    "observation": "quality_observations",
    "anomaly": "session_anomalies",
    "check": "post_load_checks",
}


def report_rows(
    metrics: DataFrame, ctx: RunContext, status: str, error: str | None = None
) -> DataFrame:
    """``section, item, sub_item, value, rank``: the whole report as rows, ordered by rank."""
    spark = metrics.sparkSession
    kind = F.col("kind")
    section = F.coalesce(
        *[F.when(kind == k, F.lit(s)) for k, s in _SECTION_OF.items()], F.lit("other")
    )
    number = F.when(
        F.col("value") == F.floor("value"), F.col("value").cast("bigint").cast("string")
    ).otherwise(F.col("value").cast("string"))
    body = metrics.select(
        section.alias("section"),
        F.when(kind == "loaded", F.col("layer")).otherwise(F.col("name")).alias("item"),
        F.when(kind == "loaded", F.col("name"))
        .when(kind.isin("extracted", "quarantined"), kind)
        .otherwise(F.col("detail"))
        .alias("sub_item"),
        number.alias("value"),
        F.when(kind == "reason", -F.col("value")).otherwise(F.lit(0.0)).alias("_order"),
    )
    advice = recommendations(metrics, status).where("triggered").select(
        F.lit("recommendations").alias("section"),
        F.col("rule").alias("item"),
        F.lit(None).cast("string").alias("sub_item"),
        F.col("observed").cast("string").alias("value"),
        F.lit(0.0).alias("_order"),
    )
    head = spark.createDataFrame(
        [
            ("run", "status", None, status, 0.0),
            ("run", "run_timestamp", None, str(ctx.run_ts), 0.0),
            ("run", "error", None, error, 0.0),
        ],
        "section string, item string, sub_item string, value string, _order double",
    ).where("value IS NOT NULL")
    # A report has a few rows per source, dataset and rule, never one per record.
    place = Window.partitionBy("section").orderBy("_order", "item", "sub_item")
    return (
        combine([head, body, advice])
        .withColumn("rank", F.row_number().over(place))
        .withColumn("etl_run_date", ctx.date_col())
        .withColumn("etl_run_id", ctx.id_col())
        .select(*REPORT.names)
    )
