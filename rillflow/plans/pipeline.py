"""One full run: raw sources to Bronze, Silver, Gold, checks, audit log and report."""

from __future__ import annotations

import logging
from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators.joins import fits_broadcast, pairs_fit, total_bytes, within_limit
from rillflow.operators.quality import (
    REASONS,
    classify,
    clean,
    quality_observations,
    quarantine,
)
from rillflow.operators.sessions import anomaly_counts, gold_session_metrics, session_metrics
from rillflow.operators.upsert import next_key
from rillflow.plans import gold, report
from rillflow.plans.checks import run_checks
from rillflow.plans.silver import ordered, snapshot, to_silver
from rillflow.schemas import BRONZE, RAW_COLUMNS
from rillflow.session import together
from rillflow.sources.lake import Lake
from rillflow.sources.tables import land

log = logging.getLogger(__name__)

Rows = list[tuple]


def ingest(
    lake: Lake, ctx: RunContext, raw: dict[str, DataFrame], paths: dict[str, str], rows: Rows
) -> dict[str, bool]:
    """Classify and write every source; the dimensions first, as the logs refer to them.

    Returns which of the dimensions are small enough to be broadcast whole.
    """
    sizes = together(
        *[
            partial(ingest_source, lake, ctx, source, raw[source], paths[source], rows, {})
            for source in ("users", "products")
        ]
    )
    refs = {
        "users": lake.read_bronze("users", ctx, own=True),
        "products": lake.read_bronze("products", ctx, own=True),
        "users_fit": pairs_fit(sizes[0]["rows"]),
        "products_fit": pairs_fit(sizes[1]["rows"]),
    }
    ingest_source(lake, ctx, "weblogs", raw["weblogs"], paths["weblogs"], rows, refs)
    return {
        "users_fit": within_limit(sizes[0]["bytes"]),
        "products_fit": within_limit(sizes[1]["bytes"]),
    }


def ingest_source(
    lake: Lake, ctx: RunContext, source: str, raw: DataFrame, path: str, rows: Rows, refs: dict
) -> dict[str, int]:
    """Write one source and return the rows and bytes kept."""
    # Two outputs from one pass: both writes read the classified rows from disk.
    judged = classify(raw, source, **refs).persist(StorageLevel.DISK_ONLY)
    try:
        size = {"bytes": total_bytes(BRONZE[source])}
        kept = lake.write_bronze(clean(judged, source), source, ctx, counts=size)
        records = quarantine(judged, source, path, ctx)
        rejected = lake.write_quarantine(records, source, ctx, counts=reason_totals(source))
    finally:
        judged.unpersist()
    note_source(rows, lake, ctx, source, kept["rows"], rejected)
    return kept


def reason_totals(source: str) -> dict[str, Column]:
    return {r: F.count_if(F.col("rejection_reason") == r) for r in REASONS[source]}


def note_source(rows: Rows, lake: Lake, ctx, source: str, kept: int, rejected: dict) -> None:
    if kept:
        rows.append(("loaded", "bronze", source, None, float(kept)))
    if rejected["rows"]:
        rows.append(("quarantined", None, source, None, float(rejected["rows"])))
        rows.append(("path", None, source, lake.quarantine_path(source, ctx), None))
    for reason in REASONS[source]:
        if rejected[reason]:
            rows.append(("reason", None, source, reason, float(rejected[reason])))


def build_silver(lake: Lake, ctx: RunContext, rows: Rows, **fits: bool) -> None:
    users, products, logs = (lake.read_bronze(s, ctx, own=True) for s in ("users", "products", "weblogs"))
    logs = to_silver(logs, ctx)

    def note(dataset: str, written: int) -> None:
        if written:
            rows.append(("loaded", "silver", dataset, None, float(written)))

    def write(dataset: str, df: DataFrame) -> None:
        note(dataset, lake.write_silver(df, dataset, ctx)["rows"])

    def write_all_logs() -> None:
        note("weblogs_clean", write_logs(lake, ctx, ordered(logs, users, products, **fits)))

    together(
        write_all_logs,
        lambda: write("users_clean", snapshot(users, "users_clean", ctx)),
        lambda: write("products_clean", snapshot(products, "products_clean", ctx)),
    )


def write_logs(lake: Lake, ctx: RunContext, logs: DataFrame) -> int:
    """Write the Silver logs of a run, then list the run, told from others by what its logs are."""
    cells = F.xxhash64("log_id", "user_id", "product_id", "session_id", "action", "timestamp", "row_index")
    sums = {f"sum{k}": F.sum(F.pmod(F.shiftright(cells, 32 * k), F.lit(1 << 31))) for k in (0, 1)}
    n = lake.write_silver(logs, "weblogs_clean", ctx, counts=sums)
    if n["rows"]:
        content = ":".join(str(n[k]) for k in ("rows", "sum0", "sum1"))
        lake.note_run("silver", ctx.run_id, ctx.run_date, ctx.run_ts, content)
    return n["rows"]


def note_anomalies(lake: Lake, ctx: RunContext, rows: Rows) -> None:
    counts = anomaly_counts(session_metrics(current_logs(lake, ctx))).first().asDict()
    rows += [("anomaly", None, kind, None, float(n)) for kind, n in counts.items()]


def note_observations(lake: Lake, ctx: RunContext, raw: dict[str, DataFrame], rows: Rows) -> None:
    users = lake.read_bronze("users", ctx, own=True)
    observed = quality_observations(raw["users"], users, raw["products"], raw["weblogs"])
    rows += [("observation", None, r.observation, None, r.rate) for r in observed.collect()]


def current_logs(lake: Lake, ctx: RunContext) -> DataFrame:
    return logs_of(lake, ctx.run_id, ctx.run_date)


def logs_of(lake: Lake, run_id: str, run_date: date) -> DataFrame:
    mine = (F.col("etl_run_date") == F.lit(run_date)) & (F.col("etl_run_id") == run_id)
    return lake.read_silver("weblogs_clean").where(mine)


def load_runs(
    lake: Lake, table: str, build: Callable[[DataFrame], DataFrame], sort: list[str],
    only: str | None = None,
) -> int:
    """Load the logs of every pending run (or of that one), one run after the other.

    A run is listed as loaded once its rows are written, and each one is guarded by what Gold has
    by then: a retry, or a later run of the same logs, adds nothing.
    """
    n = 0
    for r in lake.pending_runs(table):
        if only in (None, r.etl_run_id):
            new = build(logs_of(lake, r.etl_run_id, r.etl_run_date))
            n += lake.append_gold(new, table, sort=sort)["rows"]
            lake.note_run(table, r.etl_run_id, r.etl_run_date, r.run_ts, r.content)
    return n


def load_facts(lake: Lake, only: str | None = None, **fits: bool) -> int:
    users, products = lake.read_dim("dim_user"), lake.read_dim("dim_product")

    def build(logs: DataFrame) -> DataFrame:
        fact = lake.read_gold("fact_user_activity")
        return gold.number_facts(gold.fact_rows(logs, users, products, fact, **fits), fact)

    return load_runs(lake, "fact_user_activity", build, ["action"], only)


def load_sessions(lake: Lake, only: str | None = None, **fits: bool) -> int:
    users = lake.read_dim("dim_user")

    def build(logs: DataFrame) -> DataFrame:
        return gold_session_metrics(logs, users, lake.read_gold("agg_session_metrics"), **fits)

    return load_runs(lake, "agg_session_metrics", build, ["session_id"], only)


def build_gold(lake: Lake, ctx: RunContext, rows: Rows, scope: str = "all") -> None:
    """Dimensions, then facts and sessions, which need the surrogate keys.

    ``scope="all"`` loads the logs of every run that Gold does not have, so it also catches up on
    runs that never got here; ``scope="run"`` loads this run's alone.
    """
    if scope not in ("all", "run"):
        raise ValueError(f"Unknown scope: {scope!r}")
    changes = {
        "inserted": F.count_if(F.col("_change") == "insert"),
        "updated": F.count_if(F.col("_change") == "update"),
    }

    def note(name: str, loaded: int) -> None:
        rows.append(("loaded", "gold", name, None, float(loaded)))

    def dimension(name: str, build, dataset: str) -> int:
        source = lake.read_silver(dataset)
        if scope == "run":
            source = source.where(F.col("etl_run_date") == ctx.date_col())
        new = build(lake.read_dim(name), source, ctx)
        n = lake.write_dim(new, name, ctx, counts=changes)
        note(name, n["inserted"] + n["updated"])
        return n["rows"]

    n_users, n_products, _ = together(
        partial(dimension, "dim_user", gold.user_dimension, "users_clean"),
        partial(dimension, "dim_product", gold.product_dimension, "products_clean"),
        partial(note_anomalies, lake, ctx, rows),
    )
    users_fit, products_fit = pairs_fit(n_users), pairs_fit(n_products)
    only = ctx.run_id if scope == "run" else None
    together(
        lambda: note(
            "fact_user_activity", load_facts(lake, only, users_fit=users_fit, products_fit=products_fit)
        ),
        lambda: note("agg_session_metrics", load_sessions(lake, only, users_fit=users_fit)),
    )


def rebuild_sessions(lake: Lake) -> int:
    """Sum up all Silver logs again, those of repeated runs once.

    Unlike a load this takes late logs of known sessions in.
    """
    runs = lake.silver_runs().select("etl_run_id", "etl_run_date")  # a row per run
    logs = lake.read_silver("weblogs_clean")
    logs = logs.join(F.broadcast(runs) if fits_broadcast(runs) else runs, ["etl_run_id", "etl_run_date"], "left_semi")
    rows = gold_session_metrics(logs, lake.read_dim("dim_user"))
    return lake.overwrite_gold(rows, "agg_session_metrics", sort=["session_id"])["rows"]


def refresh_product_days(lake: Lake, ctx: RunContext) -> None:
    today = lake.read_gold("fact_user_activity").where(F.col("etl_run_date") == ctx.date_col())
    lake.replace_gold_day(gold.product_daily_stats(today), "product_daily_stats", ctx)


def validate_gold(lake: Lake, rows: Rows) -> None:
    results = run_checks(
        lake.read_gold("fact_user_activity"),
        lake.read_gold("agg_session_metrics"),
        lake.read_dim("dim_user"),
    ).collect()  # four rows
    for r in results:
        state = "passed" if r.passed else "failed"
        rows.append(("check", None, r.check_name, state, float(r.violations)))
        if r.check_name == "null_sk_check":
            rows.append(("anomaly", None, "null_sk_in_fact", None, float(r.violations)))
            if r.violations:
                log.warning("%d NULL surrogate keys in the fact table", r.violations)


def run(
    lake: Lake,
    paths: dict[str, str],
    ctx: RunContext | None = None,
    *,
    fmt: str = "csv",
    scope: str = "all",
) -> DataFrame:
    """Run everything and return the report rows; ``paths`` maps each source to its files.

    Bad rows never stop a run.  A failing phase does: it is recorded as FAILED and raised again.
    """
    ctx = ctx or RunContext.new()
    spark = lake.spark
    rows: Rows = []
    status, error = "RUNNING", None
    try:
        landed = together(
            *[
                partial(
                    land, spark, paths[source], columns, fmt=fmt,
                    staging=lake.path("landing", source, etl_run_id=ctx.run_id),
                )
                for source, columns in RAW_COLUMNS.items()
            ]
        )
        raw = {source: df for source, (df, _) in zip(RAW_COLUMNS, landed)}
        rows += [("extracted", None, s, None, float(n)) for s, (_, n) in zip(raw, landed)]
        fits = ingest(lake, ctx, raw, paths, rows)
        together(
            partial(build_silver, lake, ctx, rows, **fits),
            partial(note_observations, lake, ctx, raw, rows),
        )
        build_gold(lake, ctx, rows, scope)
        together(partial(refresh_product_days, lake, ctx), partial(validate_gold, lake, rows))
        status = "SUCCESS"
    except Exception as exc:
        status, error = "FAILED", str(exc)
        raise
    finally:
        result = finish(lake, ctx, rows, paths["weblogs"], status, error)
    return result


def finish(
    lake: Lake, ctx: RunContext, rows: Rows, source_file: str, status: str, error: str | None
) -> DataFrame | None:
    """Audit log and report; trouble here is logged and never hides the outcome of the run."""
    try:
        metrics = report.metrics_frame(lake.spark, rows)
        audit = report.audit_rows(
            metrics, ctx, source_file=source_file, status=status, error=error,
            first_id=next_key(lake.read_gold("etl_audit_log"), "audit_id"),
        )
        together(
            lambda: lake.append_audit(audit),
            lambda: lake.write_report(report.report_rows(metrics, ctx, status, error), ctx),
        )
        return lake.read_report(ctx)
    except Exception:
        log.exception("writing the audit log or the report failed")
        return None
