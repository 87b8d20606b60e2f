"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry.frames import RUN_1, RUN_2, Frames
from rillflow.functions import scalars
from rillflow.operators import dedupe, formats, quality, sessions
from rillflow.plans import bi, checks, gold, pipeline, report, silver
from rillflow.schemas import BRONZE, DIM_PRODUCT, DIM_USER, RAW_COLUMNS, SILVER, table
from rillflow.session import fresh_folder, pin
from rillflow.sources.lake import Lake
from rillflow.sources.tables import CSV_OPTIONS, land, load_by_name, project, typed_scan
from rillflow.streaming import ingest as stream_ingest
from rillflow.streaming import sessions as stream_sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Frames(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, as the order of a sum may change the last ones."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# classification ---------------------------------------------------------------------------
@query
def users_classified(f: Frames) -> DataFrame:
    return f.users_classified.select("row_index", "user_id", "rejection_reason")


@query
def users_clean(f: Frames) -> DataFrame:
    return quality.clean(f.users_classified, "users")


@query
def products_classified(f: Frames) -> DataFrame:
    return f.products_classified.select("row_index", "product_id", "rejection_reason")


@query
def products_clean(f: Frames) -> DataFrame:
    return quality.clean(f.products_classified, "products")


@query
def weblogs_classified(f: Frames) -> DataFrame:
    return f.weblogs_classified.select("row_index", "log_id", "rejection_reason")


@query
def weblogs_clean(f: Frames) -> DataFrame:
    return quality.clean(f.weblogs_classified, "weblogs")


@query
def valid_id_sets(f: Frames) -> DataFrame:
    users = f.users.select(F.lit("users").alias("source"), F.col("user_id").alias("id"))
    products = f.products.select(F.lit("products").alias("source"), F.col("product_id").alias("id"))
    return users.distinct().unionByName(products.distinct())


def _records(f: Frames, source: str) -> DataFrame:
    judged = getattr(f, f"{source}_classified")
    return quality.quarantine(judged, source, f"raw/{source}", RUN_1)


@query
def quarantine_weblogs(f: Frames) -> DataFrame:
    return _records(f, "weblogs").drop("raw_row")


@query
def quarantine_users(f: Frames) -> DataFrame:
    return _records(f, "users").drop("raw_row")


@query
def quarantine_products(f: Frames) -> DataFrame:
    return _records(f, "products").drop("raw_row")


@query
def quarantine_raw_json(f: Frames) -> DataFrame:
    fields = [
        F.get_json_object("raw_row", f"$.{c}").alias(f"raw_{c}")
        for c in ("log_id", "user_id", "product_id", "session_id", "action")
    ]
    return _records(f, "weblogs").select("row_index", *fields)


@query
def rejection_reason_counts(f: Frames) -> DataFrame:
    return report.combine(
        [
            quality.reason_counts(getattr(f, f"{s}_classified"), s)
            for s in ("users", "products", "weblogs")
        ]
    )


@query
def conservation(f: Frames) -> DataFrame:
    """Extracted, kept and rejected rows per source; older versions of a dimension row are neither."""
    frames = []
    for source in ("users", "products", "weblogs"):
        reason = F.col("rejection_reason")
        judged = getattr(f, f"{source}_classified").agg(
            F.count_if(reason.isNull()).alias("kept"),
            F.count_if(reason.isNotNull()).alias("rejected"),
        )
        extracted = f.raw(source).agg(F.count(F.lit(1)).alias("n"))
        frames.append(
            judged.select(
                F.lit(source).alias("source"), extracted.scalar().alias("extracted"), "kept",
                "rejected",
            )
        )
    return report.combine(frames)


# duplicates -------------------------------------------------------------------------------
def _typed_logs(f: Frames) -> DataFrame:
    return project(f.raw("weblogs"), BRONZE["weblogs"])


@query
def find_duplicates(f: Frames) -> DataFrame:
    logs = _typed_logs(f).select("row_index", "log_id")
    return dedupe.flag_repeats(logs, "log_id", "is_duplicate")


@query
def find_duplicates_seen(f: Frames) -> DataFrame:
    """Logs against ids that an earlier load, here the order lines, has brought in."""
    seen = f.table("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("log_id")
    )
    logs = _typed_logs(f).select("row_index", "log_id")
    return dedupe.flag_repeats(logs, "log_id", "is_duplicate", seen=seen)


@query
def dedupe_keep_first(f: Frames) -> DataFrame:
    logs = _typed_logs(f).select("row_index", "user_id", "session_id")
    return dedupe.keep_first(logs, ["user_id", "session_id"])


@query
def dedupe_keep_latest(f: Frames) -> DataFrame:
    typed = f.raw("users").withColumn("user_id", scalars.to_id(F.col("user_id")))
    return dedupe.keep_latest(typed, "user_id").select("row_index", "user_id", "user_name")


# scalar rules -----------------------------------------------------------------------------
@query
def schema_required_mask(f: Frames) -> DataFrame:
    required = ["log_id", "user_id", "product_id", "session_id"]
    return quality.required_mask(f.raw("weblogs"), required).select("row_index", "is_complete")


@query
def parse_timestamp(f: Frames) -> DataFrame:
    text = F.col("timestamp")
    return f.raw("weblogs").select("row_index", scalars.parse_timestamp(text).alias("action_ts"))


def _zoned_times(f: Frames) -> DataFrame:
    """Log times in six forms: plain, with T, and with four ways to write a zone."""
    form = """CASE event_id DIV 500 % 7 WHEN 6 THEN event_id % 6 ELSE event_id DIV 500 % 6 END"""
    times = f.table("events").select(
        F.col("event_id").alias("row_index"),
        F.expr(form).alias("form"),
        F.expr("date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')").alias("plain"),
    )
    t = "translate(plain, ' ', 'T')"
    text = F.expr(
        f"""CASE form WHEN 0 THEN plain WHEN 1 THEN {t} WHEN 2 THEN concat({t}, 'Z')
            WHEN 3 THEN concat(plain, '+02:00') WHEN 4 THEN concat({t}, '-0530') ELSE substr(plain, 1, 10) END"""
    )
    return times.select("row_index", F.when(F.col("row_index") % 11 != 3, text).otherwise("no time").alias("text"))


@query
def parse_timestamp_utc(f: Frames) -> DataFrame:
    """Texts with a zone as times in UTC."""
    return _zoned_times(f).select("row_index", scalars.parse_timestamp(F.col("text"), "utc").alias("ts"))


@query
def parse_timestamp_by_chunk(f: Frames) -> DataFrame:
    """Each 500 rows by the format of their first value."""
    rows = formats.parse_by_first_format(_zoned_times(f), "text", "ts", chunk_rows=500, zone="utc")
    return rows.select("row_index", "ts")


@query
def valid_email(f: Frames) -> DataFrame:
    return f.raw("users").select("row_index", scalars.valid_email(F.col("email")).alias("is_valid"))


@query
def valid_session(f: Frames) -> DataFrame:
    text = F.col("session_id")
    return f.raw("weblogs").select("row_index", scalars.valid_session(text).alias("is_valid"))


@query
def categorize_action(f: Frames) -> DataFrame:
    return f.raw("weblogs").select("row_index", scalars.known_action(F.col("action")).alias("action"))


@query
def numeric_coercion(f: Frames) -> DataFrame:
    """Ids from the session text (mostly no number) and from the product id."""
    tail = F.regexp_replace("session_id", "^sess_", "")
    return f.raw("weblogs").select(
        "row_index",
        scalars.to_id(tail).alias("session_number"),
        scalars.to_double(F.col("product_id")).alias("product_number"),
    )


# silver -----------------------------------------------------------------------------------
@query
def silver_weblogs(f: Frames) -> DataFrame:
    return silver.in_session_order(f.silver)


@query
def silver_users(f: Frames) -> DataFrame:
    return silver.snapshot(f.users, "users_clean", RUN_1)


@query
def silver_products(f: Frames) -> DataFrame:
    return silver.snapshot(f.products, "products_clean", RUN_1)


@query
def session_bounds(f: Frames) -> DataFrame:
    return rounded(sessions.session_bounds(f.silver_plain))


@query
def session_metrics_silver(f: Frames) -> DataFrame:
    return rounded(f.sessions)


@query
def session_flags(f: Frames) -> DataFrame:
    return sessions.flag_long(f.sessions).select(
        "session_id", "is_abandoned_cart", "is_high_activity", "is_long_session"
    )


@query
def long_sessions_silver(f: Frames) -> DataFrame:
    return rounded(
        sessions.flag_long(f.sessions)
        .where("is_long_session")
        .select("session_id", "session_duration_s")
    )


@query
def session_anomaly_counts(f: Frames) -> DataFrame:
    return sessions.anomaly_counts(f.sessions)


@query
def order_session_metrics(f: Frames) -> DataFrame:
    """Session metrics over the order lines, the largest table."""
    from rillflow.sources.testtables import order_logs

    logs = project(order_logs(f.spark, f.sf_dir), BRONZE["weblogs"])
    return rounded(sessions.session_metrics(silver.to_silver(logs, RUN_1)))


@query
def order_repeats(f: Frames) -> DataFrame:
    """Rows of the order lines whose log id came before, counted per id."""
    from rillflow.sources.testtables import order_logs

    logs = project(order_logs(f.spark, f.sf_dir), BRONZE["weblogs"]).select("row_index", "log_id")
    marked = dedupe.flag_repeats(logs, "log_id", "is_repeat")
    return (
        marked.where("is_repeat").groupBy("log_id").agg(F.count(F.lit(1)).alias("later_copies"))
    )


# gold -------------------------------------------------------------------------------------
@query
def dim_user(f: Frames) -> DataFrame:
    return f.dim_user


@query
def dim_product(f: Frames) -> DataFrame:
    return f.dim_product


def _second_load(f: Frames, build, dataset: str, schema, older: DataFrame, newer: DataFrame):
    first = build(f.empty(schema), silver.snapshot(older, dataset, RUN_1), RUN_1).drop("_change")
    both = silver.snapshot(older, dataset, RUN_1).unionByName(
        silver.snapshot(newer, dataset, RUN_2)
    )
    return build(first, both, RUN_2)


@query
def dim_user_upsert(f: Frames) -> DataFrame:
    """A first load of the early users under older names, then a load of all users."""
    older = f.users.where("signup_date < DATE'2022-01-01'").withColumns(
        {"user_name": F.upper("user_name"), "signup_date": F.date_sub("signup_date", 1)}
    )
    return _second_load(f, gold.user_dimension, "users_clean", DIM_USER, older, f.users)


@query
def dim_product_upsert(f: Frames) -> DataFrame:
    """A first load of the cheaper products at half price, then a load of all products."""
    older = f.products.where("price < 1200").withColumn("price", F.col("price") / 2)
    return rounded(
        _second_load(f, gold.product_dimension, "products_clean", DIM_PRODUCT, older, f.products)
    )


@query
def fact_user_activity(f: Frames) -> DataFrame:
    return f.fact


def _early(logs: DataFrame) -> DataFrame:
    return logs.where("action_ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'")


@query
def fact_incremental(f: Frames) -> DataFrame:
    """Rows a load of all logs adds after the logs up to mid-month were loaded."""
    return f.fact_of(f.silver_plain, loaded=f.fact_of(_early(f.silver_plain)))


@query
def agg_session_metrics(f: Frames) -> DataFrame:
    return rounded(f.agg)


@query
def agg_incremental(f: Frames) -> DataFrame:
    """Sessions a load of all logs adds after the sessions up to mid-month were loaded."""
    return rounded(f.agg_of(f.silver_plain, loaded=f.agg_of(_early(f.silver_plain))))


def _gold_after_failed_run(f: Frames) -> Lake:
    """Two runs of one input, the first of which never got to Gold."""
    f.ready("users", "products")
    f.ready("weblogs", "dim_user", "dim_product")
    lake = Lake(f.spark, fresh_folder(f.spark, "lake"))
    lake.write_dim(f.dim_user, "dim_user", RUN_1)
    lake.write_dim(f.dim_product, "dim_product", RUN_1)
    for ctx in (RUN_1, RUN_2):
        pipeline.write_logs(lake, ctx, f.silver)
    return lake


@query
def fact_after_failed_run(f: Frames) -> DataFrame:
    """Facts after a load of two runs of one input, and a second load that finds nothing new."""
    lake = _gold_after_failed_run(f)
    for _ in range(2):
        pipeline.load_facts(lake)
    return lake.read_gold("fact_user_activity").drop("activity_id")


@query
def agg_after_failed_run(f: Frames) -> DataFrame:
    lake = _gold_after_failed_run(f)
    for _ in range(2):
        pipeline.load_sessions(lake)
    return rounded(lake.read_gold("agg_session_metrics"))


@query
def rebuild_sessions_once(f: Frames) -> DataFrame:
    """Sessions summed up anew over two runs of one input."""
    lake = _gold_after_failed_run(f)
    pipeline.rebuild_sessions(lake)
    return rounded(lake.read_gold("agg_session_metrics"))


@query
def product_daily_stats(f: Frames) -> DataFrame:
    return gold.product_daily_stats(f.fact)


# business questions -----------------------------------------------------------------------
@query
def bi_01_most_viewed_products(f: Frames) -> DataFrame:
    return bi.most_viewed_products(f.fact, f.dim_product)


@query
def bi_02_overall_conversion_rate(f: Frames) -> DataFrame:
    return rounded(bi.overall_conversion_rate(f.agg))


@query
def bi_03_average_session_duration(f: Frames) -> DataFrame:
    return rounded(bi.average_session_minutes(f.agg))


@query
def bi_04_top_users_by_purchases(f: Frames) -> DataFrame:
    return bi.top_users(f.agg, f.dim_user)


@query
def bi_05_abandoned_cart_rate_per_day(f: Frames) -> DataFrame:
    return rounded(bi.abandoned_rate_by_load_date(f.agg))


@query
def bi_06_product_conversion_rate(f: Frames) -> DataFrame:
    return rounded(bi.product_conversion(f.fact, f.dim_product))


@query
def bi_07_average_actions_per_session(f: Frames) -> DataFrame:
    return rounded(bi.average_actions(f.agg))


@query
def bi_08_peak_activity_hours(f: Frames) -> DataFrame:
    return bi.activity_by_hour(f.fact)


@query
def bi_09_unusually_long_sessions(f: Frames) -> DataFrame:
    return bi.long_sessions(f.agg)


@query
def bi_10_cohort_signup_vs_purchases(f: Frames) -> DataFrame:
    return bi.signup_cohorts(f.agg, f.dim_user)


# checks: on the good fact table and on one with broken keys --------------------------------
@query
def check_orphan_user_sk(f: Frames) -> DataFrame:
    return checks.orphan_users(f.fact, f.dim_user)


@query
def check_orphan_user_sk_broken(f: Frames) -> DataFrame:
    return checks.orphan_users(f.broken_fact, f.dim_user)


@query
def check_duplicate_log_id(f: Frames) -> DataFrame:
    return checks.duplicate_log_ids(f.fact)


@query
def check_duplicate_log_id_broken(f: Frames) -> DataFrame:
    return checks.duplicate_log_ids(f.broken_fact)


@query
def check_negative_duration(f: Frames) -> DataFrame:
    return checks.negative_durations(f.agg)


@query
def check_negative_duration_broken(f: Frames) -> DataFrame:
    """Sessions without a view are given a duration below zero."""
    turned = F.when(F.col("total_views") == 0, -1 - F.col("session_duration_s")).otherwise(F.col("session_duration_s"))
    return checks.negative_durations(f.agg.withColumn("session_duration_s", turned))


@query
def check_null_sk(f: Frames) -> DataFrame:
    return checks.null_keys(f.fact)


@query
def check_null_sk_broken(f: Frames) -> DataFrame:
    return checks.null_keys(f.broken_fact)


@query
def run_checks(f: Frames) -> DataFrame:
    return checks.run_checks(pin(f.fact), f.agg, f.dim_user)


# metrics and report -----------------------------------------------------------------------
def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _one(df: DataFrame, kind: str, name: str, layer: str | None = None) -> DataFrame:
    return report.metric_rows(_count(df), kind, F.lit(name), F.col("n"), layer=layer)


def _metrics(f: Frames) -> DataFrame:
    """The metrics frame of a first run, from the layers themselves."""
    f.weblogs_classified = pin(f.weblogs_classified)
    sources = ("users", "products", "weblogs")
    reasons = [quality.reason_counts(getattr(f, f"{s}_classified"), s) for s in sources]
    out = [_one(f.raw(s), "extracted", s) for s in sources]
    for counts, source in zip(reasons, sources):
        total = counts.agg(F.sum("rejected").alias("n"))
        out.append(report.metric_rows(total, "quarantined", F.lit(source), F.col("n")))
        out.append(
            report.metric_rows(
                counts, "reason", F.lit(source), F.col("rejected"),
                detail=F.col("rejection_reason"),
            )
        )
    layers = {
        "bronze": {s: getattr(f, s) for s in sources},
        "silver": {
            "weblogs_clean": f.silver_plain, "users_clean": f.users, "products_clean": f.products,
        },
        "gold": {
            "dim_user": f.dim_user, "dim_product": f.dim_product,
            "fact_user_activity": f.fact, "agg_session_metrics": f.agg,
        },
    }
    out += [
        _one(df, "loaded", name, layer) for layer, sets in layers.items() for name, df in sets.items()
    ]
    counts = sessions.anomaly_counts(f.sessions)
    flat = counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("n")) for c in counts.columns])
        )
    )
    out.append(report.metric_rows(flat, "anomaly", F.col("k"), F.col("n")))
    return report.combine(out)


@query
def run_metrics(f: Frames) -> DataFrame:
    return _metrics(f)


@query
def audit_rows(f: Frames) -> DataFrame:
    return report.audit_rows(_metrics(f), RUN_1, source_file="raw/weblogs", status="SUCCESS")


@query
def quality_observations(f: Frames) -> DataFrame:
    return rounded(
        quality.quality_observations(
            f.raw("users"), f.users, f.raw("products"), f.raw("weblogs")
        )
    )


@query
def recommendations(f: Frames) -> DataFrame:
    return rounded(report.recommendations(_metrics(f)))


# files, layers and whole runs -------------------------------------------------------------
def _write_csv(f: Frames, folder: str, source: str) -> str:
    """The raw rows as CSV files in source order."""
    path = f"{folder}/raw/{source}"
    rows = f.raw(source).orderBy("row_index").select(*RAW_COLUMNS[source])
    rows.write.options(**CSV_OPTIONS).csv(path)
    return path


@query
def csv_scan_positions(f: Frames) -> DataFrame:
    """CSV files read back: each row gets the position it has over all files."""
    path = _write_csv(f, fresh_folder(f.spark, "csv"), "weblogs")
    rows, _ = land(f.spark, path, RAW_COLUMNS["weblogs"])
    return rows.select("row_index", "log_id", "user_id", "session_id")


@query
def bulk_load_by_name(f: Frames) -> DataFrame:
    """Logs loaded by column name; rows with an unreadable value are counted, not lost."""
    path = _write_csv(f, fresh_folder(f.spark, "csv"), "users")
    good, bad = load_by_name(f.spark, [path], BRONZE["users"])
    named = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("kind"), "rows")
        for n, df in (("good", good), ("bad", bad))
    ]
    return report.combine(named)


@query
def csv_mixed_headers(f: Frames) -> DataFrame:
    """Logs in files of three headers: other orders, further columns, one name twice."""
    folder = fresh_folder(f.spark, "csv")
    raw = f.raw("weblogs")
    more = raw.withColumns({"extra": F.lit("x, y"), "note": F.col("action")})
    orders = {
        "a": RAW_COLUMNS["weblogs"],
        "b": ["timestamp", "extra", "action", "user_id", "log_id", "session_id", "product_id"],
        "c": ["note", "session_id", "log_id", "extra", "product_id", "timestamp", "user_id", "action", "note"],
    }
    for k, (name, columns) in enumerate(orders.items()):
        part = more.where(F.col("row_index") % 3 == k).orderBy("row_index")
        cells = part.select(*[F.col(c).alias(f"_{n}") for n, c in enumerate(columns)])
        _write_with_header(cells, columns, f"{folder}/{name}")
    rows, _ = land(f.spark, [f"{folder}/{name}" for name in orders], RAW_COLUMNS["weblogs"])
    return rows.drop("row_index")


def _write_with_header(cells: DataFrame, header: list[str], folder: str) -> None:
    """CSV files with the given header, whose names need not differ."""
    names = F.lit(",".join(header))
    line = F.to_csv(F.struct(*cells.columns), {k: v for k, v in CSV_OPTIONS.items() if k != "header"})
    # one file per task; its first row brings the header along
    at = F.monotonically_increasing_id()
    first = F.pmod(at, F.lit(1 << 33)) == 0
    lines = cells.select(F.when(first, F.concat(names, F.lit("\n"), line)).otherwise(line).alias("line"))
    lines.write.text(folder)


@query
def csv_multiline_cells(f: Frames) -> DataFrame:
    """Products whose names hold line breaks, quotes and commas."""
    folder = fresh_folder(f.spark, "csv")
    name = F.expr(
        """CASE product_id % 4 WHEN 0 THEN concat(product_name, '\n', 'second, "line"')
           WHEN 1 THEN concat('"', product_name, '"') ELSE product_name END"""
    )
    rows = f.raw("products").withColumn("product_name", name).orderBy("row_index")
    rows.select(*RAW_COLUMNS["products"]).write.options(**CSV_OPTIONS).csv(folder)
    landed, _ = land(f.spark, folder, RAW_COLUMNS["products"])
    return landed.select("row_index", "product_id", "product_name", "category")


def _broken_users(f: Frames) -> tuple[DataFrame, DataFrame]:
    """Users loaded by name; some rows have a cell too few, some one too many."""
    folder = fresh_folder(f.spark, "csv")
    cells = f.raw("users").where("user_id IS NOT NULL").orderBy("row_index")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in RAW_COLUMNS["users"]])
    id_ = F.col("user_id").cast("long")
    line = F.when(id_ % 50 == 7, F.regexp_replace(line, ",[^,]*$", "")).when(
        id_ % 50 == 8, F.concat(line, F.lit(",one more"))
    ).otherwise(line)
    header = F.lit("USER_ID,User_Name,email,signup_date\n")
    first = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33)) == 0
    cells.select(F.when(first, F.concat(header, line)).otherwise(line).alias("line")).write.text(folder)
    return load_by_name(f.spark, [folder], table("user_id long, user_name string, email string, signup_date date"))


@query
def bulk_load_rows(f: Frames) -> DataFrame:
    return _broken_users(f)[0]


@query
def bulk_load_rejects(f: Frames) -> DataFrame:
    return _broken_users(f)[1]


@query
def staged_scan_typed(f: Frames) -> DataFrame:
    """Staged files by name pattern, columns by name with their types."""
    path = _write_csv(f, fresh_folder(f.spark, "csv"), "products")
    wanted = table("product_id long, product_name string, price double")
    return typed_scan(f.spark, path, wanted, pattern="*.csv")


def whole_run_inputs(spark: SparkSession, sf_dir: str) -> tuple[Lake, dict[str, str]]:
    """A fresh lake folder and the three sources as CSV."""
    f = Frames(spark, sf_dir)
    folder = fresh_folder(spark, "lake")
    paths = {s: _write_csv(f, folder, s) for s in RAW_COLUMNS}
    return Lake(spark, f"{folder}/lake"), paths


@query
def full_run_report(f: Frames) -> DataFrame:
    """A whole run from CSV to Gold; its report without paths and times."""
    lake, paths = whole_run_inputs(f.spark, f.sf_dir)
    lake.init_gold(RUN_1)
    rows = pipeline.run(lake, paths, RUN_1)
    kept = rows.where(~F.col("section").isin("quarantine_paths", "run", "recommendations"))
    number: Column = F.round(F.col("value").cast("double"), 6)
    return kept.select("section", "item", "sub_item", number.alias("value"))


def _whole_run(f: Frames) -> tuple[Lake, DataFrame]:
    lake, paths = whole_run_inputs(f.spark, f.sf_dir)
    lake.init_gold(RUN_1)
    return lake, pipeline.run(lake, paths, RUN_1)


@query
def report_ranked(f: Frames) -> DataFrame:
    """The report of a whole run in its order: the place of each row in its section."""
    _, rows = _whole_run(f)
    kept = rows.where(~F.col("section").isin("quarantine_paths", "run", "recommendations"))
    return kept.select("section", "item", "sub_item", "rank")


@query
def audit_rows_with_paths(f: Frames) -> DataFrame:
    """The audit log of a whole run; quarantine paths without the folder of the lake."""
    lake, _ = _whole_run(f)
    paths = F.replace("quarantine_path", F.lit(f"{lake.root}/"), F.lit(""))
    return lake.read_gold("etl_audit_log").select(
        "audit_id", "layer", "rows_extracted", "rows_quarantined", "rows_loaded", "status",
        paths.alias("quarantine_path"),
    )


@query
def gold_export(f: Frames) -> DataFrame:
    """Facts as the export of a whole run holds them."""
    lake, _ = _whole_run(f)
    lake.export(RUN_1)
    return f.spark.read.parquet(f"{lake.root}/export/fact_user_activity").drop("activity_id")


@query
def silver_session_order(f: Frames) -> DataFrame:
    """Where each log stands among those of its session in the files of Silver."""
    lake = Lake(f.spark, fresh_folder(f.spark, "lake"))
    fits = f.fits
    logs = silver.ordered(f.silver_plain, f.users, f.products, **fits)
    lake.write_silver(logs, "weblogs_clean", RUN_1)
    # a file holds one range of the order, and its rows in order
    rows = lake.read_silver("weblogs_clean").select(
        "session_id", "row_index", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    place = F.row_number().over(Window.partitionBy("session_id").orderBy("file", "at"))
    return rows.select("session_id", "row_index", place.alias("place"))


@query
def long_sessions_running(f: Frames) -> DataFrame:
    """Unusually long sessions after two loads, by the moments that each load noted."""
    lake = Lake(f.spark, fresh_folder(f.spark, "lake"))
    lake.init_gold(RUN_1)
    lake.write_dim(f.dim_user, "dim_user", RUN_1)
    for k, run in enumerate((RUN_1, RUN_2)):
        half = silver.to_silver(f.weblogs, run).where(F.pmod(F.crc32("session_id"), F.lit(2)) == k)
        absent = [c for c in SILVER["weblogs_clean"].fields if c.name not in half.columns]
        half = half.select("*", *[F.lit(None).cast(c.dataType).alias(c.name) for c in absent])
        pipeline.write_logs(lake, run, half.select(*SILVER["weblogs_clean"].names))
        pipeline.load_sessions(lake)
    return rounded(bi.long_sessions_running(lake))


@query
def layer_inventory(f: Frames) -> DataFrame:
    """Rows per Bronze partition, summed over its files."""
    lake = Lake(f.spark, fresh_folder(f.spark, "lake"))
    for source in ("users", "products"):
        lake.write_bronze(getattr(f, source), source, RUN_1)
    files = lake.inventory("bronze")
    source = F.regexp_extract("file_path", "/bronze/([a-z]+)/ingest_date=", 1)
    return files.groupBy(source.alias("source")).agg(F.sum("rows").alias("rows"))


# streams ----------------------------------------------------------------------------------
def _streamed(f: Frames) -> Lake:
    """A lake into which the logs came as a stream of files in three arrivals."""
    folder = fresh_folder(f.spark, "stream")
    lake = Lake(f.spark, f"{folder}/lake")
    for source in ("users", "products"):
        lake.write_bronze(getattr(f, source), source, RUN_1)
    raw = f.raw("weblogs")
    n = raw.count()
    for i in range(3):
        arrival = raw.where(F.col("row_index").between(n * i // 3, n * (i + 1) // 3 - 1))
        ordered = arrival.orderBy("row_index").select(*RAW_COLUMNS["weblogs"])
        ordered.write.mode("append").options(**CSV_OPTIONS).csv(f"{folder}/arrivals/{i}")
        stream_ingest.run_available(lake, f"{folder}/arrivals/*", RUN_1, f"{folder}/progress")
    return lake


@query
def stream_weblogs_classified(f: Frames) -> DataFrame:
    """The logs as a stream of files in three arrivals; kept and rejected rows afterwards."""
    lake = _streamed(f)
    kept = lake.read_bronze("weblogs", RUN_1).select(
        "row_index", F.lit(None).cast("string").alias("rejection_reason")
    )
    lost = lake.read_quarantine().where("source = 'weblogs'")
    return kept.unionByName(lost.select("row_index", "rejection_reason"))


@query
def stream_two_runs_one_day(f: Frames) -> DataFrame:
    """Two streams of one day, each with half of the logs: both stay in Bronze, beside a batch load."""
    folder = fresh_folder(f.spark, "stream")
    lake = Lake(f.spark, f"{folder}/lake")
    for source in ("users", "products"):
        lake.write_bronze(getattr(f, source), source, RUN_1)
    raw = f.raw("weblogs")
    n = raw.count()
    for i, run in enumerate((RUN_1, replace(RUN_1, run_id="run-0001b"))):
        half = raw.where(F.expr(f"least(1, row_index * 2 div {n})") == i).orderBy("row_index")
        half.select(*RAW_COLUMNS["weblogs"]).write.options(**CSV_OPTIONS).csv(f"{folder}/half-{i}")
        stream_ingest.run_available(lake, f"{folder}/half-{i}", run, f"{folder}/progress-{i}")
    kept = lake.read_bronze("weblogs", RUN_1).select("log_id", F.lit(None).cast("string").alias("rejection_reason"))
    lost = lake.read_quarantine().where("source = 'weblogs'")
    log_id = F.get_json_object("raw_row", "$.log_id").cast("long")
    return kept.unionByName(lost.select(log_id.alias("log_id"), "rejection_reason"))


@query
def stream_counters(f: Frames) -> DataFrame:
    """Counters of a stream, added up over its micro-batches."""
    lake = _streamed(f)
    return lake.read_batch_metrics(RUN_1).select("kind", "layer", "name", "detail", "value")


@query
def stream_session_windows(f: Frames) -> DataFrame:
    """Session totals from a stream of Silver logs that come at once: closed and open ones."""
    folder = fresh_folder(f.spark, "stream")
    f.silver.write.parquet(f"{folder}/silver")
    return stream_sessions.run_available(f.spark, f"{folder}/silver", f"{folder}/out")


def _three_arrivals(f: Frames) -> stream_sessions.SessionStream:
    """The Silver logs in three arrivals in the order of their ids, which is not that of their times."""
    folder = fresh_folder(f.spark, "stream")
    stream = stream_sessions.SessionStream(f.spark, f"{folder}/out")
    n = f.raw("weblogs").count()
    logs = f.silver.withColumn("arrival", F.least(F.lit(2), F.expr(f"row_index * 3 div {n}")))
    logs.write.partitionBy("arrival").parquet(f"{folder}/silver")
    for i in range(3):
        stream.run_available(f"{folder}/silver/arrival=[0-{i}]")
    return stream


@query
def stream_late_logs(f: Frames) -> DataFrame:
    """Logs behind the watermark when they came, with the batch that brought them."""
    return _three_arrivals(f).late().select("log_id", "row_index", "session_id", "action_ts", "batch")


@query
def stream_sessions_in_time(f: Frames) -> DataFrame:
    """Sessions of the logs that came in time, and whether they can still grow."""
    stream = _three_arrivals(f)
    states = [getattr(stream, s)().withColumn("state", F.lit(s)) for s in ("closed", "open")]
    return states[0].unionByName(states[1])


@query
def stream_sessions_reconciled(f: Frames) -> DataFrame:
    """Late logs merged in afterwards: the sessions of all logs."""
    return _three_arrivals(f).reconciled()
