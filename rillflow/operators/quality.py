"""Row classification: one reason per rejected row, the first rule that holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.functions.scalars import (
    all_present,
    first_match,
    known_action,
    parse_timestamp,
    row_json,
    to_double,
    to_id,
    valid_email,
    valid_session,
)
from rillflow.operators.dedupe import flag_repeats, keep_latest
from rillflow.operators.joins import fits_broadcast, frequent_keys, lookup
from rillflow.schemas import BRONZE, QUARANTINE, RAW_COLUMNS
from rillflow.session import pin

# Rejection labels, in the order in which the rules are tried.
USER_REASONS = ["null user_id", "invalid signup_date"]
PRODUCT_REASONS = ["null product_id"]
WEBLOG_REASONS = [
    "null user_id",
    "duplicate log_id",
    "orphan user_id",
    "orphan product_id",
    "invalid session_id",
    "invalid timestamp",
]
REASONS = {"users": USER_REASONS, "products": PRODUCT_REASONS, "weblogs": WEBLOG_REASONS}


def require_columns(df: DataFrame, required: list[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def required_mask(df: DataFrame, required: list[str], name: str = "is_complete") -> DataFrame:
    """Add a flag: no required column is NULL. An absent column is an error of the whole frame."""
    require_columns(df, required)
    return df.withColumn(name, all_present(required))


def _with_raw(df: DataFrame, source: str) -> DataFrame:
    """Raw columns kept as the struct ``raw`` beside ``row_index``."""
    columns = RAW_COLUMNS[source]
    require_columns(df, columns + ["row_index"])
    return df.select("row_index", F.struct(*columns).alias("raw"))


def classify_users(raw: DataFrame) -> DataFrame:
    """``row_index, raw, user_id, signup_date, rejection_reason``: latest row per id, then judged."""
    typed = _with_raw(raw, "users").withColumn("user_id", to_id(F.col("raw.user_id")))
    latest = keep_latest(typed, "user_id")
    latest = latest.withColumn("signup_date", parse_timestamp(F.col("raw.signup_date")).cast("date"))
    rules = [F.col("user_id").isNull(), F.col("signup_date").isNull()]
    return latest.withColumn("rejection_reason", first_match(list(zip(USER_REASONS, rules))))


def classify_products(raw: DataFrame) -> DataFrame:
    """``row_index, raw, product_id, rejection_reason``: latest row per id, then judged."""
    typed = _with_raw(raw, "products").withColumn("product_id", to_id(F.col("raw.product_id")))
    latest = keep_latest(typed, "product_id")
    rules = [F.col("product_id").isNull()]
    return latest.withColumn("rejection_reason", first_match(list(zip(PRODUCT_REASONS, rules))))


def classify_weblogs(
    raw: DataFrame,
    users: DataFrame,
    products: DataFrame,
    *,
    seen: DataFrame | None = None,
    users_fit: bool | None = None,
    products_fit: bool | None = None,
) -> DataFrame:
    """``row_index, raw, log_id, user_id, product_id, rejection_reason`` for every log row.

    ``users`` and ``products`` are the clean tables; their ids are unique.  What the rules look at
    besides the ids is judged at the scan.  If a table is too large to be broadcast, the shuffles of
    the lookups move positions, ids and four flags, and the rows themselves move once, at the end, by
    position; the ids that are hot in any of the three lookups are then found in one pass.  Positions,
    ids and flags are then written once, so that the text is parsed once for all of these passes.
    """
    known = {"user_id": valid_ids(users, "user_id"), "product_id": valid_ids(products, "product_id")}
    fits = {"user_id": users_fit, "product_id": products_fit}
    fits = {k: fits_broadcast(known[k]) if f is None else f for k, f in fits.items()}
    in_place = all(fits.values())
    rows = _with_raw(raw, "weblogs")
    logs = rows.select(
        "row_index",
        *(["raw"] if in_place else []),
        *[to_id(F.col(f"raw.{c}")).alias(c) for c in ("log_id", "user_id", "product_id")],
        F.col("raw.user_id").isNotNull().alias("_has_user_id"),
        F.col("raw.product_id").isNotNull().alias("_has_product_id"),
        (~valid_session(F.col("raw.session_id"))).alias("_bad_session"),
        parse_timestamp(F.col("raw.timestamp")).isNull().alias("_bad_time"),
    )
    logs = logs if in_place else pin(logs)
    hot = {} if in_place else frequent_keys(logs, ["user_id", "product_id"])
    judged = flag_repeats(logs, "log_id", "_repeat", seen=seen)
    for key, table in known.items():
        judged = lookup(judged, table, key, small_fits=fits[key], hot=hot.get(key))
    rules = [
        ~F.col("_has_user_id"),
        F.col("_repeat"),
        F.col("_has_user_id") & (F.col("user_id").isNull() | F.col("_user_id_known").isNull()),
        F.col("_has_product_id") & (F.col("product_id").isNull() | F.col("_product_id_known").isNull()),
        F.col("_bad_session"),
        F.col("_bad_time"),
    ]
    ids = ["log_id", "user_id", "product_id"]
    judged = judged.select(
        "row_index",
        *(["raw"] if in_place else []),
        *ids,
        first_match(list(zip(WEBLOG_REASONS, rules))).alias("rejection_reason"),
    )
    if not in_place:
        judged = rows.join(judged, "row_index")
    return judged.select("row_index", "raw", *ids, "rejection_reason")


def valid_ids(clean: DataFrame, key: str) -> DataFrame:
    """The ids of a clean table, marked for a lookup; clean tables hold each id once."""
    return clean.select(key, F.lit(True).alias(f"_{key}_known"))


def clean_users(classified: DataFrame) -> DataFrame:
    """Accepted users with name filled and e-mail flags, which look at accepted rows only."""
    kept = classified.where(F.col("rejection_reason").isNull()).select(
        "user_id",
        F.coalesce("raw.user_name", F.lit("unknown")).alias("user_name"),
        F.col("raw.email").alias("email"),
        "signup_date",
        (~valid_email(F.col("raw.email"))).alias("is_invalid_email"),
        "row_index",
    )
    flagged = flag_repeats(kept, "email", "is_duplicate_email")
    return flagged.select(*BRONZE["users"].names)


def clean_products(classified: DataFrame) -> DataFrame:
    kept = classified.where(F.col("rejection_reason").isNull())
    return kept.select(
        "product_id",
        F.col("raw.product_name").alias("product_name"),
        F.col("raw.category").alias("category"),
        F.coalesce(to_double(F.col("raw.price")), F.lit(0.0)).alias("price"),
        "row_index",
    )


def clean_weblogs(classified: DataFrame) -> DataFrame:
    kept = classified.where(F.col("rejection_reason").isNull())
    return kept.select(
        "log_id",
        "user_id",
        "product_id",
        F.col("raw.session_id").alias("session_id"),
        F.col("raw.action").alias("action"),
        F.col("raw.timestamp").alias("timestamp"),
        "row_index",
    )


def quarantine(
    classified: DataFrame, source: str, source_file: str | Column, ctx: RunContext
) -> DataFrame:
    """Rejected rows as quarantine records, the original row as JSON text."""
    origin = F.lit(source_file) if isinstance(source_file, str) else source_file
    rejected = classified.where(F.col("rejection_reason").isNotNull())
    return rejected.select(
        ctx.id_col().alias("etl_run_id"),
        ctx.date_col().alias("etl_run_date"),
        ctx.ts_col().alias("etl_run_timestamp"),
        origin.alias("source_file"),
        "row_index",
        "rejection_reason",
        row_json([f"raw.{c}" for c in RAW_COLUMNS[source]]).alias("raw_row"),
    ).select(*QUARANTINE.names)


_CLASSIFY = {
    "users": (classify_users, clean_users),
    "products": (classify_products, clean_products),
    "weblogs": (classify_weblogs, clean_weblogs),
}


def classify(raw: DataFrame, source: str, **refs) -> DataFrame:
    if source not in _CLASSIFY:
        raise ValueError(f"Unknown validation source: {source!r}")
    return _CLASSIFY[source][0](raw, **refs)


def clean(classified: DataFrame, source: str) -> DataFrame:
    if source not in _CLASSIFY:
        raise ValueError(f"Unknown validation source: {source!r}")
    return _CLASSIFY[source][1](classified)


def validate(
    raw: DataFrame, source: str, ctx: RunContext, source_file: str, **refs
) -> tuple[DataFrame, DataFrame]:
    """``(clean rows, quarantine records)`` of one source."""
    judged = classify(raw, source, **refs)
    return clean(judged, source), quarantine(judged, source, source_file, ctx)


def reason_counts(classified: DataFrame, source: str) -> DataFrame:
    """``source, rejection_reason, rejected`` of one classified source."""
    return (
        classified.where(F.col("rejection_reason").isNotNull())
        .groupBy("rejection_reason")
        .agg(F.count(F.lit(1)).alias("rejected"))
        .select(F.lit(source).alias("source"), "rejection_reason", "rejected")
    )


def _rate(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def quality_observations(raw_users, users, raw_products, raw_weblogs) -> DataFrame:
    """``observation, rate``: shares of defects that do not reject a row."""
    parts = [
        (raw_users, "users.null_user_name_rate", F.col("user_name").isNull()),
        (users, "users.invalid_email_rate", F.col("is_invalid_email")),
        (users, "users.duplicate_email_rate", F.col("is_duplicate_email")),
        (raw_products, "products.null_price_rate", to_double(F.col("price")).isNull()),
        (
            raw_weblogs,
            "weblogs.unknown_action_rate",
            known_action(F.col("action")).isNull(),
        ),
    ]
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    for frame, name, holds in parts:
        frames.setdefault(id(frame), (frame, []))[1].append(
            F.struct(F.lit(name).alias("observation"), _rate(holds).alias("rate"))
        )
    # One pass per table, however many rates it gives.
    rows = [f.agg(F.array(*cols).alias("r")).select(F.inline("r")) for f, cols in frames.values()]
    out = rows[0]
    for other in rows[1:]:
        out = out.unionByName(other)
    return out


__all__ = [
    "REASONS",
    "classify",
    "clean",
    "quality_observations",
    "quarantine",
    "reason_counts",
    "required_mask",
    "validate",
]
