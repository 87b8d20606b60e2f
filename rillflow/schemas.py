"""Table schemas of every layer, and the fixed thresholds of the quality and session rules."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "ntz": T.TimestampNTZType(),
    "bool": T.BooleanType(),
}


def table(spec: str) -> T.StructType:
    """``"a long, b string"`` as a nullable StructType."""
    pairs = (item.split() for item in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


def all_text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Raw sources are read as text and typed column by column, so a bad cell never loses its row.
RAW_COLUMNS = {
    "users": ["user_id", "user_name", "email", "signup_date"],
    "products": ["product_id", "product_name", "category", "price"],
    "weblogs": ["log_id", "user_id", "product_id", "session_id", "action", "timestamp"],
}
RAW = {source: all_text(*cols) for source, cols in RAW_COLUMNS.items()}

# Clean layers carry the source row position as their last column.
BRONZE = {
    "users": table(
        "user_id long, user_name string, email string, signup_date date, "
        "is_duplicate_email bool, is_invalid_email bool, row_index long"
    ),
    "products": table(
        "product_id long, product_name string, category string, price double, row_index long"
    ),
    "weblogs": table(
        "log_id long, user_id long, product_id long, session_id string, action string, "
        "timestamp string, row_index long"
    ),
}

QUARANTINE = table(
    "etl_run_id string, etl_run_date date, etl_run_timestamp ntz, source_file string, "
    "row_index long, rejection_reason string, raw_row string"
)

SILVER = {
    "users_clean": table(
        "user_id long, user_name string, email string, signup_date date, "
        "is_duplicate_email bool, is_invalid_email bool, etl_run_date date"
    ),
    "products_clean": table(
        "product_id long, product_name string, category string, price double, etl_run_date date"
    ),
    "weblogs_clean": table(
        "log_id long, user_id long, product_id long, session_id string, action string, "
        "timestamp string, action_ts ntz, etl_run_id string, etl_run_date date, "
        "user_name string, email string, product_name string, category string, price double, "
        "row_index long"
    ),
}
SILVER_PARTITIONS = {
    "users_clean": ("etl_run_date",),
    "products_clean": ("etl_run_date",),
    "weblogs_clean": ("etl_run_date", "etl_run_id"),
}

DIM_USER = table(
    "user_sk long, user_id long, user_name string, email string, signup_date date, "
    "dw_created_at ntz, dw_updated_at ntz"
)
DIM_PRODUCT = table(
    "product_sk long, product_id long, product_name string, category string, price double, "
    "dw_created_at ntz"
)
FACT = table(
    "activity_id long, log_id long, user_sk long, product_sk long, session_id string, "
    "action string, action_ts ntz, etl_run_id string, etl_run_date date"
)
AGG = table(
    "session_id string, user_sk long, session_start ntz, session_end ntz, "
    "session_duration_s double, total_actions long, total_views long, total_cart_adds long, "
    "total_purchases long, conversion_rate double, is_abandoned_cart bool, "
    "is_high_activity bool, etl_run_date date"
)
AUDIT = table(
    "audit_id long, etl_run_id string, etl_run_date date, etl_run_timestamp ntz, "
    "source_file string, layer string, rows_extracted long, rows_quarantined long, "
    "rows_loaded long, quarantine_path string, status string, error_message string, "
    "created_at ntz"
)
METRICS = table("kind string, layer string, name string, detail string, value double")
REPORT = table(
    "section string, item string, sub_item string, value string, rank int, "
    "etl_run_date date, etl_run_id string"
)
RUNS = table(
    "etl_run_id string, etl_run_date date, run_ts ntz, content string, stage string"
)
PRODUCT_DAILY = table("product_sk long, etl_run_date date, views long, purchases long")

GOLD = {
    "dim_user": DIM_USER,
    "dim_product": DIM_PRODUCT,
    "fact_user_activity": FACT,
    "agg_session_metrics": AGG,
    "etl_audit_log": AUDIT,
    "product_daily_stats": PRODUCT_DAILY,
}

# The accepted actions and the rule thresholds.
ACTIONS = ["view", "add_to_cart", "purchase"]
HIGH_ACTIVITY_ACTIONS = 50
LONG_SESSION_STDDEVS = 2.0
QUARANTINE_RATE_LIMIT = 0.10
