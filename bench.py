"""Wall time of the headline queries and of a whole run; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.frames import RUN_1, RUN_2  # noqa: E402
from registry.queries import QUERIES, whole_run_inputs  # noqa: E402
from rillflow.plans import bi, pipeline  # noqa: E402
from rillflow.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Whole queries from the raw tables on.
HEADLINE = [
    "users_clean",
    "weblogs_classified",
    "quarantine_weblogs",
    "silver_weblogs",
    "session_metrics_silver",
    "session_anomaly_counts",
    "order_session_metrics",
    "order_repeats",
    "dim_user",
    "fact_user_activity",
    "agg_session_metrics",
    "product_daily_stats",
    "bi_01_most_viewed_products",
    "bi_02_overall_conversion_rate",
    "bi_10_cohort_signup_vs_purchases",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job) -> float:
    began = time.perf_counter()
    job()
    return round(time.perf_counter() - began, 3)


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    drain(QUERIES["weblogs_classified"](spark, SF_DIR))  # start the JVM's compilers
    for name in HEADLINE:
        times[name] = timed(lambda: drain(QUERIES[name](spark, SF_DIR)))

    # A run from CSV files to Gold, a second one over the loaded lake, and Gold questions alone.
    lake, paths = whole_run_inputs(spark, SF_DIR)
    lake.init_gold(RUN_1)
    times["full_run"] = timed(lambda: pipeline.run(lake, paths, RUN_1))
    times["second_run"] = timed(lambda: pipeline.run(lake, paths, RUN_2))
    fact, agg = lake.read_gold("fact_user_activity"), lake.read_gold("agg_session_metrics")
    users, products = lake.read_dim("dim_user"), lake.read_dim("dim_product")
    gold = {
        "gold_bi_01": lambda: bi.most_viewed_products(fact, products),
        "gold_bi_02": lambda: bi.overall_conversion_rate(agg),
        "gold_bi_03": lambda: bi.average_session_minutes(agg),
        "gold_bi_04": lambda: bi.top_users(agg, users),
        "gold_bi_05": lambda: bi.abandoned_rate_by_load_date(agg),
        "gold_bi_06": lambda: bi.product_conversion(fact, products),
        "gold_bi_07": lambda: bi.average_actions(agg),
        "gold_bi_08": lambda: bi.activity_by_hour(fact),
        "gold_bi_09": lambda: bi.long_sessions(agg),
        "gold_bi_10": lambda: bi.signup_cohorts(agg, users),
    }
    for name, build in gold.items():
        times[name] = timed(lambda: drain(build()))

    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    logs = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    line = {
        "metric": "total wall time of all bench queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
        "full_run_logs_per_sec": round(logs / times["full_run"]),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
