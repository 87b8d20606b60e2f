import pytest
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators import joins
from rillflow.plans import pipeline
from rillflow.schemas import ACTIONS, QUARANTINE, RAW_COLUMNS
from rillflow.sources.lake import Lake
from rillflow.sources.tables import CSV_OPTIONS
from rillflow.sources.testtables import RAW_FRAMES
from rillflow.streaming import ingest as stream_ingest
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    paths = {}
    for source, build in RAW_FRAMES.items():
        paths[source] = str(root / source)
        rows = build(spark, SF_DIR).orderBy("row_index").select(*RAW_COLUMNS[source])
        rows.write.options(**CSV_OPTIONS).csv(paths[source])
    return paths


@pytest.fixture(scope="module")
def loaded(spark, sources, tmp_path_factory):
    from datetime import date, datetime

    ctx = RunContext("run-a", date(2024, 6, 7), datetime(2024, 6, 7, 10, 0, 0))
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    lake.init_gold(ctx)
    report = pipeline.run(lake, sources, ctx)
    return lake, ctx, {(r.section, r.item, r.sub_item): r.value for r in report.collect()}


def test_every_row_is_kept_or_rejected(loaded):
    lake, ctx, got = loaded
    for source in RAW_COLUMNS:
        extracted = int(got["row_counts", source, "extracted"])
        kept = int(got["rows_loaded", "bronze", source])
        lost = int(got["row_counts", source, "quarantined"])
        assert kept == lake.read_bronze(source, ctx).count()
        assert lost == lake.read_quarantine().where(F.col("source") == source).count()
        if source == "weblogs":
            assert kept + lost == extracted == 1000
        else:
            assert kept + lost <= extracted


def test_clean_logs_are_sound(loaded):
    lake, ctx, _ = loaded
    logs = lake.read_bronze("weblogs", ctx)
    assert logs.select("log_id").distinct().count() == logs.count()
    for source, key in (("users", "user_id"), ("products", "product_id")):
        known = lake.read_bronze(source, ctx).select(key)
        assert logs.where(F.col(key).isNotNull()).join(known, key, "left_anti").isEmpty()
    silver = lake.read_silver("weblogs_clean")
    assert silver.count() == logs.count()
    assert {r.action for r in silver.select("action").distinct().collect()} <= {*ACTIONS, None}
    assert silver.where("etl_run_id <> 'run-a' OR etl_run_date <> DATE'2024-06-07'").isEmpty()
    assert lake.read_quarantine().columns == ["source", *QUARANTINE.names]


def test_gold_and_report(loaded):
    lake, _, got = loaded
    assert int(got["rows_loaded", "gold", "agg_session_metrics"]) == 198
    assert int(got["session_anomalies", "abandoned_cart", None]) == 45
    assert int(got["session_anomalies", "high_activity", None]) == 1
    checks = [(k, v) for k, v in got.items() if k[0] == "post_load_checks"]
    assert len(checks) == 4 and all(k[2] == "passed" and v == "0" for k, v in checks)
    assert got["run", "status", None] == "SUCCESS"
    audit = {r.layer: r for r in lake.read_gold("etl_audit_log").collect()}
    assert set(audit) == {"bronze", "silver", "gold"} and audit["silver"].rows_extracted == 0
    assert audit["bronze"].quarantine_path.count(";") == 2
    fact = lake.read_gold("fact_user_activity")
    assert fact.select("activity_id").distinct().count() == fact.count()
    stats = lake.read_gold("product_daily_stats")
    assert stats.agg(F.sum("views")).first()[0] == fact.where("action = 'view'").count()


def test_second_run_adds_no_facts(loaded, sources, ctx_next):
    lake, _, _ = loaded
    facts = lake.read_gold("fact_user_activity").count()
    report = pipeline.run(lake, sources, ctx_next)
    got = {(r.section, r.item, r.sub_item): r.value for r in report.collect()}
    assert got["rows_loaded", "gold", "fact_user_activity"] == "0"
    assert got["rows_loaded", "gold", "agg_session_metrics"] == "0"
    assert got["rows_loaded", "gold", "dim_user"] == "139"
    assert lake.read_gold("fact_user_activity").count() == facts
    assert lake.read_gold("etl_audit_log").count() == 6
    assert lake.read_report().select("etl_run_id").distinct().count() == 2


def test_retry_after_a_failed_gold_load_adds_each_log_once(loaded, ctx_next, spark, tmp_path):
    source, ctx, _ = loaded
    lake = Lake(spark, str(tmp_path / "lake"))
    for name in ("dim_user", "dim_product"):
        lake.write_dim(source.read_dim(name), name, ctx)
    logs = pipeline.current_logs(source, ctx)
    loose = logs.withColumn("log_id", F.when(F.col("row_index") % 7 != 0, F.col("log_id")))
    for run in (ctx, ctx_next):  # Gold failed the first time
        pipeline.write_logs(lake, run, loose)
    n, m = pipeline.load_facts(lake), pipeline.load_sessions(lake)
    assert n == source.read_gold("fact_user_activity").count()
    assert m == source.read_gold("agg_session_metrics").count()
    assert pipeline.load_facts(lake) == pipeline.load_sessions(lake) == 0
    # other logs of a later run are loaded, known ids are not
    pipeline.write_logs(lake, ctx_next, logs)
    assert pipeline.load_facts(lake, only="another run") == 0
    known = lake.read_gold("fact_user_activity").where("log_id IS NOT NULL").count()
    assert pipeline.load_facts(lake) == n - known


def test_rebuilt_sessions_equal_loaded_ones(loaded):
    lake, _, _ = loaded
    before = lake.read_gold("agg_session_metrics").collect()
    assert pipeline.rebuild_sessions(lake) >= len(before)
    # the second run had the same logs, which count once
    after = lake.read_gold("agg_session_metrics")
    assert sorted(map(tuple, after.collect()), key=repr) == sorted(map(tuple, before), key=repr)
    # back to what the loads had written
    kept = lake.spark.createDataFrame(before, after.schema)
    lake.overwrite_gold(kept, "agg_session_metrics", sort=["session_id"])


def test_large_side_joins_give_the_same_lake(loaded, sources, spark, tmp_path, monkeypatch):
    lake, ctx, _ = loaded
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    other = Lake(spark, str(tmp_path / "lake"))
    pipeline.run(other, sources, ctx, scope="run")
    for read in (
        lambda x: x.read_bronze("weblogs", ctx),
        lambda x: x.read_silver("weblogs_clean").where("etl_run_id = 'run-a'"),
        lambda x: x.read_gold("fact_user_activity").drop("activity_id"),
        lambda x: x.read_gold("agg_session_metrics"),
    ):
        assert read(lake).exceptAll(read(other)).isEmpty()
        assert read(other).exceptAll(read(lake)).isEmpty()


def test_scope_of_one_run_reads_its_partition_only(loaded):
    lake, ctx, _ = loaded
    plan = pipeline.current_logs(lake, ctx)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "etl_run_date" in filters and "etl_run_id" in filters
    with pytest.raises(ValueError, match="Unknown scope"):
        pipeline.build_gold(lake, ctx, [], "bogus")


def test_failure_is_recorded_and_raised(spark, sources, tmp_path, ctx):
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception):
        pipeline.run(lake, {**sources, "products": str(tmp_path / "absent")}, ctx)
    audit = lake.read_gold("etl_audit_log").collect()
    assert {r.status for r in audit} == {"FAILED"} and audit[0].error_message
    advice = lake.read_report(ctx).where("section = 'recommendations'").collect()
    assert "run_failed" in {r["item"] for r in advice}


def test_csv_lake_equals_parquet_lake(loaded, sources, spark, tmp_path):
    lake, ctx, _ = loaded
    other = Lake(spark, str(tmp_path / "lake"), "csv")
    pipeline.run(other, sources, ctx)
    for name in ("fact_user_activity", "agg_session_metrics"):
        a, b = (x.read_gold(name).drop("activity_id") for x in (lake, other))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def arrive(spark, folder, low, high):
    rows = RAW_FRAMES["weblogs"](spark, SF_DIR).where(f"row_index >= {low} AND row_index < {high}")
    ordered = rows.orderBy("row_index").select(*RAW_COLUMNS["weblogs"])
    ordered.write.options(**CSV_OPTIONS).csv(f"{folder}/{low:04d}")


def test_stream_equals_batch_and_survives_a_replay(loaded, spark, tmp_path):
    batch_lake, ctx, _ = loaded
    lake = Lake(spark, str(tmp_path / "lake"))
    for source in ("users", "products"):
        lake.write_bronze(batch_lake.read_bronze(source, ctx), source, ctx)
    folder = str(tmp_path / "arrivals")
    for low, high in ((0, 300), (300, 700), (700, 1000)):
        arrive(spark, folder, low, high)
        stream_ingest.run_available(lake, f"{folder}/*", ctx, str(tmp_path / "progress"))
    # the last batch once more, as after a failure just before its commit
    stream_ingest.process_batch(lake, ctx, [f"{folder}/0700"], 2, folder)

    def lost(x):
        return x.read_quarantine().where("source = 'weblogs' AND etl_run_id = 'run-a'").select(
            "row_index", "rejection_reason", "raw_row"
        )

    got, want = lake.read_bronze("weblogs", ctx), batch_lake.read_bronze("weblogs", ctx)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert lost(lake).exceptAll(lost(batch_lake)).isEmpty()
    assert lost(batch_lake).exceptAll(lost(lake)).isEmpty()
    counters = {(r.kind, r.detail): r.value for r in lake.read_batch_metrics(ctx).collect()}
    assert counters["extracted", None] == 1000 and counters["loaded", None] == want.count()
    assert counters["reason", "duplicate log_id"] == 23
