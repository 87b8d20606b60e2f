import pytest

from rillflow.plans import report

ROWS = [
    ("extracted", None, "weblogs", None, 1000.0),
    ("quarantined", None, "weblogs", None, 150.0),
    ("reason", None, "weblogs", "invalid timestamp", 50.0),
    ("reason", None, "weblogs", "orphan user_id", 100.0),
    ("path", None, "weblogs", "q/b", None),
    ("path", None, "users", "q/a", None),
    ("loaded", "bronze", "weblogs", None, 850.0),
    ("loaded", "silver", "weblogs_clean", None, 850.0),
    ("loaded", "gold", "fact_user_activity", None, 800.0),
    ("loaded", "gold", "dim_user", None, 50.0),
    ("anomaly", None, "abandoned_cart", None, 42.0),
    ("anomaly", None, "long_session", None, 0.0),
    ("observation", None, "users.null_user_name_rate", None, 0.05),
]


@pytest.fixture
def metrics(spark):
    return report.metrics_frame(spark, ROWS)


def test_audit_rows(metrics, ctx):
    rows = report.audit_rows(metrics, ctx, source_file="w.csv", status="SUCCESS", first_id=4)
    got = {r.layer: r for r in rows.collect()}
    assert [(got[x].audit_id, got[x].rows_loaded) for x in report.LAYERS] == [
        (4, 850), (5, 850), (6, 850),
    ]
    assert (got["bronze"].rows_extracted, got["bronze"].rows_quarantined) == (1000, 150)
    assert (got["silver"].rows_extracted, got["silver"].rows_quarantined) == (0, 0)
    assert got["bronze"].quarantine_path == "q/a;q/b" and got["gold"].quarantine_path == ""
    assert {r.status for r in got.values()} == {"SUCCESS"}


def test_recommendations(metrics):
    got = {r.rule: r for r in report.recommendations(metrics, "FAILED").collect()}
    assert got["quarantine_rate"].observed == 0.15 and got["quarantine_rate"].triggered
    assert got["abandoned_cart_sessions"].triggered and got["run_failed"].triggered
    assert not got["long_sessions"].triggered and not got["high_activity_sessions"].triggered


def test_report_sections_and_order(metrics, ctx):
    rows = report.report_rows(metrics, ctx, "FAILED", "boom").orderBy("section", "rank").collect()
    assert {r.section for r in rows} == {
        "run", "row_counts", "rows_loaded", "quarantine_breakdown", "quarantine_paths",
        "quality_observations", "session_anomalies", "recommendations",
    }
    reasons = [r.sub_item for r in rows if r.section == "quarantine_breakdown"]
    assert reasons == ["orphan user_id", "invalid timestamp"]
    assert "boom" in [r.value for r in rows if r.section == "run"]


def test_empty_run(spark, ctx):
    none = report.metrics_frame(spark, [])
    rows = report.audit_rows(none, ctx, source_file="w", status="FAILED", error="x").collect()
    assert [r.rows_loaded for r in rows] == [0, 0, 0]
    assert not any(r.triggered for r in report.recommendations(none).collect())
