import pytest
from pyspark.sql import functions as F

from rillflow.operators.quality import classify, clean
from rillflow.plans.silver import enrich, ordered, to_silver
from rillflow.sources.testtables import RAW_FRAMES
from tests.conftest import SF_DIR


@pytest.mark.parametrize("fits", [True, False])
def test_enriched_logs_come_in_session_order(spark, ctx, tmp_path, fits):
    raw = {s: build(spark, SF_DIR) for s, build in RAW_FRAMES.items()}
    users, products = (clean(classify(raw[s], s), s) for s in ("users", "products"))
    logs = to_silver(clean(classify(raw["weblogs"], "weblogs", users=users, products=products), "weblogs"), ctx)
    logs = logs.repartition(5)
    got = ordered(logs, users, products, users_fit=fits, products_fit=fits)
    want = enrich(logs, users, products)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    got.write.parquet(str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).select(
        "session_id", "action_ts", "row_index", F.col("_metadata.file_name"), F.col("_metadata.row_index").alias("at")
    )
    placed = [tuple(r)[:3] for r in rows.orderBy("file_name", "at").collect()]
    assert placed == sorted(placed) and len(placed) > 100
