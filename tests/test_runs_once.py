"""What is below a measured join runs once, and ids are measured without the text beside them."""

from __future__ import annotations

from rillflow.operators import joins, quality
from rillflow.schemas import BRONZE
from rillflow.sources.lake import Lake
from rillflow.streaming import ingest
from rillflow.streaming.idstore import IdStore


def counted(df):
    """``df`` and a counter of the rows that were read from it."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


def test_known_ids_of_a_batch_are_found_once(spark, tmp_path, ctx):
    store = IdStore(Lake(spark, str(tmp_path / "lake")), ctx)
    rows, read = counted(spark.createDataFrame([(1,), (2,), (2,), (None,)], "log_id long"))
    ids = store.ids_of(rows)
    assert store.known(ids, 0) is None
    store.add(ids, 0)
    assert read.value == 4
    assert [r[0] for r in store.known(spark.createDataFrame([(2,), (3,)], "log_id long"), 1).collect()] == [2]


def _logs(raw):
    stamp = "2024-01-01T00:00:00"
    return raw(
        "weblogs",
        [(1, 1, 7, "sess_1", "view", stamp), (1, 1, 7, "sess_1", "view", stamp),
         (2, 9, 7, "sess_1", "view", stamp), (3, 1, 8, "sess_1", "view", stamp),
         (4, 1, 7, "x", "view", stamp), (5, 1, 7, "sess_1", "view", "never")],
    )


REASONS = [None, "duplicate log_id", "orphan user_id", "orphan product_id", "invalid session_id", "invalid timestamp"]


def test_classification_against_large_tables_parses_the_text_once(spark, raw, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    logs, read = counted(_logs(raw))
    users, products = spark.createDataFrame([(1,)], "user_id long"), spark.createDataFrame([(7,)], "product_id long")
    judged = quality.classify(logs, "weblogs", users=users, products=products)
    found = {r.row_index: r.rejection_reason for r in judged.collect()}
    assert [found[i] for i in range(6)] == REASONS
    assert read.value == 12  # ids and flags, and the rows at the end


def test_a_batch_broadcasts_ids_of_tables_whose_text_is_large(spark, raw, tmp_path, ctx, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    text = "x" * 5000
    users = spark.createDataFrame([(1, text, None, None, False, False, 0)], BRONZE["users"])
    products = spark.createDataFrame([(7, text, None, 1.0, 0)], BRONZE["products"])
    lake.write_bronze(users, "users", ctx)
    lake.write_bronze(products, "products", ctx)
    seen = {}
    whole = ingest.classify
    monkeypatch.setattr(ingest, "classify", lambda *a, **refs: seen.update(refs) or whole(*a, **refs))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 1000)
    folder = str(tmp_path / "files")
    _logs(raw).coalesce(1).drop("row_index").write.option("header", "true").csv(folder)
    files = [r[0] for r in spark.read.format("binaryFile").load(folder).select("path").collect()]
    ingest.process_batch(lake, ctx, files, 0, folder)
    assert seen["users_fit"] and seen["products_fit"]
    assert [r.row_index for r in lake.read_bronze("weblogs", ctx).collect()] == [0]
