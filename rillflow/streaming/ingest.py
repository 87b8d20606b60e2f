"""Log files as a stream, with the results of a batch load.

The clean users and products are in Bronze before the stream starts.  Each micro-batch lands as a
table, takes row positions that go on from the batches before, and is classified against the
dimensions and the log ids seen before.  It then writes kept rows, rejected rows, its log ids and
its counters, each to a folder of its own.  A batch that runs again after a failure overwrites its
folders and ignores what it may have noted itself.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.context import RunContext
from rillflow.functions.scalars import to_id
from rillflow.operators.joins import pairs_fit
from rillflow.operators.quality import classify, clean, quarantine
from rillflow.plans.pipeline import reason_totals
from rillflow.schemas import METRICS, RAW_COLUMNS
from rillflow.session import pin
from rillflow.sources.lake import Lake
from rillflow.sources.csvfiles import as_path
from rillflow.sources.tables import land
from rillflow.streaming.idstore import IdStore

#: What a stream of files says of each.
FILES = "path string, modificationTime timestamp, length long, content binary"


def rows_before(lake: Lake, ctx: RunContext, batch_id: int) -> int:
    earlier = lake.read_batch_metrics(ctx, before=batch_id).where("kind = 'extracted'")
    return int(earlier.agg(F.sum("value")).first()[0] or 0)


def process_batch(
    lake: Lake, ctx: RunContext, files: list[str], batch_id: int, source_file: str, fmt: str = "csv"
) -> None:
    """``files``: what came; they are read as in a batch load, by each file's own header."""
    users, products = (lake.read_bronze(s, ctx) for s in ("users", "products"))
    landing = lake.path("stream", "landing", etl_run_id=ctx.run_id, part_id=batch_id)
    first = rows_before(lake, ctx, batch_id)
    arrived, n = land(lake.spark, files, RAW_COLUMNS["weblogs"], fmt=fmt, staging=landing, start=first)
    store, judged = IdStore(lake, ctx), None
    try:
        ids = store.ids_of(arrived.select(to_id(F.col("log_id")).alias("log_id")))
        known = store.known(ids, batch_id)
        judged = classify(
            arrived, "weblogs", users=users, products=products,
            seen=known if known is None else pin(known),  # measured first, then joined
            users_fit=pairs_fit(users.count()), products_fit=pairs_fit(products.count()),
        ).persist(StorageLevel.DISK_ONLY)
        kept = lake.write_bronze(clean(judged, "weblogs"), "weblogs", ctx, part_id=batch_id)
        records = quarantine(judged, "weblogs", source_file, ctx)
        lost = lake.write_quarantine(
            records, "weblogs", ctx, part_id=batch_id, counts=reason_totals("weblogs")
        )
        store.add(ids, batch_id)
        counters = [("extracted", None, "weblogs", None, float(n))]
        counters += [("loaded", "bronze", "weblogs", None, float(kept["rows"]))]
        counters += [
            ("quarantined" if k == "rows" else "reason", None, "weblogs",
             None if k == "rows" else k, float(n))
            for k, n in lost.items()
        ]
        lake.write_batch_metrics(lake.spark.createDataFrame(counters, METRICS), ctx, batch_id)
        store.merge(batch_id)
    finally:
        if judged is not None:
            judged.unpersist()


def start(
    lake: Lake, folder: str, ctx: RunContext, progress: str, *, fmt: str = "csv",
    files_per_batch: int | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream over ``folder``; ``progress`` is its checkpoint.

    ``trigger`` as ``DataStreamWriter.trigger`` takes it; by default the files that are there.
    """
    # one row per new file; its content is not read here
    reader = lake.spark.readStream.schema(FILES).format("binaryFile")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take(batch: DataFrame, batch_id: int) -> None:
        files = [as_path(r[0]) for r in batch.collect()]  # a reader takes names of files
        process_batch(lake, ctx, files, batch_id, folder, fmt)

    return (
        reader.load(folder)
        .select("path")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_available(lake: Lake, folder: str, ctx: RunContext, progress: str, **options) -> None:
    start(lake, folder, ctx, progress, **options).awaitTermination()
