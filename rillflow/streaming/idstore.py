"""Ids that earlier micro-batches have brought, kept by hash bucket.

A batch adds a part: its ids, in ``BUCKETS`` folders by hash, sorted.  To find which of its ids are
known, a batch reads its own buckets of the earlier parts and keeps what it has itself: its ids are
the small side, so the store does not move.  Parts of equal size are merged ``FAN`` at a time, so a
store of n parts has at most ``FAN`` parts of each size and each id is written anew log n times.

Parts and merged parts count once they are listed (``commits``); a part that a larger one contains is
not read.  A batch never sees its own part, nor one that holds it: a replay gives the same result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.context import RunContext
from rillflow.operators.joins import fits_broadcast
from rillflow.schemas import table
from rillflow.session import pin, remove
from rillflow.sources.lake import Lake

BUCKETS, FAN = 64, 8
_IDS = table("log_id long, bucket int")


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class IdStore:
    lake: Lake
    ctx: RunContext

    @property
    def root(self) -> str:
        return self.lake.path("stream", "seen_log_ids", etl_run_id=self.ctx.run_id)

    def parts(self) -> list[tuple[int, int, str]]:
        """``(first batch, last batch, folder)`` of the largest parts that are listed."""
        every = []
        for folder in self.lake.commits.live("seen", self.ctx.run_id):
            low, high = re.search(r"batches=(\d+)-(\d+)", folder).groups()
            every.append((int(low), int(high), folder))
        return sorted(p for p in every if not any(q[0] <= p[0] and p[1] <= q[1] and q[:2] != p[:2] for q in every))

    def ids_of(self, rows: DataFrame) -> DataFrame:
        """The distinct ids of a batch with their buckets, written once: ``known`` and ``add`` both read them."""
        if "bucket" in rows.columns:
            return rows
        ids = rows.select("log_id").where(F.col("log_id").isNotNull()).distinct()
        return pin(ids.withColumn("bucket", bucket_of("log_id")))

    def add(self, ids: DataFrame, batch_id: int) -> None:
        self._write(self.ids_of(ids), batch_id, batch_id)

    def known(self, ids: DataFrame, batch_id: int) -> DataFrame | None:
        """Which of ``ids`` (``log_id``) earlier batches had; None if there are no earlier ones."""
        earlier = [folder for low, high, folder in self.parts() if high < batch_id]
        if not earlier:
            return None
        ids = self.ids_of(ids)
        buckets = [r[0] for r in ids.select("bucket").distinct().collect()]  # at most BUCKETS
        stored = self._read(earlier).where(F.col("bucket").isin(buckets))
        wanted = F.broadcast(ids) if fits_broadcast(ids) else ids
        return stored.join(wanted, ["bucket", "log_id"], "left_semi").select("log_id").distinct()

    def merge(self, before: int) -> None:
        """Merge parts of batches before the given one, smallest first, and drop what they replace."""
        while True:
            done = [p for p in self.parts() if p[1] < before]
            sizes = [high - low + 1 for low, high, _ in done]
            run = next(
                (done[i : i + FAN] for i in range(len(done) - FAN + 1) if len(set(sizes[i : i + FAN])) == 1), None
            )
            if run is None:
                return
            self._write(self._read([f for *_, f in run]), run[0][0], run[-1][1])
            for *_, folder in run:
                remove(self.lake.spark, folder)

    def _write(self, ids: DataFrame, low: int, high: int) -> None:
        """Sorted by bucket and id over range partitions: a large bucket is written by several tasks."""
        folder = self.lake.commits.fresh(f"{self.root}/batches={low}-{high}")
        dealt = ids.repartitionByRange("bucket", "log_id").sortWithinPartitions("bucket", "log_id")
        dealt.write.partitionBy("bucket").parquet(folder)
        self.lake.commits.add("seen", self.ctx.run_id, self.ctx.run_date, f"{low}-{high}", self.ctx.run_id, folder)

    def _read(self, folders: list[str]) -> DataFrame:
        reader = self.lake.spark.read.schema(_IDS)
        parts = [reader.option("basePath", f).parquet(f) for f in folders]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionByName(more)
        return out
