"""Session totals from a stream of logs: closed sessions, open ones and late logs, none of them lost.

A session is a run of logs of one id with less than ``gap`` between neighbours.  Its totals are
mergeable, so the state between micro-batches is a table of the open sessions' totals.  A batch sums
up its own logs, merges them with the open sessions that the batch before left, and writes

* ``closed``: sessions that no log in time can extend any more,
* ``open``: the rest, the state that the next batch starts from,
* ``late``: logs older than the watermark, as they came,
* ``horizon``: the newest event time so far; written last, it makes the batch count.

The watermark is that newest event time of the batches before, less ``lateness``.  A session is
closed once its end plus ``gap`` is not after the new watermark, so a log that is not late can never
belong to a closed session.  Closed and open sessions together are exactly the sessions of all logs
that were not late, in whatever batches they came; ``reconciled`` merges the late ones in as well.

Each output has a folder per batch.  A batch that runs again reads what the one before it left and
overwrites its own folders.  Only open sessions are rewritten, whose number the watermark bounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillflow.functions.scalars import as_utc
from rillflow.schemas import SILVER, table
from rillflow.session import remove

TOTALS = table(
    "session_id string, session_start ntz, session_end ntz, total_views long, "
    "total_cart_adds long, total_purchases long, total_rows long"
)
_ACTIONS = (("view", "total_views"), ("add_to_cart", "total_cart_adds"), ("purchase", "total_purchases"))
_HORIZON = table("newest ntz, batch long")
_BATCH = T.StructField("batch", T.LongType(), True)


def session_totals(logs: DataFrame, gap: str, lateness: str = "0 seconds") -> DataFrame:
    """Totals of each session of a batch; of a stream those that Spark's own watermark closes."""
    # Watermarks need an instant; this one is the zone-free time read as UTC, in any session zone.
    logs = logs.withColumn("event_time", as_utc("action_ts"))
    if logs.isStreaming:
        logs = logs.withWatermark("event_time", lateness)
    span = F.session_window("event_time", gap)
    return (
        logs.where(F.col("session_id").isNotNull())
        .groupBy("session_id", span)
        .agg(
            F.min("action_ts").alias("session_start"),
            F.max("action_ts").alias("session_end"),
            *[F.sum(F.when(F.col("action") == a, 1).otherwise(0)).alias(name) for a, name in _ACTIONS],
            F.count(F.lit(1)).alias("total_rows"),
        )
        .select(*TOTALS.names)
    )


def merge_totals(parts: DataFrame, gap: str) -> DataFrame:
    """Totals of sessions out of totals of parts of them, in one shuffle by id."""
    in_order = Window.partitionBy("session_id").orderBy("session_start", "session_end")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("session_end").over(before)
    new = reach.isNull() | (F.col("session_start") > _later(reach, gap))
    numbered = parts.withColumn("_new", new.cast("int")).withColumn("_nth", F.sum("_new").over(in_order))
    sums = [F.sum(c).alias(c) for c in TOTALS.names[3:]]
    return (
        numbered.groupBy("session_id", "_nth")
        .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), *sums)
        .select(*TOTALS.names)
    )


def _later(ts: Column, by: str) -> Column:
    return ts + F.expr(f"INTERVAL {by}")


@dataclass(frozen=True)
class SessionStream:
    """The outputs of one stream below ``root``."""

    spark: SparkSession
    root: str
    gap: str = "1 day"
    lateness: str = "1 day"

    # outputs ------------------------------------------------------------------------------
    def closed(self) -> DataFrame:
        return self._output("closed", TOTALS).drop("batch")

    def open(self) -> DataFrame:
        last = self._done()[0]
        return self._output("open", TOTALS).where(F.col("batch") == F.lit(last)).drop("batch")

    def late(self) -> DataFrame:
        """The late logs, with the batch that brought them."""
        return self._output("late", SILVER["weblogs_clean"])

    def totals(self) -> DataFrame:
        """Closed and open sessions: all sessions of the logs that came in time."""
        return self.closed().unionByName(self.open())

    def reconciled(self) -> DataFrame:
        """All sessions with the late logs merged in, as one batch over all logs gives them."""
        late = session_totals(self.late(), self.gap)
        return merge_totals(self.totals().unionByName(late), self.gap)

    # batches ------------------------------------------------------------------------------
    def process_batch(self, logs: DataFrame, batch_id: int) -> None:
        """``logs``: Silver logs; a null time or id belongs to no session and is left out."""
        last, newest = self._done(batch_id)
        logs = logs.where(F.col("session_id").isNotNull() & F.col("action_ts").isNotNull())
        mark = self._watermark(newest)
        behind = F.coalesce(F.col("action_ts") < mark, F.lit(False))
        self._write(logs.where(behind).select(*SILVER["weblogs_clean"].names), "late", batch_id)
        came = logs.agg(F.max("action_ts")).first()[0]
        newest = max((ts for ts in (newest, came) if ts is not None), default=None)
        fresh = session_totals(logs.where(~behind), self.gap)
        if last is not None:
            state = self._output("open", TOTALS, batch_id).where(F.col("batch") == F.lit(last)).drop("batch")
            fresh = merge_totals(fresh.unionByName(state), self.gap)
        # both outputs in one write, so that the merge runs once
        done = _later(F.col("session_end"), self.gap) < self._watermark(newest)
        state = F.when(F.coalesce(done, F.lit(False)), F.lit("closed")).otherwise(F.lit("open"))
        both = f"{self.root}/merged/batch={batch_id}"
        fresh.withColumn("state", state).write.mode("overwrite").partitionBy("state").parquet(both)
        mine = self.spark.createDataFrame([(newest,)], table("newest ntz"))
        self._write(mine.coalesce(1), "horizon", batch_id)
        older = None if last is None else self._done(last)[0]
        if older is not None:  # the state of the batch before stays for a replay of this one
            remove(self.spark, f"{self.root}/merged/batch={older}/state=open")

    def start(
        self, source: str, trigger: dict | None = None, files_per_batch: int | None = None
    ) -> StreamingQuery:
        """Start over a folder of Silver logs; ``trigger`` as ``DataStreamWriter.trigger`` takes it."""
        reader = self.spark.readStream.schema(SILVER["weblogs_clean"]).format("parquet")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return (
            reader.load(source)
            .writeStream.foreachBatch(self.process_batch)
            .option("checkpointLocation", f"{self.root}/progress")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )

    def run_available(self, source: str, **options) -> None:
        """Take in the files that are there and return."""
        self.start(source, **options).awaitTermination()

    # folders ------------------------------------------------------------------------------
    def _write(self, df: DataFrame, output: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{output}/batch={batch_id}")

    def _read(self, output: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{output}")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _output(self, output: str, schema: T.StructType, before: int | None = None) -> DataFrame:
        """Rows of the batches that count."""
        done = self._done(before)[0]
        named = T.StructType(schema.fields + [_BATCH])
        if output in ("closed", "open"):
            parts = T.StructType(named.fields + [T.StructField("state", T.StringType(), True)])
            rows = self._read("merged", parts).where(F.col("state") == output).drop("state")
        else:
            rows = self._read(output, named)
        return rows.where(F.col("batch") <= F.lit(-1 if done is None else done))

    def _done(self, before: int | None = None) -> tuple[int | None, datetime | None]:
        """The last batch that counts (before the given one) and the newest event time up to it."""
        done = self._read("horizon", _HORIZON)
        if before is not None:
            done = done.where(F.col("batch") < before)
        return tuple(done.agg(F.max("batch"), F.max("newest")).first())

    def _watermark(self, newest: datetime | None) -> Column:
        return _ntz(newest) - F.expr(f"INTERVAL {self.lateness}")


def _ntz(ts: datetime | None) -> Column:
    return F.lit(None if ts is None else ts.isoformat(sep=" ")).cast("timestamp_ntz")


def run_available(
    spark: SparkSession, source: str, out: str, *, gap: str = "1 day", lateness: str = "1 day"
) -> DataFrame:
    """Take in the files that are there; the sessions so far, open ones included."""
    stream = SessionStream(spark, out, gap, lateness)
    stream.run_available(source)
    return stream.totals()
