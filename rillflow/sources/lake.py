"""Layer layout on any file system Spark can write to.

``<root>/bronze/<source>/ingest_date=D/etl_run_id=R/part_id=N/attempt=A``
``<root>/quarantine/source=S/etl_run_date=D/etl_run_id=R/part_id=N/attempt=A``
``<root>/silver/<dataset>/etl_run_date=D[/etl_run_id=R]/attempt=A``
``<root>/gold/<dimension>/version=V`` and ``<root>/gold/<fact or aggregate>/etl_run_date=D``

Bronze, quarantine and Silver are written to a fresh folder, which counts once it is listed
(``commits``): no write deletes what readers see, and runs of one day stay apart.  ``vacuum`` deletes
what has been replaced.  A dimension gets a new version folder per load; ``gold/_versions/name=T``
lists the finished ones, and readers take the newest of these.  ``_runs`` lists the runs whose
Silver logs are whole, and those that each Gold table has.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.context import RunContext
from rillflow.operators import moments
from rillflow.schemas import BRONZE, GOLD, METRICS, QUARANTINE, REPORT, RUNS, SILVER, SILVER_PARTITIONS, table
from rillflow.session import remove, together
from rillflow.sources.commits import Commits
from rillflow.sources.csvfiles import CSV_OPTIONS

_FORMAT_OPTIONS = {
    "parquet": {},
    "csv": {
        **CSV_OPTIONS,
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "nullValue": "\\N",
        "emptyValue": "",
    },
}
#: Gold columns whose moments are noted with each load.
MEASURED = {"agg_session_metrics": "session_duration_s"}
_MOMENTS = table("n long, mean double, m2 double")
_VERSIONS = table("version long, etl_run_id string")
_COMMITTED = ("bronze", "quarantine", "silver")
_PART = T.StructField("part_id", T.LongType(), True)


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    fmt: str = "parquet"

    # layout -------------------------------------------------------------------------------
    def path(self, layer: str, dataset: str | None = None, **parts: object) -> str:
        steps = [self.root.rstrip("/"), layer] + ([dataset] if dataset else [])
        return "/".join(steps + [f"{k}={v}" for k, v in parts.items()])

    def _write(self, df: DataFrame, path: str, mode: str, *, by=(), counts=None) -> dict[str, int]:
        """Write and return the row count, with any further totals, from the same pass."""
        seen = Observation()
        totals: dict[str, Column] = {"rows": F.count(F.lit(1)), **(counts or {})}
        df = df.observe(seen, *[c.alias(n) for n, c in totals.items()])
        if "_change" in df.columns:
            df = df.drop("_change")
        writer = df.write.format(self.fmt).options(**_FORMAT_OPTIONS[self.fmt]).mode(mode)
        (writer.partitionBy(*by) if by else writer).save(path)
        return {n: v if isinstance(v, float) else int(v or 0) for n, v in seen.get.items()}

    def _read(self, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**_FORMAT_OPTIONS[self.fmt])
        if base:
            reader = reader.option("basePath", base)
        try:
            return reader.schema(schema).load(path)
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    # writes that count once they are listed ------------------------------------------------
    @property
    def commits(self) -> Commits:
        return Commits(self.spark, self.root.rstrip("/"))

    def _commit(
        self, df: DataFrame, layer: str, dataset: str, ctx: RunContext, unit: str, folder: str, counts=None
    ) -> dict[str, int]:
        target = self.commits.fresh(folder)
        out = self._write(df, target, "errorifexists", counts=counts)
        self.commits.add(layer, dataset, ctx.run_date, unit, ctx.run_id, target)
        return out

    def _read_live(self, folders: list[str], schema: T.StructType, base: str) -> DataFrame:
        """Listed folders; their partition columns come from their names below ``base``."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format(self.fmt).options(**_FORMAT_OPTIONS[self.fmt])
        return reader.option("basePath", base).schema(schema).load(folders)

    def vacuum(self, *layers: str) -> int:
        """Delete folders that a later write has replaced; no reader may be at them any more."""
        old = [f for layer in layers or _COMMITTED for f in self.commits.superseded(layer)]
        for folder in old:
            remove(self.spark, folder)
        return len(old)

    # bronze and quarantine ----------------------------------------------------------------
    def write_bronze(
        self, clean: DataFrame, source: str, ctx: RunContext, *, part_id: int | None = None,
        counts: dict[str, Column] | None = None,
    ) -> dict[str, int]:
        """A batch load takes the place of the day's last one; each part of a stream is its own."""
        unit = "batch" if part_id is None else f"{ctx.run_id}/{part_id}"
        folder = self.path(
            "bronze", source, ingest_date=ctx.run_date, etl_run_id=ctx.run_id, part_id=part_id or 0
        )
        return self._commit(clean, "bronze", source, ctx, unit, folder, counts)

    def read_bronze(self, source: str, ctx: RunContext, *, own: bool = False) -> DataFrame:
        """The day of the run: its last batch load and all parts of streams; ``own``: this run's alone."""
        folders = self.commits.live("bronze", source, ctx.run_date, ctx.run_id if own else None)
        schema = T.StructType(BRONZE[source].fields + [_PART])
        return self._read_live(folders, schema, self.path("bronze", source)).select(*BRONZE[source].names)

    def quarantine_path(self, source: str, ctx: RunContext) -> str:
        return self.path(
            "quarantine", source=source, etl_run_date=ctx.run_date, etl_run_id=ctx.run_id
        )

    def write_quarantine(
        self, records: DataFrame, source: str, ctx: RunContext, *, part_id: int = 0,
        counts: dict[str, Column] | None = None,
    ) -> dict[str, int]:
        records = records.drop("etl_run_date", "etl_run_id")
        folder = f"{self.quarantine_path(source, ctx)}/part_id={part_id}"
        return self._commit(records, "quarantine", source, ctx, f"{ctx.run_id}/{part_id}", folder, counts)

    def read_quarantine(self) -> DataFrame:
        """All quarantine records with their ``source``; filters on it, date and run prune."""
        schema = T.StructType(
            [T.StructField("source", T.StringType(), True)] + QUARANTINE.fields + [_PART]
        )
        folders = self.commits.live("quarantine")
        return self._read_live(folders, schema, self.path("quarantine")).select("source", *QUARANTINE.names)

    # stream state -------------------------------------------------------------------------
    def write_batch_metrics(self, rows: DataFrame, ctx: RunContext, part_id: int) -> None:
        path = self.path("stream", "metrics", etl_run_id=ctx.run_id, part_id=part_id)
        rows.coalesce(1).write.mode("overwrite").parquet(path)

    def read_batch_metrics(self, ctx: RunContext, before: int | None = None) -> DataFrame:
        """Counters of the micro-batches of a run, or of those before one, summed up."""
        path = self.path("stream", "metrics", etl_run_id=ctx.run_id)
        rows = Lake(self.spark, self.root)._read(path, T.StructType(METRICS.fields + [_PART]))
        if before is not None:
            rows = rows.where(F.col("part_id") < before)
        return rows.groupBy("kind", "layer", "name", "detail").agg(F.sum("value").alias("value"))

    # silver -------------------------------------------------------------------------------
    def write_silver(
        self, df: DataFrame, dataset: str, ctx: RunContext, *, counts: dict[str, Column] | None = None
    ) -> dict[str, int]:
        if dataset not in SILVER:
            raise ValueError(f"Unknown silver dataset: {dataset!r}")
        values = {"etl_run_date": ctx.run_date, "etl_run_id": ctx.run_id}
        parts = {k: values[k] for k in SILVER_PARTITIONS[dataset]}
        unit = "/".join(str(v) for v in parts.values())
        return self._commit(
            df.drop(*parts), "silver", dataset, ctx, unit, self.path("silver", dataset, **parts), counts
        )

    def read_silver(self, dataset: str) -> DataFrame:
        """All runs; a filter on the run date or id prunes to its folders."""
        folders = self.commits.live("silver", dataset)
        return self._read_live(folders, SILVER[dataset], self.path("silver", dataset)).select(
            *SILVER[dataset].names
        )

    # run list -----------------------------------------------------------------------------
    def note_run(
        self, stage: str, run_id: str, run_date: date, run_ts: datetime, content: str
    ) -> None:
        """List a run whose Silver logs are whole (``silver``) or in a Gold table (its name)."""
        entry = self.spark.createDataFrame([(run_id, run_date, run_ts, content, stage)], RUNS)
        # a run that writes its Silver logs again replaces its entry
        own = stage == "silver"
        path = self.path("_runs", stage=f"silver-{run_date}-{run_id}" if own else stage)
        entry.drop("stage").coalesce(1).write.mode("overwrite" if own else "append").parquet(path)

    def read_runs(self) -> DataFrame:
        return Lake(self.spark, self.root)._read(self.path("_runs"), RUNS)

    def silver_runs(self) -> DataFrame:
        """Runs with whole Silver logs; of runs with the same logs the first one."""
        whole = self.read_runs().where(F.col("stage").startswith("silver-")).drop("stage")
        first = F.row_number().over(Window.partitionBy("content").orderBy("run_ts", "etl_run_id"))
        return whole.withColumn("_n", first).where("_n = 1").drop("_n")

    def pending_runs(self, table: str) -> list[Row]:
        """Runs whose logs no run has loaded into a Gold table, oldest first."""
        done = self.read_runs().where(F.col("stage") == table).select("content")
        return self.silver_runs().join(done, "content", "left_anti").orderBy("run_ts", "etl_run_id").collect()

    # gold ---------------------------------------------------------------------------------
    def init_gold(self, ctx: RunContext) -> None:
        """Empty Gold tables; wipes what is there."""

        def reset(name: str) -> None:
            empty = self.spark.createDataFrame([], GOLD[name])
            if name.startswith("dim_"):
                none = self.spark.createDataFrame([], _VERSIONS)
                self._write(none, self.path("gold", "_versions", name=name), "overwrite")
                self.write_dim(empty, name, ctx)
            else:
                none = self.spark.createDataFrame([], RUNS).drop("stage")
                none.write.mode("overwrite").parquet(self.path("_runs", stage=name))
                if name in MEASURED:
                    none = self.spark.createDataFrame([], _MOMENTS)
                    none.write.mode("overwrite").parquet(self.path("_moments", name=name))
                kept = empty if name == "etl_audit_log" else empty.drop("etl_run_date")
                self._write(kept, self.path("gold", name), "overwrite")

        together(*[partial(reset, name) for name in GOLD])

    def newest_version(self, name: str) -> int | None:
        done = self._read(self.path("gold", "_versions", name=name), _VERSIONS)
        return done.agg(F.max("version")).first()[0]

    def write_dim(
        self, df: DataFrame, name: str, ctx: RunContext, *, counts: dict[str, Column] | None = None
    ) -> dict[str, int]:
        """Write the next version, then list it as finished."""
        version = (self.newest_version(name) or 0) + 1
        out = self._write(df, self.path("gold", name, version=version), "overwrite", counts=counts)
        entry = self.spark.createDataFrame([(version, ctx.run_id)], _VERSIONS)
        self._write(entry.coalesce(1), self.path("gold", "_versions", name=name), "append")
        return out

    def read_dim(self, name: str) -> DataFrame:
        version = self.newest_version(name)
        if version is None:
            return self.spark.createDataFrame([], GOLD[name])
        return self._read(self.path("gold", name, version=version), GOLD[name])

    def append_gold(self, df: DataFrame, name: str, *, sort: list[str]) -> dict[str, int]:
        """Append by load date, sorted inside each file so that min/max skipping works."""
        return self._load_gold(df, name, sort, "append")

    def overwrite_gold(self, df: DataFrame, name: str, *, sort: list[str]) -> dict[str, int]:
        """Replace all days; ``df`` must not read this table."""
        return self._load_gold(df, name, sort, "overwrite")

    def _load_gold(self, df: DataFrame, name: str, sort: list[str], mode: str) -> dict[str, int]:
        df = df.select(*GOLD[name].names).sortWithinPartitions("etl_run_date", *sort)
        measured = moments.columns(MEASURED[name]) if name in MEASURED else None
        out = self._write(df, self.path("gold", name), mode, by=["etl_run_date"], counts=measured)
        if measured:
            part = self.spark.createDataFrame([(out["n"], out["mean"], out["m2"])], _MOMENTS)
            part.coalesce(1).write.mode(mode).parquet(self.path("_moments", name=name))
        return out

    def gold_moments(self, name: str) -> moments.Moments:
        """Moments of the table's measured column, merged from those of its loads.

        A load that stopped between its rows and its note left the table with more rows than were
        noted (a count from file footers tells); then the moments are taken from the table again.
        """
        noted = Lake(self.spark, self.root)._read(self.path("_moments", name=name), _MOMENTS)
        merged = moments.merge(moments.Moments(*r) for r in noted.collect())  # a row per load
        rows = self.read_gold(name)
        if merged.n == rows.where(F.col(MEASURED[name]).isNotNull()).count():
            return merged
        return moments.moments(rows, MEASURED[name])

    def replace_gold_day(self, df: DataFrame, name: str, ctx: RunContext) -> dict[str, int]:
        day = self.path("gold", name, etl_run_date=ctx.run_date)
        return self._write(df.drop("etl_run_date"), day, "overwrite")

    def append_audit(self, rows: DataFrame) -> dict[str, int]:
        return self._write(rows, self.path("gold", "etl_audit_log"), "append")

    def read_gold(self, name: str) -> DataFrame:
        return self._read(self.path("gold", name), GOLD[name]).select(*GOLD[name].names)

    def write_report(self, rows: DataFrame, ctx: RunContext) -> dict[str, int]:
        path = self.path("reports", etl_run_date=ctx.run_date, etl_run_id=ctx.run_id)
        return self._write(rows.drop("etl_run_date", "etl_run_id"), path, "overwrite")

    def read_report(self, ctx: RunContext | None = None) -> DataFrame:
        """The report of one run, or the history of all of them."""
        rows = self._read(self.path("reports"), REPORT).select(*REPORT.names)
        if ctx is None:
            return rows
        mine = (F.col("etl_run_date") == ctx.date_col()) & (F.col("etl_run_id") == ctx.run_id)
        return rows.where(mine).orderBy("section", "rank")

    def export(self, ctx: RunContext) -> None:
        """Plain snapshot of the Gold tables for outside readers."""
        for name in GOLD:
            df = self.read_dim(name) if name.startswith("dim_") else self.read_gold(name)
            self._write(df, self.path("export", name), "overwrite")

    # inventory ----------------------------------------------------------------------------
    def inventory(self, layer: str, dataset: str | None = None) -> DataFrame:
        """``file_path, rows`` of every file of a layer that counts; empty when there is none."""
        files = self._files(layer, dataset)
        if files is None:
            return self.spark.createDataFrame([], table("file_path string, rows long"))
        return files.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
            F.count(F.lit(1)).alias("rows")
        )

    def exists(self, layer: str, dataset: str | None = None) -> bool:
        files = self._files(layer, dataset)
        return files is not None and not files.isEmpty()

    def _files(self, layer: str, dataset: str | None) -> DataFrame | None:
        paths = self.commits.live(layer, dataset) if layer in _COMMITTED else [self.path(layer, dataset)]
        if not paths:
            return None
        reader = self.spark.read.format(self.fmt).options(**_FORMAT_OPTIONS[self.fmt])
        try:
            return reader.option("recursiveFileLookup", "true").load(paths)
        except AnalysisException as err:
            if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None
