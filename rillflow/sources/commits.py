"""Folders that count: each write goes to a folder of its own and is then listed in one step.

``<root>/_commits/<layer>/dataset=S/day=D`` holds one row per finished write: the unit of data it is
(a run's part of a day, say), its folder and a number that grows.  Of the writes of one unit the
newest counts.  Readers go by the list, so they see the old data until the very moment the new one is
listed, and what a failed write left behind is never read.  ``superseded`` names what may be deleted.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from rillflow.schemas import table

_COMMITS = table("dataset string, day date, unit string, run_id string, seq long, folder string")


@dataclass(frozen=True)
class Commits:
    spark: SparkSession
    root: str

    def fresh(self, folder: str) -> str:
        """A folder below ``folder`` for one write."""
        return f"{folder}/attempt={uuid.uuid4().hex}"

    def add(self, layer: str, dataset: str, day: date, unit: str, run_id: str, folder: str) -> None:
        """List a finished write; from here on it is the one that counts for its unit."""
        last = max((e.seq for e in self._entries(layer, dataset=dataset, day=day)), default=0)
        entry = self.spark.createDataFrame(
            [(unit, run_id, last + 1, folder[len(self.root) :].lstrip("/"))],
            table("unit string, run_id string, seq long, folder string"),
        )
        path = f"{self.root}/_commits/{layer}/dataset={dataset}/day={day.isoformat()}"
        entry.coalesce(1).write.mode("append").parquet(path)

    def live(
        self, layer: str, dataset: str | None = None, day: date | None = None, run_id: str | None = None
    ) -> list[str]:
        """Folders that count, of a day or a run where they are given."""
        return [self._folder(e) for e in self._newest(layer, dataset=dataset, day=day, run_id=run_id)]

    def superseded(self, layer: str) -> list[str]:
        live = {e.folder for e in self._newest(layer)}
        return sorted(self._folder(e) for e in self._entries(layer) if e.folder not in live)

    def _folder(self, entry: Row) -> str:
        return f"{self.root}/{entry.folder}"

    def _newest(self, layer: str, **which: object) -> list[Row]:
        # two writers of one unit at once may take one number; the folder decides then
        newest: dict[tuple, Row] = {}
        for e in sorted(self._entries(layer, **which), key=lambda e: (e.seq, e.folder)):
            newest[e.dataset, e.day, e.unit] = e
        return sorted(newest.values(), key=lambda e: e.folder)

    def _entries(self, layer: str, **which: object) -> list[Row]:
        """A row per finished write; readers need the names of their folders on the driver."""
        try:
            entries = self.spark.read.schema(_COMMITS).parquet(f"{self.root}/_commits/{layer}")
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        for name, value in which.items():
            if value is not None:
                entries = entries.where(F.col(name) == F.lit(value))
        return entries.collect()
