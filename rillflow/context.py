"""Identity of one pipeline run, fixed on the driver and used as literals in every plan."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    run_id: str
    run_date: date
    run_ts: datetime

    @classmethod
    def new(cls) -> RunContext:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        return cls(str(uuid.uuid4()), now.date(), now)

    def id_col(self) -> Column:
        return F.lit(self.run_id)

    def date_col(self) -> Column:
        return F.lit(self.run_date.isoformat()).cast("date")

    def ts_col(self) -> Column:
        return F.lit(self.run_ts.isoformat(sep=" ")).cast("timestamp_ntz")
