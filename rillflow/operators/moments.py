"""Count, mean and squared deviations of a column as numbers that parts can be merged from.

The threshold of long sessions is the mean plus some deviations over all sessions ever loaded.  Each
load notes its own moments while it writes its rows, so the threshold needs a few numbers per load
instead of a pass over all of them.  Merging takes the squared deviations of the parts and those of
their means from the common one, which loses no digits where a plain sum of squares would.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    n: int = 0
    mean: float = 0.0
    m2: float = 0.0

    def limit(self, std_devs: float) -> float | None:
        """Mean plus ``std_devs`` sample deviations; None where a deviation is not defined."""
        return self.mean + std_devs * math.sqrt(self.m2 / (self.n - 1)) if self.n > 1 else None


def columns(of: str) -> dict[str, Column]:
    """Aggregates that give the moments of a column."""
    return {
        "n": F.count(of),
        "mean": F.coalesce(F.avg(of), F.lit(0.0)),
        "m2": F.coalesce(F.var_pop(of) * F.count(of), F.lit(0.0)),
    }


def moments(df: DataFrame, of: str) -> Moments:
    return Moments(*df.agg(*[c.alias(n) for n, c in columns(of).items()]).first())


def merge(parts: Iterable[Moments]) -> Moments:
    parts = [p for p in parts if p.n]
    n = sum(p.n for p in parts)
    if not n:
        return Moments()
    mean = math.fsum(p.n * p.mean for p in parts) / n
    return Moments(n, mean, math.fsum(p.m2 + p.n * (p.mean - mean) ** 2 for p in parts))
