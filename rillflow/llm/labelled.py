"""Bounded samples of labelled rows, from which the classifiers learn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def training_sample(labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """``doc_id, label, part``: at most ``bound`` training documents of either class.

    Chosen by a hash of the id, so the same on every run.  ``part`` (0 to 99) is another hash, to
    set rows apart for calibration.  Rows without an id or label are left out, repeated ids count
    once (as labelled 1 if any row says so).
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    sides = [
        known.where(F.col("label") == side).orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(bound)
        for side in (0, 1)
    ]
    part = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(100)).cast("int")
    return sides[0].unionByName(sides[1]).withColumn("part", part)
