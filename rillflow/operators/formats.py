"""Timestamps by the format of a chunk's first value, as readers do that guess a format once.

Each chunk of ``chunk_rows`` consecutive positions has the format of its first value that is not
NULL: the same separators and fields, any number of fraction digits, any way to write a zone.  Values
of the chunk in another format are NULL.  Where the first value has no known format there is nothing
to go by, and each value is read by itself.

The first values are one row per chunk, by a map-side combined aggregate; rows do not move while
that table fits a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.scalars import parse_timestamp
from rillflow.operators.joins import lookup


def shape(text: Column) -> Column:
    """The format of a timestamp text: digits as 0, a fraction as ``.0``, a zone as ``z``."""
    bare = F.regexp_replace(text, r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$", "z")
    bare = F.when(F.contains(text, F.lit(":")), bare).otherwise(text)  # a date's last part is no zone
    return F.regexp_replace(F.regexp_replace(bare, "[0-9]", "0"), r"\.0+", ".0")


def parse_by_first_format(
    df: DataFrame, column: str, name: str, *, pos: str = "row_index", chunk_rows: int = 10_000,
    zone: str = "reject",
) -> DataFrame:
    """``df`` with ``name``: the values of a text column as zone-free timestamps."""
    text = F.col(column)
    chunked = df.withColumn("_chunk", F.floor(F.col(pos) / chunk_rows).cast("long"))
    first = (
        chunked.where(text.isNotNull())
        .groupBy("_chunk")
        .agg(F.min_by(column, pos).alias("_first"))
        .select(
            "_chunk",
            F.when(parse_timestamp(F.col("_first"), zone).isNotNull(), shape(F.col("_first"))).alias("_shape"),
        )
    )
    told = lookup(chunked, first, "_chunk", row_id=pos)
    fits = F.col("_shape").isNull() | (shape(text) == F.col("_shape"))
    return told.select(*df.columns, F.when(fits, parse_timestamp(text, zone)).alias(name))
