"""Key lookups that hold when one key, or NULL, has a large share of all rows.

``lookup`` joins a big frame to a table with unique keys.  The table is broadcast only after
its size was measured.  Beyond that bound the join shuffles, and two things are spread over
all reducers with a second join column, ``_slice``:

* rows with a NULL key, which match nothing, and
* rows of a hot key, one that holds more than an even reducer's share of the rows.  Fewer keys
  than reducers can be hot, so the table of hot keys is bounded and safe to broadcast, and
  copying their rows of the small side once per slice adds less than two rows per reducer.

``_slice`` comes from the row's own columns, so a task that runs again places rows as before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.session import pin, reducers

BROADCAST_BYTES = 64 << 20


def total_bytes(schema: T.StructType) -> Column:
    """Aggregate: 8 bytes per cell plus the exact length of all text."""
    per_row = F.lit(8 * len(schema.fields))
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.sum(per_row.cast("bigint"))


def measured_bytes(df: DataFrame) -> int:
    return int(df.agg(total_bytes(df.schema)).first()[0] or 0)


def within_limit(size: int, limit: int | None = None) -> bool:
    return size <= (BROADCAST_BYTES if limit is None else limit)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return within_limit(measured_bytes(df), limit)


def pairs_fit(rows: int) -> bool:
    """Whether this many ids, each with one more number, may be broadcast."""
    return within_limit(16 * rows)


Hot = list[tuple[object, int]]


def hot_keys(df: DataFrame, key: str, parts: int) -> Hot:
    """``(key, slices)`` of the keys that hold more than 1/parts of the non-null rows.

    Fewer than ``parts`` keys can, so the ``parts`` most frequent ones include them all.  One
    pass over the key column gives these and, observed on the way, the total.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    seen = Observation()
    top = most_frequent(counts.observe(seen, F.sum("_n").alias("total")), parts)
    return slices(top, seen.get["total"] or 0, parts)


def frequent_keys(df: DataFrame, keys: list[str]) -> dict[str, Hot]:
    """Hot keys of several long columns in one pass, by mergeable sketches of frequent items.

    A sketch tracks eight times as many items as there are reducers, so one that holds more than an
    even share of the rows is in it; its count is near enough to deal out slices.
    """
    parts = reducers(df.sparkSession)
    found = df.agg(
        *[F.expr(f"approx_top_k({k}, {min(parts, 100_000)}, {max(1024, 8 * parts)})").alias(k) for k in keys],
        *[F.count(k).alias(f"{k}_n") for k in keys],
    ).first()
    return {k: slices([(r["item"], r["count"]) for r in found[k]], found[f"{k}_n"], parts) for k in keys}


def most_frequent(counts: DataFrame, parts: int) -> Hot:
    """The ``parts`` largest counts of a ``(key, _n)`` frame."""
    return [tuple(r) for r in counts.orderBy(F.desc("_n")).limit(parts).collect()]


def slices(top: Hot, total: int, parts: int) -> Hot:
    return [(key, math.ceil(n * parts / total)) for key, n in top if n * parts > total]


def spread(
    big: DataFrame, small: DataFrame, key: str, row_id: str, parts: int, hot: Hot
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_slice`` added, ready for an equi-join on ``(key, _slice)``."""
    lane = F.xxhash64(row_id)
    slice_of_null = F.when(F.col(key).isNull(), F.pmod(lane, F.lit(parts)))
    if not hot:
        big = big.withColumn("_slice", F.coalesce(slice_of_null, F.lit(0)).cast("int"))
        # Always 0, but not a literal: a literal would be folded out of the join keys, and with it
        # the spreading of NULL keys.
        return big, small.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    schema = T.StructType(
        [T.StructField(key, big.schema[key].dataType), T.StructField("_slices", T.IntegerType())]
    )
    table = F.broadcast(big.sparkSession.createDataFrame(hot, schema))  # fewer rows than parts
    big = (
        big.join(table, key, "left")
        .withColumn(
            "_slice",
            slice_of_null.when(F.col("_slices").isNotNull(), F.pmod(lane, F.col("_slices")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop("_slices")
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1)
    small = small.join(table, key, "left").withColumn("_slice", F.explode(copies)).drop("_slices")
    return big, small


def lookup(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "left",
    *,
    row_id: str = "row_index",
    small_fits: bool | None = None,
    count_on: DataFrame | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Join ``big`` to the unique-key table ``small``; ``row_id`` must differ from row to row.

    ``hot`` gives the hot keys where they are known.  Else they are counted on ``count_on``, a
    cheaper frame with at least as many rows per key, such as the scan below ``big``; no reducer
    then gets more than an even share of that frame from one key.
    """
    if small_fits is None:
        small_fits = fits_broadcast(small)
    if small_fits:
        return big.join(F.broadcast(small), key, how)
    parts = reducers(big.sparkSession)
    if hot is None:
        hot = hot_keys(big if count_on is None else count_on, key, parts)
    big, small = spread(big, small, key, row_id, parts, hot)
    return big.join(small, [key, "_slice"], how).drop("_slice")


def already_in(history: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``new`` that ``history`` has.

    The keys of the new rows are the small side: while they fit, the history is read in one column
    and does not move.  Both sides are measured before they are joined, so the keys and the result
    are written once: what is below them runs once, however deep its plan is.
    """
    wanted = pin(new.select(key).where(F.col(key).isNotNull()).distinct())
    done = history.select(key)
    if fits_broadcast(wanted):
        return pin(done.join(F.broadcast(wanted), key, "left_semi").distinct())
    return pin(done.distinct().join(wanted, key, "left_semi"))
