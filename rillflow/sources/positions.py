"""Dense row positions over many files without moving rows.

A scan writes its rows once, with two numbers each: ``_at``, which grows along each file block and is
fixed from then on, and ``_key``, a 64-bit hash of file and block.  Counts per block, added up in the
order of path and offset, give each block the shift from ``_at`` to the position.  The table of shifts
has 16 bytes a block and is broadcast up to some millions of blocks, hundreds of terabytes of text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from rillflow.operators.joins import lookup, within_limit
from rillflow.session import pin

#: Kept between the numbers of two scans that are read as one.
SCAN_STRIDE = 1 << 61


def with_block(source: DataFrame, *columns: Column) -> DataFrame:
    """Columns of a file scan with the file and block that each row comes from."""
    return source.select(
        *columns,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def stage(rows: DataFrame, path: str, nth_scan: int = 0, **totals: Column) -> dict[str, int]:
    """Write rows with their place; returns their number (``rows``) and further totals of the same pass."""
    seen = Observation()
    rows = rows.withColumns(
        {
            "_at": F.monotonically_increasing_id() + F.lit(nth_scan * SCAN_STRIDE),
            "_key": F.xxhash64("_file", "_block"),
        }
    )
    rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in totals.items()])
    rows.write.mode("overwrite").parquet(path)
    return {n: int(v or 0) for n, v in seen.get.items()}


def blocks_of(staged: DataFrame, **totals: Column) -> DataFrame:
    """``_file, _block, _key, _rows, _base`` of each block, with further totals; written once."""
    blocks = staged.groupBy("_file", "_block", "_key").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("_at").alias("_base"),
        *[c.alias(n) for n, c in totals.items()],
    )
    return pin(blocks)


def count_blocks(blocks: DataFrame) -> tuple[int, int]:
    """Number of blocks and of their rows.

    Two blocks of one key would mix their positions; among a million it happens once in 40 million runs.
    """
    n, keys, rows = blocks.agg(F.count(F.lit(1)), F.count_distinct("_key"), F.sum("_rows")).first()
    if n != keys:
        raise RuntimeError("two file blocks have the same hash; read the files in two folders")
    return n, rows or 0


def shifts(blocks: DataFrame, skipped: Column | None = None, start: int = 0) -> Column:
    """From ``_at`` to the position, for each block; ``skipped``: rows at its head that get none."""
    skipped = F.lit(0) if skipped is None else skipped
    # One row per file block, so this window stays small.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(F.col("_rows") - skipped).over(before), F.lit(0))
    return upto - F.col("_base") - skipped + F.lit(start)


def number_rows(staged: DataFrame, columns: list[str], start: int = 0) -> DataFrame:
    """Staged rows with ``row_index`` from ``start`` on, blocks in order of path and offset."""
    blocks = blocks_of(staged)
    n, _ = count_blocks(blocks)
    table = blocks.select("_key", shifts(blocks, start=start).alias("_shift"))
    numbered = lookup(staged, table, "_key", row_id="_at", small_fits=within_limit(16 * n))
    return numbered.select((F.col("_at") + F.col("_shift")).alias("row_index"), *columns)
