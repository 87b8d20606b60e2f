"""What several of the text operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, and words as the rest.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors, once per application, as --py-files would."""
    sc = spark.sparkContext
    if getattr(sc, "_rillflow_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / "rillflow_code.zip"  # the driver serves it from here
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._rillflow_shipped = True


def release() -> None:
    """Gives freed memory back to the system: workers live on between tasks, side by side."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(function: Callable) -> Callable:
    """``function`` on the batches of a task, with its freed memory released at the end."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            release()

    return run


def map_pandas(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInPandas(tidy(function), schema)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(tidy(function), schema)


def text_slices(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``size`` bytes of text; a longer text stands alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(batch):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def blank_split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between blanks of all texts one after another, and each text's number of words."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return without_empty(words, sizes)


def without_empty(words: pa.Array, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    empty = pc.equal(words, "")
    if pc.any(empty).as_py():
        gone = empty.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sizes = sizes - np.bincount(owner[gone], minlength=len(sizes))
        words = words.filter(pc.invert(empty))
    return words, sizes


def whole_text(column: str = "text") -> Column:
    """The text, a null one as the empty one."""
    return F.coalesce(F.col(column), F.lit(""))


def quoted(name: str) -> str:
    """A column's name as Spark takes it whole, with dots and backticks."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns in one struct, so that none can clash with a helper column beside it."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns])


def row_key(doc_id: str = "doc_id", text: str = "text", source: str | None = None) -> Column:
    """128-bit key of a row by its id and text (and source); a null id is none of the numbers."""
    parts = [F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))]
    if source is not None:
        parts.append(F.coalesce(F.md5(F.col(source).cast("string").cast("binary")), F.lit("null")))
    return F.md5(F.concat_ws("\x00", *parts, whole_text(text)).cast("binary"))


def words_of(text: Column) -> Column:
    """Array of the words between blanks, in order."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, BLANK_RUN, -1)
    )


def bucket_of_id(column: str, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(parts))


def runs(rows: Iterable, key) -> Iterator[list]:
    """Consecutive rows of one key, one key at a time."""
    held: list = []
    last = None
    for row in rows:
        at = key(row)
        if held and at != last:
            yield held
            held = []
        last = at
        held.append(row)
    if held:
        yield held
