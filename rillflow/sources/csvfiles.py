"""CSV files whose headers differ, whose cells hold line breaks, and whose rows may be broken.

1.  All files are read by place: cells ``c0``, ``c1`` ..., one more than a header has.  A row with
    fewer cells than that comes with its text, which says how many it has and whether its quotes are
    even.  The rows are written once as Parquet with their place (``positions``).
2.  The first row of each file is its header.  It says for each wanted column in which cell that file
    has it, and how many cells a row should have.  This goes into the small table of file blocks, so
    files of any mix of headers are read by one scan and one lookup.
3.  A row with an odd number of quotes was cut at a line break inside a cell.  Only the files that
    have such rows are read again, as whole files.
4.  If a header is wider than the cells read, the scan is repeated with enough of them.

Files without any row are nothing.  Of columns with one name the first one counts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.scalars import blank_na
from rillflow.operators.joins import fits_broadcast, lookup, within_limit
from rillflow.session import pin
from rillflow.sources.positions import blocks_of, count_blocks, shifts, stage, with_block

# Quotes are doubled inside quoted cells, and outer blanks belong to the text.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_PLAIN = {**CSV_OPTIONS, "header": "false"}
# with column pruning the reader would not compare numbers of cells
_BY_PLACE = {**_PLAIN, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record", "columnPruning": "false"}
_CELL = r',(?:"(?:[^"]|"")*"[^,]*|[^,]*)'
Paths = str | list[str]


def _names(width: int) -> list[str]:
    return [f"c{i}" for i in range(width)]


@dataclass(frozen=True)
class CsvRows:
    """Rows of a set of files, staged: ``columns`` by name, and what each row's file says of it."""

    rows: DataFrame  # _index, the columns, _width, _wanted, _record
    n: int
    missing: tuple[str, ...]  # columns that some file does not have

    def text(self, columns: list[str]) -> DataFrame:
        """``row_index`` and the columns, NA words as NULL; a short row's last cells are NULL."""
        return blank_na(self.rows.select(F.col("_index").alias("row_index"), *columns))

    def wrong_width(self) -> Column:
        """Whether a row has another number of cells than its file's header."""
        return F.col("_width") != F.col("_wanted")


def as_path(file: str) -> str:
    """The name of a file as a reader takes it, which would read some characters as patterns."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", file)


def first_width(spark: SparkSession, paths: Paths, options: dict) -> int:
    """Cells of the first row of one of the files, as the reader finds them by itself."""
    return len(spark.read.options(**_PLAIN).options(**options).csv(paths).columns)


def read_cells(spark: SparkSession, paths: Paths, width: int, options: dict) -> DataFrame:
    fields = [T.StructField(n, T.StringType(), True) for n in [*_names(width), "_record"]]
    source = spark.read.schema(T.StructType(fields)).options(**_BY_PLACE).options(**options).csv(paths)
    record = F.col("_record")  # null in a row of exactly ``width`` cells
    count = lambda c: F.length(record) - F.length(F.replace(record, F.lit(c), F.lit("")))
    cells = F.when(F.contains(record, F.lit('"')), F.regexp_count(F.concat(F.lit(","), record), F.lit(_CELL)))
    cells = F.coalesce(cells.otherwise(count(",") + 1), F.lit(width))
    return with_block(
        source,
        *[F.col(n) for n in _names(width)],
        F.when(cells > width, record).alias("_record"),
        cells.alias("_width"),
        F.coalesce(count('"') % 2 == 1, F.lit(False)).alias("_odd"),
    )


def land_csv(
    spark: SparkSession, paths: Paths, columns: list[str], folder: str, *,
    start: int = 0, any_case: bool = False, pattern: str | None = None, width: int | None = None,
) -> CsvRows:
    """Stage the files below ``folder`` and give their rows by column name.

    ``any_case`` compares names in lower case.  ``pattern`` restricts the file names.
    """
    options = {"pathGlobFilter": pattern} if pattern else {}
    width = width or first_width(spark, paths, options) + 1
    odd = F.count_if("_odd")
    seen = stage(read_cells(spark, paths, width, options), f"{folder}/plain", odd=odd)
    staged = spark.read.parquet(f"{folder}/plain")
    if seen["odd"]:
        cut = staged.where("_odd").select("_file").distinct()
        torn = [as_path(unquote(r[0])) for r in cut.collect()]  # a reader takes names of files
        stage(read_cells(spark, torn, width, {"multiLine": "true"}), f"{folder}/whole", 1)
        rest = staged.join(F.broadcast(cut) if fits_broadcast(cut) else cut, "_file", "left_anti")
        staged = rest.unionByName(spark.read.parquet(f"{folder}/whole"))
    blocks = blocks_of(staged)
    n_blocks, n = count_blocks(blocks)
    first = blocks.groupBy("_file").agg(F.min(F.struct("_block", "_base")).alias("at"))
    heads = first.select("_file", F.col("at._base").alias("_head"))
    last_first = first.agg(F.max("at._block")).first()[0]  # 0 but for files that begin with blank lines
    near_heads = staged.where(F.col("_block") <= F.lit(last_first))  # skips the row groups of later blocks
    headers = pin(header_places(near_heads, heads, columns, width, any_case, within_limit(8 * n_blocks)))
    places = _places(columns)
    found = headers.agg(
        F.count(F.lit(1)).alias("files"), F.sum("_wanted").alias("cells"), F.max("_wanted").alias("wanted"),
        *[F.collect_set(p).alias(p) for p in places], *[F.count(p).alias(f"{p}n") for p in places],
    ).first()  # at most ``width`` places per column
    widest = (found["wanted"] or 0) + 1
    if widest > width:
        return land_csv(
            spark, paths, columns, f"{folder}/wide", start=start, any_case=any_case, pattern=pattern, width=widest
        )
    fits = within_limit(8 * (3 + len(columns) + 1) * n_blocks)
    rows, missing = placed(staged, blocks, headers, columns, width, start, found, fits)
    return CsvRows(rows, n - found["files"], missing)


def _places(columns: list[str]) -> list[str]:
    return [f"_p{i}" for i in range(len(columns))]


def header_places(
    staged: DataFrame, heads: DataFrame, columns: list[str], width: int, any_case: bool, heads_fit: bool
) -> DataFrame:
    """``_file, _head, _wanted`` and per column its cell in that file (null: it has none)."""
    at = heads.withColumnRenamed("_head", "_at").select("_at", F.col("_at").alias("_head"))
    at = F.broadcast(at) if heads_fit else at  # one number per file
    rows = staged.join(at, "_at")
    names = F.array(*[F.coalesce(F.col(n), F.lit("")) for n in _names(width)])
    names = F.transform(names, lambda n: F.replace(n, F.lit("﻿"), F.lit("")))
    if any_case:
        names = F.transform(names, F.lower)
    place = lambda c: F.nullif(F.array_position("_names", F.lit(c)), F.lit(0)) - 1
    return rows.withColumn("_names", names).select(
        "_file", "_head", F.col("_width").alias("_wanted"),
        *[place(c.lower() if any_case else c).cast("int").alias(p) for p, c in zip(_places(columns), columns)],
    )


def placed(
    staged: DataFrame, blocks: DataFrame, headers: DataFrame, columns: list[str], width: int, start: int,
    found: Row, blocks_fit: bool,
) -> tuple[DataFrame, tuple[str, ...]]:
    """Data rows with their position and the columns, and the columns that some file does not have."""
    places = _places(columns)
    missing = tuple(c for c, p in zip(columns, places) if found[f"{p}n"] < found["files"])
    # what is the same in all files is not looked up
    fixed = {p: found[p][0] for p in places if len(found[p]) == 1 and found[f"{p}n"] == found["files"]}
    one_width = found["cells"] == (found["wanted"] or 0) * found["files"]
    told = [p for p in places if p not in fixed] + ([] if one_width else ["_wanted"])
    is_head = F.col("_base") == F.col("_head")
    joined = blocks.join(headers.select("_file", "_head", *told), "_file")
    table = pin(
        joined.select(
            "_key", shifts(joined, is_head.cast("int"), start).alias("_shift"),
            F.when(is_head, F.col("_head")).alias("_skip"), *told,
        )
    )
    rows = lookup(staged.drop("_file", "_block", "_odd"), table, "_key", row_id="_at", small_fits=blocks_fit)
    rows = rows.where(~F.col("_at").eqNullSafe(F.col("_skip")))

    def cell(p: str) -> Column:
        if p in fixed:
            return F.col(f"c{fixed[p]}")
        value = F.lit(None).cast("string")
        for k in found[p]:
            value = F.when(F.col(p) == k, F.col(f"c{k}")).otherwise(value)
        return value

    wanted = F.lit(found["wanted"]) if one_width else F.col("_wanted")
    held = F.slice(F.array(*_names(width)), F.lit(1), F.least("_width", F.lit(width)))
    out = rows.select(
        (F.col("_at") + F.col("_shift")).alias("_index"),
        *[cell(p).alias(c) for p, c in zip(places, columns)],
        "_width", wanted.alias("_wanted"), F.coalesce("_record", row_text(held)).alias("_record"),
    )
    return out, missing


def row_text(cells: Column) -> Column:
    """Cells as a line of text, quoted where they must be."""
    quote, comma = F.lit('"'), F.lit(",")

    def written(c: Column) -> Column:
        bare = F.coalesce(c, F.lit(""))
        quoted = F.concat(quote, F.replace(bare, quote, F.lit('""')), quote)
        return F.when(F.contains(bare, quote) | F.contains(bare, comma) | F.contains(bare, F.lit("\n")), quoted).otherwise(bare)

    return F.array_join(F.transform(cells, written), ",")
