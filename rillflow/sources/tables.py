"""Raw scans: text columns by name, NA words as NULL, and each row's position in its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.scalars import blank_na, to_double, to_id, parse_timestamp
from rillflow.operators.quality import require_columns
from rillflow.session import fresh_folder
from rillflow.sources.csvfiles import CSV_OPTIONS, land_csv
from rillflow.sources.positions import number_rows, stage, with_block


def scan(
    spark: SparkSession,
    path: str | list[str],
    *,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Files of a folder, optionally only those whose name fits ``pattern``.

    CSV files are taken to have one header all; ``land``, ``typed_scan`` and ``load_by_name`` read
    each file by its own.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, cast to the wanted types; a value that does not fit becomes NULL."""
    return df.select(*[_typed(F.col(f.name), f).alias(f.name) for f in schema.fields])


def _typed(col, field: T.StructField):
    kind = field.dataType
    if isinstance(kind, T.LongType):
        return to_id(col.cast("string"))
    if isinstance(kind, T.DoubleType):
        return to_double(col)
    if isinstance(kind, T.TimestampNTZType):
        return parse_timestamp(col.cast("string"))
    if isinstance(kind, T.DateType):
        return parse_timestamp(col.cast("string")).cast("date")
    return col.try_cast(kind)


def land(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str],
    *,
    fmt: str = "csv",
    staging: str | None = None,
    start: int = 0,
) -> tuple[DataFrame, int]:
    """Raw source as text columns plus ``row_index``, and the number of its rows.

    ``row_index`` is the dense position over all files of the source.  The text is parsed once and
    written as Parquet, so that later passes read single columns.  CSV columns are found by each
    file's own header; cells beyond it are dropped, and those that a row does not have are NULL.
    """
    folder = staging or fresh_folder(spark, "landing")
    if fmt == "csv":
        landed = land_csv(spark, path, columns, folder, start=start)
        if landed.missing:
            raise ValueError(f"Missing required columns: {list(landed.missing)}")
        return landed.text(columns), landed.n
    source = scan(spark, path, fmt=fmt)
    require_columns(source, columns)
    n = stage(with_block(source, *[F.col(c).cast("string").alias(c) for c in columns]), folder)["rows"]
    return blank_na(number_rows(spark.read.parquet(folder), columns, start)), n


def typed_scan(
    spark: SparkSession, path: str | list[str], schema: T.StructType, *, pattern: str | None = None
) -> DataFrame:
    """CSV files of a folder, those whose name fits ``pattern``: columns by name, with their types."""
    landed = land_csv(spark, path, schema.names, fresh_folder(spark, "landing"), pattern=pattern)
    return project(landed.text(schema.names), schema)


def load_by_name(
    spark: SparkSession, paths: list[str], schema: T.StructType, *, fmt: str = "csv"
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: columns matched by lower-cased name, absent ones NULL, extra ones dropped.

    A row is bad if a value cannot take its column's type (``reason`` ``value``, ``raw_row`` its
    named cells as a JSON object), or if it has another number of cells than its file's header
    (``width``, ``raw_row`` its line).
    """
    names = schema.names
    if fmt == "csv":
        landed = land_csv(spark, paths, names, fresh_folder(spark, "landing"), any_case=True)
        broken = landed.wrong_width()
        text = landed.rows.select(*names, broken.alias("_broken"), F.when(broken, F.col("_record")).alias("_line"))
    else:
        frames = []
        for path in paths:
            df = scan(spark, path, fmt=fmt)
            df = df.toDF(*[c.lower() for c in df.columns])
            frames.append(df.select(*[F.col(n).cast("string").alias(n) for n in names if n in df.columns]))
        text = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        absent = [F.lit(None).cast("string").alias(n) for n in names if n not in text.columns]
        text = text.select("*", *absent, F.lit(False).alias("_broken"), F.lit(None).cast("string").alias("_line"))
    text = blank_na(text, keep=("_line",))
    typed = text.select(
        *[F.col(n).alias(f"_raw_{n}") for n in names],
        *[_typed(F.col(f.name), f).alias(f.name) for f in schema.fields],
        "_broken",
        "_line",
    )
    spoiled = reduce(lambda a, b: a | b, [F.col(f"_raw_{n}").isNotNull() & F.col(n).isNull() for n in names])
    named = F.struct(*[F.col(f"_raw_{n}").alias(n) for n in names])
    original = F.coalesce(F.col("_line"), F.to_json(named, {"ignoreNullFields": "false"}))
    good = typed.where(~F.col("_broken") & ~spoiled).select(*names)
    bad = typed.where(F.col("_broken") | spoiled).select(
        F.when(F.col("_broken"), "width").otherwise("value").alias("reason"), original.alias("raw_row")
    )
    return good, bad
