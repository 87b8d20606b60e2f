"""First and latest occurrence by source position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.operators.joins import fits_broadcast, lookup, most_frequent, slices
from rillflow.session import pin, reducers


def flag_repeats(
    df: DataFrame,
    key: str,
    flag: str,
    *,
    pos: str = "row_index",
    seen: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: the key is not NULL and an earlier row, or ``seen``, has it already.

    Only the keys that do repeat are looked up, with their first position.  Counting them is
    combined on the map side; the result is written once, so that its size and its hot keys are
    known before the full rows move.  If it is small the rows do not move at all, and a key with
    very many copies is cut into slices: no task ever holds all copies of one key.
    """
    repeated = pin(
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(pos).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    firsts = repeated.select(key, "_first")
    fits, hot = fits_broadcast(firsts), None
    if not fits:
        parts, total = reducers(df.sparkSession), df.where(F.col(key).isNotNull()).count()
        hot = slices(most_frequent(repeated.select(key, "_n"), parts), total, parts)
    marked = lookup(df, firsts, key, row_id=pos, small_fits=fits, hot=hot)
    repeat = F.coalesce(F.col(pos) > F.col("_first"), F.lit(False))
    if seen is not None:
        known = seen.select(key).where(F.col(key).isNotNull())
        fits = fits_broadcast(known)
        known = known.distinct().withColumn("_seen", F.lit(True))
        marked = lookup(marked, known, key, row_id=pos, small_fits=fits, count_on=df)
        repeat = repeat | F.col("_seen").isNotNull()
    return marked.select(*df.columns, repeat.alias(flag))


def keep_first(df: DataFrame, keys: list[str], *, pos: str = "row_index") -> DataFrame:
    """Earliest row per key; NULL counts as one key value."""
    return _pick(df, [F.col(k) for k in keys], F.col(pos).asc())


def keep_latest(df: DataFrame, key: str, *, pos: str = "row_index") -> DataFrame:
    """Latest row per key; rows with a NULL key all stay, each as a group of its own."""
    own_group = F.when(F.col(key).isNull(), F.col(pos))
    return _pick(df, [F.col(key), own_group], F.col(pos).desc())


def _pick(df, groups, order):
    # rank = 1 right above the window lets Spark keep one row per key and task before the shuffle.
    window = Window.partitionBy(*groups).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
