"""Importance resampling of documents towards a target's word and word-pair distribution.

1.  Features are all runs of one to ``LONGEST`` words.  A task interns the features of a batch in an
    open-addressed numpy table (``SpanTable``: XXH64 keys, bytes compared); each slot has the
    feature's bucket (crc32 modulo ``BUCKETS``) and its number of occurrences.  Buckets are thus
    computed once per distinct feature of a batch.  A task adds its slots up to one count per bucket,
    and these meet in a shuffle of at most ``BUCKETS`` rows a task, for the documents and the target.
2.  A bucket's gain is the logarithm of its smoothed share in the target over that in the documents.
    The table of gains has ``BUCKETS`` rows; it is all that the driver sees.
3.  A second pass interns again and gathers each occurrence's gain through its slot; a document's
    weight is the floored mean.
4.  Gumbel noise from a hash of the id makes the top k of ``weight + noise`` a weighted draw without
    replacement.  The score of rank k comes from counts by score (whole thousandths, whose number
    grows with the logarithm of the corpus only); rows from there on are range-partitioned and
    numbered; the others take no part in that shuffle.

Both passes hold a window of ``WINDOW`` words, however long a text is.

Contracts: null text has no words, no features and weight 0; such rows are returned and not drawn.
A null id hashes as the text ``null``.  Rows of one id are rows of their own; equal scores go by id
(null first), then n_features and weight; rows alike in all of these get consecutive ranks.  Columns
other than id and text are left out, whatever their names.  An empty table gives no rows; an empty
target makes gains that only smooth.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.byte_words import WORD_BYTES, SpanTable, Words, crc32, split, windows
from rillflow.llm.common import map_arrow, text_slices
from rillflow.operators.keys import dense_numbers
from rillflow.session import pin

BUCKETS, LONGEST = 10_000, 2
MIN_WORDS, PERCENT = 20, 25
SEED = "7"
#: Bytes of text split at once, and words whose features are interned at once.
SLICE, WINDOW = 4 << 20, 1 << 18


def feature_windows(words: Words, longest: int) -> Iterator[tuple[np.ndarray, SpanTable, np.ndarray]]:
    """Per window of words: the text of each feature, the table, and per slot in use its feature."""
    n = len(words)
    owner = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    last = np.repeat(words.first[1:], np.diff(words.first)) - 1
    for part in windows(n, WINDOW):
        begin = np.arange(part.start, part.stop)
        low = np.concatenate([begin] * longest)
        high = np.concatenate([begin + k for k in range(longest)])
        inside = high <= last[low]
        low, high = low[inside], high[inside]
        spans = words.cut(low, high)
        table = SpanTable(spans)
        yield owner[low], table, crc32(spans, table.owner[table.used])


def bucket_counts(docs: DataFrame, text: str = "text", *, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """``bucket, n``: occurrences of features in each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, SLICE):
                for _, table, sums in feature_windows(split(part["text"], WORD_BYTES), longest):
                    np.add.at(total, sums % buckets, table.counts[table.used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    mine = docs.select(F.col(f"`{text}`").alias("text"))
    return map_arrow(mine, run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket in thousandths, from the feature counts of both sides."""
    spark = docs.sparkSession
    # both sides have at most ``buckets`` rows
    counts = pin(
        spark.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(docs.withColumnRenamed("n", "s"), "bucket", "left")
        .join(target.withColumnRenamed("n", "t"), "bucket", "left")
        .na.fill(0, ["s", "t"])
    )
    ss, tt = (float(x) for x in counts.agg(F.sum("s"), F.sum("t")).first())
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.ln((t + 1) * F.lit(ss + buckets) / ((s + 1) * F.lit(tt + buckets))))
    rows = counts.select("bucket", gain.cast("long").alias("gain")).orderBy("bucket").collect()
    return [r["gain"] for r in rows]


def weights(
    docs: DataFrame, gains: list[int], *, text: str = "text", doc_id: str = "doc_id", longest: int = LONGEST
) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of each row."""
    table_of_gains = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, SLICE):
                words = split(part["text"], WORD_BYTES)
                features, sums = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for owner, table, crcs in feature_windows(words, longest):
                    by_slot = np.zeros(len(table.owner), np.int64)
                    by_slot[table.used] = table_of_gains[crcs % len(table_of_gains)]
                    np.add.at(sums, owner, by_slot[table.slot])
                    features += np.bincount(owner, minlength=len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(np.diff(words.first)),
                        pa.array(features),
                        pa.array(sums // np.maximum(features, 1)),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(rows, run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, the same for an id on every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the drawn rows by falling score, else null."""
    enough = F.col("n_words") >= min_words
    by_score = scored.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    # a row per distinct score, of which there are some ten thousands at any size
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.desc("score"))
    wanted = F.expr(f"eligible * {percent} div 100")
    placed = by_score.withColumns(
        {"upto": F.sum("n").over(above), "eligible": F.sum("n").over(whole)}
    )
    cut = placed.where(F.expr("upto - n") < wanted).agg(F.min("score"), F.max(wanted)).first()
    if cut[0] is None:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    in_reach = enough & (F.col("score") >= cut[0])
    order = ["_down", "doc_id", "n_features", "weight"]
    near = scored.where(in_reach).withColumn("_down", -F.col("score"))
    ranked = dense_numbers(near, order, "rank").withColumn("rank", F.expr(f"if(rank <= {cut[1]}, rank, null)"))
    rest = scored.where(~in_reach).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS,
    buckets: int = BUCKETS, longest: int = LONGEST, seed: str = SEED, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` (and ``n_words``) of each row of ``docs``."""
    kind = {"buckets": buckets, "longest": longest}
    gains = bucket_gains(bucket_counts(docs, text, **kind), bucket_counts(target, text, **kind), buckets)
    weighed = weights(docs, gains, text=text, doc_id=doc_id, longest=longest)
    scored = pin(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    return draw(scored, min_words, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``resample`` that are drawn, with their rank."""
    return resample(docs, target, **options).where(F.col("rank").isNotNull())
