"""Mixing sources to target weights by entropy balancing.

Sources in code-point order (null last) weigh 3, 1, 2, repeating, and share ``share`` of all words;
a target stops at ``cap`` times its source's size, and the excess is shared among the rest by
weight until none is above.

Within a source the rates of the documents are those nearest to 1 in relative entropy that meet the
token constraint ``sum(rate * size) = target`` under ``0 <= rate <= cap``: exponentially tilted,
``rate = min(cap, exp(slope * size / mean size))``.  The slopes are the dual's solution, one for
each source, found by Newton steps within a shrinking bracket: each step is one aggregation over
the table of distinct sizes, summed up by source.  Rates become whole copies by passing
the rest of each document on to the next one, from long to short, in chunks of bounded size: a
source's words miss the target by about the length of a shortest document for each chunk.

Null or empty text has size 0 and takes nothing (one copy of no words).  A null source is a source
of its own.  Repeated rows are separate documents; columns of any name pass through.  Sizes that tie
are rounded in the order of their ids; a very long text is one size like any other; an empty table
gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rillflow.llm.common import map_pandas, row_key, whole_row, whole_text, words_of
from rillflow.operators.joins import lookup
from rillflow.operators.keys import dense_numbers
from rillflow.session import pin, reducers

WEIGHTS = (3, 1, 2)
#: Documents of one rounding chunk, about.
CHUNK_DOCS = 200_000
#: Steps within which each dual is solved, else the mix ends with an error.  Halving the bracket
#: alone would take about 60.
STEPS = 200


def source_key(source: str) -> Column:
    """Text that sorts as the sources do, null last."""
    return F.when(F.col(source).isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col(source)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``_key, source_size, n_docs, target``, a row per source."""
    sources = pin(
        sizes.groupBy("_key").agg(
            F.sum("size").alias("source_size"),
            F.count(F.lit(1)).alias("n_docs"),
            F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
        )
    )
    ranked = dense_numbers(sources, ["_key"], "_rank", start=0)
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    state = pin(ranked.withColumn("weight", F.get(pattern, F.col("_rank") % len(weights))))
    total = share * float(state.agg(F.sum("source_size")).first()[0] or 0)
    limit = F.col("source_size") * F.lit(cap)
    level = 0.0
    # Raise the level (words per unit of weight) until the capped and the others make up the total.
    while True:
        full = limit <= F.col("weight") * F.lit(level)
        fixed, weight, n_full = state.agg(
            F.sum(F.when(full, limit).otherwise(0.0)),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)),
            F.sum(full.cast("int")),
        ).first()
        new = (total - (fixed or 0.0)) / weight if weight else math.inf
        if not weight or new <= level:
            break
        level = new
    target = F.when(limit <= F.col("weight") * F.lit(level), limit).otherwise(F.col("weight") * F.lit(level))
    return state.select("_key", "source_size", "n_docs", "least", F.least(target, limit).alias("target"))


def solve(sizes: DataFrame, targets: DataFrame, cap: float = 2.0) -> DataFrame:
    """``targets`` with the ``slope`` of each source."""
    histogram = pin(sizes.where("size > 0").groupBy("_key", "size").agg(F.count(F.lit(1)).alias("n")))
    mean = F.col("source_size") / F.col("n_docs")
    # All documents at the cap above, all next to nothing below.
    reach = mean / F.col("least")
    state = targets.withColumns(
        {
            "_low": F.coalesce(-60.0 * reach, F.lit(0.0)),
            "_high": F.coalesce((math.log(cap) + 1e-9) * reach, F.lit(0.0)),
            "slope": F.lit(0.0),
        }
    )
    state = state.withColumn(
        "slope", F.when(F.col("target") >= cap * F.col("source_size"), F.col("_high")).otherwise(F.col("slope"))
    )
    state = pin(state)
    for _ in range(STEPS):
        x = F.col("size") / mean
        tilt = F.least(F.lit(cap), F.exp(F.least(F.col("slope") * x, F.lit(50.0))))
        words = F.col("n") * F.col("size") * tilt
        sums = (
            histogram.join(state.select("_key", "source_size", "n_docs", "slope"), "_key")
            .groupBy("_key")
            .agg(
                F.sum(words).alias("_words"),
                F.sum(F.when(tilt < cap, words * x).otherwise(0.0)).alias("_rise"),
            )
        )
        off = F.col("_words") - F.col("target")
        low = F.when(off < 0, F.col("slope")).otherwise(F.col("_low"))
        high = F.when(off >= 0, F.col("slope")).otherwise(F.col("_high"))
        newton = F.col("slope") - off / F.col("_rise")
        step = F.when(
            (F.col("_rise") > 0) & (newton > low) & (newton < high), newton
        ).otherwise((low + high) / 2)
        done = F.coalesce(F.abs(off) <= 1e-7 * F.col("target") + 1e-3, F.lit(True))
        seen = Observation()
        state = pin(
            state.join(sums, "_key", "left")
            .withColumns(
                {
                    "_done": done,
                    "_low": F.coalesce(low, F.col("_low")),
                    "_high": F.coalesce(high, F.col("_high")),
                    "slope": F.when(done, F.col("slope")).otherwise(step),
                }
            )
            .observe(seen, F.sum((~F.col("_done")).cast("int")).alias("open"))
            .drop("_words", "_rise", "_done")
        )
        if not seen.get.get("open"):
            break
    else:
        raise RuntimeError(f"rates of a source miss its target after {STEPS} steps")
    # The order of a sum may change last digits: rates must not depend on it.
    return state.withColumn("slope", F.round("slope", 9)).drop("_low", "_high", "least")


def to_copies(batches: Iterator[pd.DataFrame], cap: int) -> Iterator[pd.DataFrame]:
    """Whole copies of a sorted stream of ``chunk, size, rate``; the rest is passed on."""
    chunk, carry = None, 0.0
    for batch in batches:
        copies = np.ones(len(batch), np.int64)
        for i, (c, size, rate) in enumerate(zip(batch["chunk"], batch["size"], batch["rate"])):
            if c != chunk:
                chunk, carry = c, 0.0
            if size:
                want = rate * size + carry
                copies[i] = min(cap, max(0, math.floor(want / size + 0.5)))
                carry = want - copies[i] * size
        yield batch.assign(copies=copies)


def mix(
    docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: int = 2,
    text: str = "text", source: str = "source", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies, taken`` for each row of ``docs``."""
    done = dealt(docs, weights, share, cap, text, source, F.col(f"`{doc_id}`").alias("doc_id"), "long")
    return done.select(
        "doc_id", "size", "source_size", "target", "rate", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def dealt(
    docs: DataFrame, weights, share: float, cap: int, text: str, source: str, name: Column, kind: str
) -> DataFrame:
    """The mix of each row of ``docs``; ``name``, of type ``kind``, is carried along as ``doc_id``."""
    spark = docs.sparkSession
    sizes = pin(
        docs.select(
            name,
            source_key(f"`{source}`").alias("_key"),
            F.size(words_of(whole_text(f"`{text}`"))).cast("long").alias("size"),
        )
    )
    solved = solve(sizes, source_targets(sizes, weights, share, float(cap)), float(cap))
    rated = lookup(sizes, solved, "_key", row_id="doc_id").withColumn(
        "rate",
        F.least(
            F.lit(float(cap)),
            # a source of empty texts has no words and no slope to speak of
            F.exp(F.least(F.coalesce(F.try_divide(F.col("slope") * F.col("size") * F.col("n_docs"), "source_size"), F.lit(0.0)), F.lit(50.0))),
        ),
    )
    lane = F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("n_docs") / CHUNK_DOCS).cast("long"))
    chunk = F.concat_ws(":", lane.cast("string"), "_key")
    rows = (
        rated.select("doc_id", "size", "source_size", "target", "rate", chunk.alias("chunk"))
        .repartition(reducers(spark), "chunk")
        .sortWithinPartitions("chunk", F.desc("size"), "doc_id")
    )
    schema = f"doc_id {kind}, size long, source_size long, target double, rate double, chunk string, copies long"
    return map_pandas(rows, lambda b: to_copies(b, cap), schema)


def numbered(rows: DataFrame) -> DataFrame:
    """``_n``: a place from 0 on among the rows of one ``_row``, without a task for each key."""
    placed = pin(rows.withColumn("_at", F.monotonically_increasing_id()))
    dense = pin(dense_numbers(placed, ["_row", "_at"], "_n", start=0))
    least = dense.groupBy("_row").agg(F.min("_n").alias("_least"))
    return lookup(dense, least, "_row", row_id="_at").withColumn("_n", F.col("_n") - F.col("_least")).drop("_at", "_least")


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it.

    Rows are told apart by id, text and source; equal rows that are taken differently often, by
    their place among each other.
    """
    keyed = docs.select(whole_row(docs).alias("_doc"), row_key(source="source").alias("_row"))
    name = row_key(source="source").alias("doc_id")
    taken = pin(
        dealt(docs, weights, share, cap, "text", "source", name, "string").select(F.col("doc_id").alias("_row"), "copies")
    )
    alike = pin(taken.groupBy("_row").agg(F.min("copies").alias("_copies"), F.max("copies").alias("_most")))
    once = alike.where("_copies = _most").drop("_most")
    known = lookup(keyed, once, "_row", "inner", row_id="_row").drop("_row")
    uneven = alike.where("_copies < _most").select("_row")
    if not uneven.isEmpty():
        own = numbered(keyed.join(uneven, "_row", "left_semi"))
        theirs = numbered(taken.join(uneven, "_row", "left_semi")).withColumnRenamed("copies", "_copies")
        known = known.unionByName(own.join(theirs, ["_row", "_n"]).drop("_row", "_n"))
    times = F.array_repeat(F.lit(1), F.col("_copies").cast("int"))
    return known.select("_doc", F.explode(times)).select("_doc.*")
