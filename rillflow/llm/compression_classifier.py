"""Quality classifier by compression.

Two zstandard dictionaries are built from good and from bad labelled texts.  A text is cut into
pieces of ``PIECE`` bytes, all of it, and each piece is compressed with either dictionary:
``(bytes with the bad one - bytes with the good one) / (their mean + PRIOR_BYTES)`` over all pieces
is high for texts that resemble the good ones.  A logistic curve, fitted on labelled texts that are in neither
dictionary, turns this difference into a probability.

The dictionaries and the curve come from at most ``SAMPLE`` labelled training texts of either class,
of those with at most ``SAMPLE_BYTES`` bytes (documented bounds; one task holds them); scoring covers
whole texts and runs without a shuffle.
The curve also takes how short a text is and how
far it compresses at all, as repeated words leave little to tell.  Null and empty texts have
difference 0.  An empty table gives no rows; equal texts tie.  Without labelled texts of both classes the score is the
share of good ones, or 0.5.  Repeated rows are scored alike; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import bucket_of_id, map_arrow, whole_text
from rillflow.llm.labelled import training_sample
from rillflow.session import pin

SAMPLE = 3_000
SAMPLE_BYTES = 100_000
PIECE = 2_048
DICTIONARY = 110_000
#: Added to the compressed size, so that a few words are no strong evidence.
PRIOR_BYTES = 200
LEVEL = 3
#: Of 100 parts of the sample, those from here on are for the curve.
CALIBRATION_FROM = 65


def pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def dictionary(texts: list[str]) -> bytes:
    samples = [p for t in texts for p in pieces(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too little text: the text itself serves as a dictionary
        return b"".join(samples)[-DICTIONARY:]


class Scale:
    """Both dictionaries, ready to compress."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False,
                write_content_size=False, write_dict_id=False,
            )
            for d in (good, bad)
        )

    def measures(self, text: str) -> list[float]:
        """1, the difference, how short the text is (1: empty), how far it compresses at all."""
        good = bad = raw = 0
        for piece in pieces(text):
            raw += len(piece)
            good += len(self.good.compress(piece))
            bad += len(self.bad.compress(piece))
        both = (bad + good) / 2
        depth = np.log((both + PRIOR_BYTES) / (raw + 2 * PRIOR_BYTES))
        return [1.0, (bad - good) / (both + PRIOR_BYTES), PRIOR_BYTES / (both + PRIOR_BYTES), depth, depth**2]


def curve(design: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a light ridge, by Newton steps until none lowers the loss.

    A step that does not lower the strictly convex loss is halved, so each one that is taken does,
    and the search ends by itself.
    """
    beta = np.zeros(design.shape[1])
    ridge = np.full(design.shape[1], 1e-2)

    def loss(b: np.ndarray) -> float:
        at = design @ b
        return float((np.logaddexp(0, at) - y * at).sum() + (ridge * b * b).sum() / 2)

    now = loss(beta)
    while True:
        p = chance(design, beta)
        rise = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(rise, design.T @ (y - p) - ridge * beta)
        while (new := loss(beta + step)) >= now and np.abs(step).max() >= 1e-9:
            step = step / 2
        if not new < now or np.abs(step).max() < 1e-9:
            return beta
        beta, now = beta + step, new


def chance(design: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality") -> tuple:
    """Dictionaries and the curve's weights; the first weight alone where a class is missing."""
    sample = pin(training_sample(labels, label, train, SAMPLE))
    texts = (
        docs.select("doc_id", whole_text().alias("text"))
        .where(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(sample), "doc_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            {(r["doc_id"], r["label"], r["part"], r["text"]) for b in batches for r in b.to_pylist()}
        )
        sides = [[t for _, y, part, t in rows if y == k and part < CALIBRATION_FROM and t] for k in (0, 1)]
        share = (sum(y for _, y, _, _ in rows) + 1) / (len(rows) + 2)
        good, bad, beta = b"", b"", [float(np.log(share / (1 - share))), 0.0, 0.0, 0.0, 0.0]
        rest = [(y, t) for _, y, part, t in rows if part >= CALIBRATION_FROM]
        if sides[0] and sides[1] and len({y for y, _ in rest}) == 2:
            good, bad = dictionary(sides[1]), dictionary(sides[0])
            scale = Scale(good, bad)
            design = np.array([scale.measures(t) for _, t in rest])
            beta = curve(design, np.array([float(y) for y, _ in rest])).tolist()
        yield pa.RecordBatch.from_pydict({"good": [good], "bad": [bad], "beta": [beta]})

    # all tasks scan, the chosen texts alone move into one: 2 * SAMPLE of SAMPLE_BYTES, at most
    one_task = texts.select("doc_id", "label", "part", "text").repartition(1)
    row = map_arrow(one_task, run, "good binary, bad binary, beta array<double>").first()
    if row is None:  # no partition, so no task
        return b"", b"", np.zeros(5)
    return bytes(row["good"]), bytes(row["bad"]), np.array(row["beta"])


def score(docs: DataFrame, model: tuple) -> DataFrame:
    """``doc_id, score``."""
    good, bad, beta = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = Scale(good, bad) if good and bad else None
        nothing = [1.0, 0.0, 0.0, 0.0, 0.0]
        for batch in batches:
            rows = [scale.measures(t) if scale else nothing for t in batch["text"].to_pylist()]
            design = np.array(rows, float).reshape(-1, len(nothing))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(chance(design, beta))], names=["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return map_arrow(rows, run, "doc_id long, score double")


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = bucket_of_id("doc_id", 4) == 2
    model = fit(docs, labels, ~held_out)
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )
