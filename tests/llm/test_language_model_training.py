"""The language model is trained on the whole corpus until its likelihood stops rising."""

from __future__ import annotations

import numpy as np
from rillflow.llm import hidden_markov
from rillflow.llm.common import bucket_of_id

SF_DIR = "/root/testdata/sf0.001"


def test_steps_end_when_the_likelihood_stops_rising(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select("doc_id", "text", (bucket_of_id("doc_id", 5) != 1).alias("train"))
    packs = hidden_markov.pin(hidden_markov.encode(rows, 4))
    *_, seen = hidden_markov.trained(packs, hidden_markov.STATES, hidden_markov.RISE)
    rises = np.diff(seen) / np.abs(seen[:-1])
    assert len(seen) > 3 and (rises[-2:] <= hidden_markov.RISE).all() and seen[-1] > seen[0]
    assert not ((rises[:-2] <= hidden_markov.RISE) & (rises[1:-1] <= hidden_markov.RISE)).any()


def test_first_split_depends_on_the_word_alone():
    a = hidden_markov.hashed_split(["x", "", "word"], 4)
    b = hidden_markov.hashed_split(["word"], 4)
    assert np.allclose(a.sum(1), 1) and (a > 0).all() and np.array_equal(a[2], b[0])
    assert not np.allclose(a[0], a[2])
