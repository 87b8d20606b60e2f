"""Columns of any name in the pipeline's stages; limits that end in an exact way or an error."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rillflow.llm import compression_classifier, decontaminate, jaccard_join, mixing

CLASHES = ["_row", "_copies", "_copy", "_n", "_key", "a.b", "b`c", "_doc", "_first", "row", "copies", "size"]


def words(name, n=30):
    return " ".join(f"{name}{i}" for i in range(n))


def with_clashes(spark):
    """Each extra column holds its own name and the row's id; two rows are equal."""
    rows = [(1, words("a"), "s"), (2, words("b"), "s"), (3, words("c"), "t"), (3, words("c"), "t"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    own = [F.concat_ws("-", F.lit(c), "doc_id").alias(c) for c in CLASHES]
    return docs.select("doc_id", "text", "source", *own)


def whole(df):
    return Counter(tuple(r) for r in df.collect())


def test_near_copies_pass_columns_of_any_name(spark):
    docs = with_clashes(spark)
    got = jaccard_join.one_of_each(docs)
    assert got.columns == docs.columns
    assert whole(got) == Counter(set(whole(docs)))


def test_decontamination_passes_columns_of_any_name(spark):
    docs = with_clashes(spark)
    items = spark.createDataFrame([(1, words("b"))], "item_id long, text string")
    got = decontaminate.clean(docs, items)
    assert got.columns == docs.columns
    assert whole(got) == Counter({r: n for r, n in whole(docs).items() if r[0] != 2})


def test_mixture_passes_columns_of_any_name(spark):
    docs = with_clashes(spark)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    times = Counter()
    for r in mixing.mix(docs).collect():
        times[r.doc_id] += r.copies
    have = whole(got)
    assert set(have) <= set(whole(docs))
    assert Counter({r[0]: n for r, n in have.items()}) == Counter({i: n for i, n in times.items() if n})


def test_unsolved_rates_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    docs = spark.createDataFrame([(i, words("x", 3 + i * 7), "st"[i % 2]) for i in range(8)], "doc_id long, text string, source string")
    with pytest.raises(RuntimeError, match="after 1 steps"):
        mixing.mix(docs).collect()


def test_too_few_walks_compare_all_windows(monkeypatch):
    rng = np.random.default_rng(5)
    items = [(i, " ".join(f"v{i}x{k}" for k in range(40 + 9 * i))) for i in range(6)]
    texts, want = [], set()
    for i, text in items:
        for _ in range(5):
            own = text.split()
            for _ in range(decontaminate.allowed(len(own))):
                own[int(rng.integers(len(own)))] = "strange"
            want.add((len(texts), i))
            texts.append(" ".join(["before"] * 9 + own + ["after"] * 9))
    texts.append(words("clean", 200))
    monkeypatch.setattr(decontaminate, "MAX_REPEATS", 1)
    matcher = decontaminate.Matcher(items, 0.99)
    assert all(repeats is None for _, _, repeats, _ in matcher.classes)
    got = {(t, matcher.items[i][0]) for t, i, *_ in matcher.find(*matcher.encode(pa.array(texts)))}
    assert got == want


@pytest.mark.parametrize("far", [1.0, 50.0])
def test_curve_ends_where_its_slope_is_zero(far):
    rng = np.random.default_rng(1)
    design = np.stack([np.ones(300), far * rng.normal(size=300)], 1)
    y = (design[:, 1] > 0).astype(float)  # two sides that a line parts: steps would run away
    beta = compression_classifier.curve(design, y)
    slope = design.T @ (y - compression_classifier.chance(design, beta)) - 1e-2 * beta
    assert np.abs(slope).max() < 1e-4
