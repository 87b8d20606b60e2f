"""Spans of words, their hashes and the table of distinct spans against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rillflow.llm import byte_words as bw

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERNS = [
    (bw.WORD_BYTES, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"),
    (bw.LETTER_BYTES, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"),
    (bw.BLANK_BYTES, r"[^\x20\x09-\x0D]+"),
]
LONG = ["x" * 31 + " " + "y" * 32 + " " + "z" * 255 + " " + "é" * 128 + " " + "w" * 3000, "a b" * 5000, "", None]


def plain(text, pattern):
    return re.findall(pattern, (text or "").translate(FOLD))


def spans_of(words, texts, pattern, n):
    got = words.runs(n, whole_if_short=True)
    spans = words.cut(got[0], got[1])
    want = []
    for t in texts:
        w = plain(t, pattern)
        want += [" ".join(w[i : i + n]).encode() for i in range(max(len(w) - n + 1, 1 if w else 0))]
    return spans, want, got[2]


def check(texts):
    for become, pattern in PATTERNS:
        # a slice of a longer array, as batches are
        words = bw.split(pa.array(["head"] + texts + ["tail"], pa.string()).slice(1, len(texts)), become)
        assert np.diff(words.first).tolist() == [len(plain(t, pattern)) for t in texts]
        for n in (1, 2, 3):
            spans, want, _ = spans_of(words, texts, pattern, n)
            assert [spans.bytes_at(i) for i in range(len(spans))] == want
            for seed in (0, 42):
                assert bw.xxh64(spans, seed).tolist() == [xxhash.xxh64_intdigest(w, seed) for w in want]
            everything = np.arange(len(want))
            assert bw.crc32(spans, everything).tolist() == [zlib.crc32(w) for w in want]
            assert spans.text(everything).to_pylist() == [w.decode() for w in want]


def test_spans_and_hashes():
    check(["One two,THREE 4x four", "ÀÉ straße x 日本語 y\x85z", " \n\t", "a"] + LONG)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aB9 \n.é日\x0b\x1f_"), max_size=60)), max_size=6))
def test_spans_and_hashes_of_any_text(texts):
    check(texts)


def test_table_counts_distinct_spans_also_where_keys_agree():
    texts = ["a b a c b a", "a b c d e f g h i j " * 30]
    words = bw.split(pa.array(texts), bw.WORD_BYTES)
    spans, want, _ = spans_of(words, texts, PATTERNS[0][1], 2)
    for keys in (None, np.zeros(len(want), np.uint64), np.arange(len(want), dtype=np.uint64) % 3 * 0 + 5):
        table = bw.SpanTable(spans, keys)
        counts = {spans.bytes_at(table.owner[s]): int(table.counts[s]) for s in table.used}
        assert counts == Counter(want)
        assert [spans.bytes_at(table.owner[s]) for s in table.slot] == want


def test_empty():
    assert len(bw.split(pa.array([], pa.string()), bw.WORD_BYTES)) == 0
    words = bw.split(pa.array(["", None]), bw.WORD_BYTES)
    assert len(words) == 0 and words.first.tolist() == [0, 0, 0]
