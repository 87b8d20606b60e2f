"""Importance resampling, source divergence and SimHash against brute force, with the odd rows of each."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from rillflow.llm import importance_resampling, simhash_pigeonring, source_divergence
from rillflow.llm import byte_words as bw

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# columns that other rows' names could clash with
SCHEMA = (
    "doc_id long, text string, lang string, source string, n int, rank string, fp string, term int, "
    "value int, `a.b` int, _down int, score int"
)
LONG = " ".join(f"Wort{i % 900} x{i % 7}" for i in range(30_000))
BASE = [f"alpha{i}" for i in range(60)]
TEXTS = [
    (0, " ".join(BASE), "en", "a"),
    (1, " ".join(BASE), "en", "a"),
    (2, " ".join(BASE[:59] + ["other"]), "en", "b"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, LONG, "de", "a"),
    (6, LONG + " end", "de", "ü"),
    (7, "ONE one One\n\x0btwo é É 日本 a-b x1y2", "de", "b"),
    (7, "another text under one id " * 6, "en", None),
    (None, "no id here but words enough to take part in the draw " * 2, "en", "a"),
    (None, "no id here but words enough to take part in the draw " * 2, "en", "a"),
    (8, "x" * 5000, "fr", "only"),
    (9, "short", "fr", "only"),
] + [(20 + i, " ".join(f"w{(i * j) % 37} q{j % 5}" for j in range(12 + i)), "en", "abc"[i % 3]) for i in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, 1, "r", "f", 2, 3, 4, 5, 6) for i, t, g, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


# importance resampling --------------------------------------------------------------------
def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def drawn_by_hand(texts, targets):
    def buckets(all_texts):
        return Counter(zlib.crc32(f.encode()) % 10_000 for t in all_texts for f in features(t)[1])

    s, t = buckets(x[1] for x in texts), buckets(targets)
    ss, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ss + 10_000) / ((s[b] + 1) * (tt + 10_000)))) for b in range(10_000)]
    out = []
    for i, text, *_ in texts:
        words, f = features(text)
        weight = sum(gain[zlib.crc32(x.encode()) % 10_000] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((len(words) >= 20, i, len(f), weight, weight + noise))
    eligible = sorted(
        (r for r in out if r[0]), key=lambda r: (-r[4], r[1] is not None, r[1] or 0, r[2], r[3])
    )
    k = 25 * len(eligible) // 100
    return [(*r[1:], n + 1 if n < k else None) for n, r in enumerate(eligible)] + [(*r[1:], None) for r in out if not r[0]]


def test_resampling_equals_brute_force(spark, docs, none, monkeypatch):
    monkeypatch.setattr(importance_resampling, "WINDOW", 700)  # long texts span many windows
    monkeypatch.setattr(importance_resampling, "SLICE", 2000)
    targets = ["One two é É w3 q1 w6", None, "", LONG[:4000]]
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(targets)], "item_id long, text string, bucket int")
    got = importance_resampling.resample(docs, bench).drop("n_words")
    assert Counter(rows(got)) == Counter(drawn_by_hand(TEXTS, targets))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(importance_resampling.resample(none, bench)) == []
    empty = bench.where("false")
    got = rows(importance_resampling.resample(docs, empty).drop("n_words"))
    assert Counter(got) == Counter(drawn_by_hand(TEXTS, []))
    assert importance_resampling.drawn(docs, empty).count() == sum(r[4] is not None for r in got)


def test_ties_go_to_the_smaller_id(spark):
    scored = spark.createDataFrame(
        [(i, 30, 5, 0, 7 + i % 2) for i in range(20)] + [(99, 3, 5, 0, 50)],
        "doc_id long, n_words long, n_features long, weight long, score long",
    )
    got = {r.doc_id: r["rank"] for r in importance_resampling.draw(scored).collect()}
    assert {i: n for i, n in got.items() if n} == {1: 1, 3: 2, 5: 3, 7: 4, 9: 5} and len(got) == 21


# source divergence ------------------------------------------------------------------------
def audited_by_hand(texts, min_docs=3, top=200):
    seen, in_docs, sources = Counter(), Counter(), {}
    for _, text, lang, source in texts:
        lang, source = lang or "", source or ""
        sources.setdefault(lang, set()).add(source)
        w = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        seen.update((lang, source, t) for t in w)
        in_docs.update((lang, t) for t in set(w))
    out = []
    for lang, group in sources.items():
        kept = [t for (g, t), n in in_docs.items() if g == lang and n >= min_docs]

        def shares(count):
            n = sum(count(t) for t in kept)
            return {t: 1 + 10**9 * (count(t) + 1) // (n + len(kept)) for t in kept}

        p = {s: shares(lambda t, s=s: seen[lang, s, t]) for s in group}
        q = shares(lambda t: sum(seen[lang, s, t] for s in group))
        for s in group:
            parts = {
                "pair": [(x, sum((p[s][t] - p[x][t]) ** 2 // p[x][t] for t in kept)) for x in group if x != s],
                "term": [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if seen[lang, s, t] and p[s][t] > q[t]],
            }
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, *x, n + 1) for n, x in enumerate(items) if part == "pair" or n < top]
    return out


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_audit_equals_brute_force(docs, none, monkeypatch, chunk):
    monkeypatch.setattr(source_divergence, "CHUNK", chunk)
    monkeypatch.setattr(source_divergence, "WINDOW", 500)
    got = source_divergence.audit(docs)
    assert Counter(rows(got)) == Counter(audited_by_hand(TEXTS))
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows(source_divergence.audit(none)) == []
    few = Counter(rows(source_divergence.audit(docs, min_docs=1, top_terms=2)))
    assert few == Counter(audited_by_hand(TEXTS, 1, 2))


def test_gallop_finds_places():
    rng = np.random.default_rng(5)
    for few, many in ((0, 9), (5, 0), (1, 1), (40, 3), (100, 5000), (3000, 3000), (33, 100_000)):
        a = np.unique(rng.integers(0, 20_000, few))
        b = np.unique(rng.integers(0, 20_000, many))
        assert (source_divergence.gallop(a, b) == np.searchsorted(b, a)).all()


def test_shares_stay_exact_at_large_counts(spark):
    counts = [0, 1, 10**10, 4 * 10**12, 3 * 10**15]
    whole = 5 * 10**15
    want = [1 + 10**9 * (n + 1) // whole for n in counts]
    assert source_divergence.shares(np.array(counts, np.int64), whole).tolist() == want
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(n,) for n in counts], "n long")
    share = source_divergence.share_column(F.col("n"), F.lit(whole - 7), F.lit(7))
    assert [r[0] for r in df.select(share).collect()] == want


# SimHash ----------------------------------------------------------------------------------
def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps):
    """Smallest member of each fingerprint's component, over all pairs."""
    fps = sorted(set(fps))
    at = np.array(fps, np.uint64)
    root = np.arange(len(fps))
    a, b = np.nonzero(np.triu(np.bitwise_count(at[:, None] ^ at[None, :]) <= 3, 1))
    return dict(zip(fps, (fps[r] for r in simhash_pigeonring.forest(len(fps), a, b)), strict=True)) if len(a) else {
        f: f for f in fps
    } | dict(zip(fps, (fps[r] for r in root)))


def test_near_duplicates_equal_brute_force(docs, none, monkeypatch):
    monkeypatch.setattr(simhash_pigeonring, "WINDOW", 400)
    fps = [fingerprint(t[1]) for t in TEXTS]
    root = components(fps)
    want = []
    for (i, *_), f in zip(TEXTS, fps):
        ids = [x[0] for x, g in zip(TEXTS, fps) if root[g] == root[f] and x[0] is not None]
        want.append((i, f"{f:016x}", min(ids, default=None)))
    got = simhash_pigeonring.near_duplicates(docs)
    assert Counter(rows(got)) == Counter(want)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {r[2] for r in want if r[0] in (3, 4)} == {3}
    assert rows(simhash_pigeonring.near_duplicates(none)) == []


def found_roots(spark, fps):
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long").repartition(4)
    edges = [(r.id, r.to) for r in simhash_pigeonring.links(frame).collect()]
    index = {f: n for n, f in enumerate(sorted(set(fps)))}
    unsigned = [(index[a % (1 << 64)], index[b % (1 << 64)]) for a, b in edges]
    a, b = (np.array(x, np.int64) for x in zip(*unsigned)) if unsigned else (np.zeros(0, np.int64),) * 2
    root = simhash_pigeonring.forest(len(index), a, b)
    ordered = sorted(index)
    return {f: ordered[root[n]] for f, n in index.items()}


def test_links_with_large_entries_lose_none(spark):
    rng = np.random.default_rng(3)
    center = [int(x) for x in rng.integers(0, 1 << 63, 3)]

    def flip(x, n, low=0, high=64):
        for b in rng.choice(np.arange(low, high), n, replace=False):
            x ^= 1 << int(b)
        return x

    # a cloud of over LIMIT fingerprints that share most bytes, chains of three bits, and strangers
    cloud = [flip(center[0], int(rng.integers(0, 7)), 0, 22) for _ in range(4000)]
    chain = [center[1]]
    for _ in range(40):
        chain.append(flip(chain[-1], 3))
    apart = [flip(center[2], 4) for _ in range(30)] + [int(x) for x in rng.integers(0, 1 << 63, 300)]
    fps = cloud + chain + apart + [0, 7, 15, (1 << 64) - 1]
    assert len(set(cloud)) > simhash_pigeonring.LIMIT
    assert found_roots(spark, fps) == components(fps)


def test_every_near_pair_is_filed_together():
    ring = [(s, m % (1 << 64)) for s, m in simhash_pigeonring.entries_of_ring()]
    assert len(set(ring)) == 24 and {bin(m).count("1") for _, m in ring} == {32}
    rng = np.random.default_rng(9)
    for _ in range(3000):
        gap = 0
        for b in rng.integers(0, 64, 3):
            gap |= 1 << int(b)
        good = []
        for start, mask in ring:
            turned = (gap >> start * 8 | gap << (64 - start * 8)) % (1 << 64)
            chains = all(bin(turned % (1 << 8 * n)).count("1") <= n * 3 // 8 for n in range(1, 9))
            good.append(chains and not gap & mask)
        assert any(good)
    open_bits = ring[0][1]
    for _ in range(4):
        parts = simhash_pigeonring.finer(open_bits)
        assert len(parts) == 4
        open_bits = min(parts, key=lambda m: bin(m).count("1"))
    assert 64 - bin(open_bits).count("1") <= 12


def test_fingerprint_counts_of_many_shingles():
    texts = ["a b c " * 2000, "x y", "q", None] + [" ".join(f"{i}t{j}" for j in range(700)) for i in range(3)]
    got = simhash_pigeonring.fingerprints_of(bw.split(pa.array(texts), bw.BLANK_BYTES)).tolist()
    assert got == [fingerprint(t) for t in texts]
