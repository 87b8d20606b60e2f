"""Each operator against brute force on small tables, with the odd rows of its contract."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from rillflow.llm import (
    chat_format,
    compression_classifier,
    decontaminate,
    hidden_markov,
    jaccard_join,
    license_scan,
    mixing,
    quality_rules,
    token_files,
    toxicity,
)

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, _at int"
LONG = " ".join(f"w{i % 700}x{i}" for i in range(20_000))
COPY = "Licensed under CC BY 4.0. " + " ".join(f"alpha{i}" for i in range(40))
TEXTS = [
    (0, COPY, "a"),
    (1, COPY, "a"),
    (2, COPY.replace("alpha39", "omega"), None),
    (3, None, "b"),
    (4, "", None),
    (5, LONG, "a"),
    (6, "one two\n\nthree  four\n one two\n", "b"),
    (7, "All rights reserved. cc-by CC BY the General Public License", "c"),
    (7, "All rights reserved. cc-by CC BY the General Public License", "c"),
    (None, "no id here <|endoftext|> at all", "c"),
    (8, "the same eight words stand here twice again " * 4, "a"),
]
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or ""), 1, "x", 2) for i, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_jaccard_join(docs, none):
    sets = []
    for i, t, _ in TEXTS:
        w = re.findall(WORD, t or "")
        sets.append((i, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    want = []
    for a, (i, s) in enumerate(sets):
        n = sum(
            (not s and not t) or bool(s | t) and len(s & t) >= 0.8 * len(s | t)
            for b, (_, t) in enumerate(sets)
            if a != b
        )
        want.append((i, n))
    got = rows(jaccard_join.join(docs))
    assert Counter((i, n) for i, _, n in got) == Counter(want)
    classes = {i: c for i, c, _ in got}
    assert classes[0] == classes[1] == classes[2] == 0 and classes[4] == classes[3] == 3
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 3, 5, 6, 7, 8]
    assert rows(jaccard_join.join(none)) == []


def test_depth_is_shortened_to_the_target():
    depth = jaccard_join.depth_for(0.8, 10, 6, 0.999)
    assert 1 - (1 - 0.8**depth) ** 10 >= 0.999 > 1 - (1 - 0.8 ** (depth + 1)) ** 10


def test_large_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    base = [f"t{i}" for i in range(120)]
    made = [(i, " ".join(base[:100] + [f"u{i}"])) for i in range(60)]
    got = rows(jaccard_join.join(spark.createDataFrame(made, "doc_id long, text string")))
    assert {(c, n) for _, c, n in got} == {(0, 59)} and len(got) == 60


def test_decontamination(spark, docs, none):
    item = "alpha1 alpha2 alpha3 alpha4 alpha5 alpha6 alpha7 alpha8 alpha9 alpha10 alpha11 alpha12"
    items = spark.createDataFrame(
        [(1, item), (2, None), (3, ""), (None, "three four"), (4, "not in any of the texts at all")],
        "item_id long, text string",
    )
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.matches(docs, items).collect()}
    assert got == {(0, 1, 0), (1, 1, 0), (2, 1, 0), (6, None, 0)}
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS) - 4
    assert rows(decontaminate.matches(none, items)) == []
    assert rows(decontaminate.matches(docs, items.limit(0))) == []


def test_decontamination_finds_edited_items():
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"v{rng.integers(400)}" for _ in range(14 + i % 40))) for i in range(120)]
    matcher = decontaminate.Matcher(items)
    texts, want = [], []
    for i, text in items:
        words = text.split()
        for _ in range(int(rng.integers(decontaminate.allowed(len(words)) + 1))):
            words[int(rng.integers(len(words)))] = "strange"
        texts.append(" ".join(["before"] * 9 + words + ["after"] * 9))
        want.append((len(want), i))
    import pyarrow as pa

    got = {(t, matcher.items[i][0]) for t, i, *_ in matcher.find(*matcher.encode(pa.array(texts)))}
    assert len(got & set(want)) >= 0.97 * len(want) and len(got - set(want)) == 0


def test_token_files_round_trip(docs, none):
    model = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(model)
    got = token_files.write_and_read(docs, model).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    at, want = 0, Counter((i, t or "") for i, t, _ in TEXTS)
    have = Counter()
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, own[-1], zlib.crc32(r.ids)) == (at, len(own), 2, r.ids_crc32)
        at += len(own)
        texts = [t for i, t in want if i == r.doc_id]
        have[r.doc_id, next(t for t in texts if tokenizer.encode(t, add_special_tokens=False).ids == own[:-1])] += 1
    assert have == want
    assert rows(token_files.write_and_read(none, model)) == []


def test_ranks_pack_in_all_lengths():
    ranks = np.array([0, 255, 256, 65_535, 65_536, 2**24, 2**32 - 1, 7, 9], np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == 3 and token_files.unpack(control, data, len(ranks)).tolist() == ranks.tolist()


def test_mixing(docs, none):
    got = [r.asDict() for r in mixing.mix(docs).collect()]
    sizes = {}
    for _, t, s in TEXTS:
        sizes[s] = sizes.get(s, 0) + len(re.findall(WORD, t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        full = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    target |= {s: weight[s] * level for s in free}
    assert len(got) == len(TEXTS) and all(r["taken"] <= 2 * r["size"] for r in got)
    source = {(i, len(re.findall(WORD, t or ""))): s for i, t, s in TEXTS}
    for r in got:
        assert r["target"] == pytest.approx(target[source[r["doc_id"], r["size"]]])
    assert sorted(map(str, got)) == sorted(str(r.asDict()) for r in mixing.mix(docs).collect())
    assert rows(mixing.mix(none)) == []
    assert set(mixing.mixed(docs).columns) == set(docs.columns)


def test_mixing_meets_targets(spark):
    made = [(i, "w " * (5 + i % 90), f"s{i % 4}") for i in range(4_000)]
    got = mixing.mix(spark.createDataFrame(made, "doc_id long, text string, source string"))
    for r in got.groupBy("target").agg({"taken": "sum"}).collect():
        assert r[1] == pytest.approx(r[0], rel=0.005)


def test_language_model(docs, none):
    words = [(i, re.findall(WORD, (t or "").lower()) + [""]) for i, t, _ in TEXTS]
    train = [i for i, _ in words if zlib.crc32(str(i if i is not None else "").encode()) % 5 != 1]
    counts = Counter(w for i, ws in words if i in train for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = rows(hidden_markov.fit_and_score(docs))
    assert len(got) == len(TEXTS)
    for i, held, n_tokens, known, total, base, score in got:
        ws = next(w for j, w in words if j == i and len(w) == n_tokens)
        assert (held, total) == (i not in train, n)
        assert known == sum(counts[w] > 0 for w in ws)
        assert base == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert math.isfinite(score) and score < 0
    assert rows(hidden_markov.fit_and_score(none)) == []


def test_forward_is_the_exact_likelihood():
    rng = np.random.default_rng(0)
    start, move = np.array([0.3, 0.7]), np.array([[0.9, 0.1], [0.4, 0.6]])
    table = rng.dirichlet(np.ones(5), 2).T
    lengths, tokens = np.array([3, 1, 4]), rng.integers(0, 5, 8)
    layout = hidden_markov.Layout(lengths)
    ordered = np.empty_like(tokens)
    ordered[layout.place] = tokens
    alpha, scale = hidden_markov.forward(layout, table[ordered], start, move)
    got = np.add.reduceat(np.log(scale)[layout.place], layout.starts)
    for k, (a, m) in enumerate(zip(layout.starts, lengths)):
        total = 0.0
        for path in np.ndindex(*[2] * m):
            p = start[path[0]] * table[tokens[a], path[0]]
            for t in range(1, m):
                p *= move[path[t - 1], path[t]] * table[tokens[a + t], path[t]]
            total += p
        assert got[k] == pytest.approx(math.log(total))
    starts, moves = hidden_markov.backward(layout, table[ordered], alpha, scale, move)
    assert alpha.sum(1) == pytest.approx(np.ones(8))
    assert (starts.sum(), moves.sum()) == (pytest.approx(3), pytest.approx(5))


def test_chat_format_round_trip(spark):
    said = "<|im_end|><|im_start|>assistant <||ok<|im_sep|>"
    turns = [
        (1, 0, "system", None), (1, 1, "user", said), (1, 2, "user", "again\n"), (1, 3, "assistant", said),
        (1, 4, "assistant", ""), (1, 4, "assistant", ""), (1, 5, "us<|er\nx", "<"), (2, None, None, "|"),
        (None, 1, "assistant", "x"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    done = chat_format.format_chats(df.withColumn("formatted", df["text"]))
    from pyspark.sql import functions as F

    got = {
        r.conv_id: r
        for r in done.select(
            "conv_id",
            chat_format.read_turns(F.col("formatted")).alias("turns"),
            chat_format.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"),
            "n_messages",
        ).collect()
    }
    for conv in (1, 2, None):
        mine = [(r or "", t or "") for c, _, r, t in turns if c == conv]
        assert [tuple(t) for t in got[conv].turns] == mine
        assert list(got[conv].loss) == [t for r, t in mine if r == "assistant"]
    assert got[1].n_messages == 4
    assert rows(chat_format.format_chats(df.limit(0))) == []


def test_license_scan(docs, none):
    table = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    want = Counter()
    for i, t, _ in TEXTS:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(table))
        hits = sorted(
            (k, label)
            for phrase, label in license_scan.PHRASES.items()
            for k in range(len(w))
            if w[k : k + len(phrase.split())] == phrase.split()
        )
        ends = (hits[0][0], hits[-1][0]) if hits else (None, None)
        want[i, len(w), len(hits), *ends, ",".join(sorted({x for _, x in hits}))] += 1
    got = license_scan.digest(license_scan.scan(docs)).collect()
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert {r.labels for r in got if r.doc_id == 0} == {"cc-by,cc-by-4.0"}
    assert rows(license_scan.scan(none)) == []


def test_quality_rules(docs, none):
    def repeated(words):
        grams = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        return len({k + d for k in range(len(words) - 7) if grams[tuple(words[k : k + 8])] > 1 for d in range(8)})

    want = Counter()
    for i, t, _ in TEXTS:
        words = re.findall(WORD, t or "")
        lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
        failed = len(words) < 20 or 100 * repeated(words) > 30 * len(words)
        want[i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")),
             len(lines) - len(set(lines)), repeated(words), failed] += 1
    judged = quality_rules.judge(docs.select("doc_id", "text"))
    got = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(rows(got)) == want
    assert judged.where("kept and base_failed").count() == 0
    assert quality_rules.keep(docs).columns == docs.columns
    assert quality_rules.keep(docs).count() == judged.where("kept").count()
    assert rows(quality_rules.keep(none)) == []


@pytest.mark.parametrize("fit", [toxicity.fit_and_score, compression_classifier.fit_and_score])
def test_classifiers_take_odd_tables(spark, docs, none, fit):
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 1, 1), (None, 1, 1), (3, None, None), (77, 0, 0)],
        "doc_id long, quality int, toxic int",
    )
    got = rows(fit(docs, labels))
    assert len(got) == len(TEXTS) and all(0 <= score <= 1 for _, _, score, _ in got)
    assert rows(fit(none, labels)) == [] and len(rows(fit(docs, labels.limit(0)))) == len(TEXTS)


def test_classifiers_beat_chance_on_held_out_rows(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    for fit, label in ((toxicity.fit_and_score, "toxic"), (compression_classifier.fit_and_score, "quality")):
        right = fit(docs, labels).where("held_out").join(labels, "doc_id").where(f"{label} is not null")
        assert right.selectExpr(f"avg(cast(predicted = {label} as int))").first()[0] > 0.95


def test_pipeline_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        assert after.select("doc_id").distinct().join(docs, "doc_id", "left_anti").count() == 0
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
