"""The pipeline's stages tell rows apart by id and text: null and repeated ids lose nothing."""

from __future__ import annotations

from collections import Counter

from rillflow.llm import decontaminate, jaccard_join, mixing


def words(name, n=30):
    return " ".join(f"{name}{i}" for i in range(n))


def kept(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_one_of_each_keeps_distinct_texts_of_one_id(spark):
    near = words("c") + " more"
    rows = [
        (None, words("a"), "s"), (None, words("b"), "s"), (None, near, "s"), (1, words("c"), "s"),
        (7, words("d"), "s"), (7, words("e"), "s"), (7, near, "s"), (8, words("f"), "s"), (8, words("f"), "s"),
        (None, words("g"), "s"), (None, words("g"), "s"), (None, words("h"), "s"), (None, words("h") + " more", "s"),
    ]
    got = kept(jaccard_join.one_of_each(table(spark, rows)))
    alone = [rows[i] for i in (0, 1, 3, 4, 5, 7, 9)]
    of_h = [r for r in got if r[1].startswith("h0 ")]
    assert len(of_h) == 1 and of_h[0] in rows
    assert got == Counter([*alone, *of_h])


def test_clean_removes_only_rows_with_an_item(spark):
    item = words("leak", 12)
    rows = [
        (None, words("a"), "s"), (None, f"{words('b')} {item} {words('c')}", "s"),
        (5, words("d"), "s"), (5, f"{words('e')} {item}", "s"), (6, None, "s"),
    ]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert kept(decontaminate.clean(table(spark, rows), items)) == Counter(rows[i] for i in (0, 2, 4))


def test_mixed_takes_each_row_as_the_mix_decided(spark):
    rows = [(None, words(f"n{k}x", 5 + k), "ab"[k % 2]) for k in range(12)]
    rows += [(3, words("same", 9), "a")] * 5 + [(3, words("other", 40), "b"), (3, words("same", 9), "c"), (4, "alone here", None)]
    docs = table(spark, rows)
    sized = Counter()
    for r in mixing.mix(docs).collect():
        sized[r.doc_id, r.size] += r.copies
    got = Counter()
    for (i, text, _), n in kept(mixing.mixed(docs)).items():
        got[i, len((text or "").split())] += n
    assert got == +sized
    assert len(set(sized.values())) > 1
