"""Source divergence audit: how far the sources of each language are from each other, and by which terms.

1.  Tasks intern the terms of a batch (``SpanTable``) and pass on one row per (lang, source, term) of
    it, with occurrences and documents; these are summed up before and after one shuffle.
2.  Terms in at least ``MIN_DOCS`` documents of a language are kept and numbered densely over all
    languages in the order (lang, term).  A group's counts become arrays of (term id, count), sorted
    by id and cut into chunks of ``CHUNK`` ids, so no array grows with the vocabulary.
3.  A pair task gets the arrays of two sources for one chunk.  The shorter one's ids are sought in
    the longer one by galloping; terms of both, of one side only and of neither are priced, both
    ways, and summed up.  What neither has is priced once, from its number.
4.  Terms are ranked by a window that keeps ``TOP_TERMS`` rows per group and task before the shuffle.

Shares are ``1 + floor(10^9 * (count + 1) / (total + V))``, by long division in three steps of three
digits: exact in 64 bits up to 9 * 10^15 occurrences in a group.

A text's terms are counted in one piece, as it adds one to a term's documents however long it is.

Contracts: null lang, source or text count as ''.  A group without terms has rows for its pairs (0 in
a language without kept terms).  A language with one source has no pairs.  Equal values go by the
item's UTF-8 bytes.  Repeated rows count as documents of their own; rows need no id.  Other columns
are left out, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.byte_words import LETTER_BYTES, SpanTable, split, windows
from rillflow.llm.common import map_arrow, ship, text_slices
from rillflow.operators.joins import fits_broadcast
from rillflow.operators.keys import dense_numbers
from rillflow.session import pin

MIN_DOCS, TOP_TERMS = 3, 200
#: Term ids of a chunk.
CHUNK = 1 << 16
#: Bytes of text split at once, and words interned at once.
SLICE, WINDOW = 8 << 20, 1 << 19


def text_column(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang, source, term, n, docs``; a row with null term has the group's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, SLICE):
                yield from counted(part)

    rows = docs.select(text_column(lang).alias("lang"), text_column(source).alias("source"), text_column(text).alias("text"))
    found = map_arrow(rows, run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def counted(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term in each group of a batch; one window holds whole texts' runs."""
    groups = pc.binary_join_element_wise(part["lang"], part["source"], "\x00").dictionary_encode()
    group = groups.indices.to_numpy()
    firsts = np.unique(group, return_index=True)[1]
    langs, sources = part["lang"].take(firsts), part["source"].take(firsts)

    def rows(of: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [langs.take(of), sources.take(of), terms.cast(pa.string()), pa.array(n), pa.array(docs)],
            names=["lang", "source", "term", "n", "docs"],
        )

    size = np.bincount(group, minlength=len(firsts))
    yield rows(np.arange(len(firsts)), pa.nulls(len(firsts), pa.string()), np.zeros(len(firsts), np.int64), size)
    words = split(part["text"], LETTER_BYTES)
    owner = np.repeat(np.arange(len(part)), np.diff(words.first))
    for at in whole_texts(words.first, WINDOW):
        word = np.arange(words.first[at.start], words.first[at.stop])
        if not len(word):
            continue
        spans = words.cut(word, word)
        table = SpanTable(spans)
        # one entry per (text, term), then one per (group, term)
        number = np.zeros(len(table.owner), np.int64)
        number[table.used] = np.arange(len(table.used))
        width = len(table.used)
        in_text, n = np.unique((owner[word] - at.start) * width + number[table.slot], return_counts=True)
        key = group[at.start + in_text // width].astype(np.int64) * width + in_text % width
        keys, place = np.unique(key, return_inverse=True)
        total = np.bincount(place, n).astype(np.int64)
        in_docs = np.bincount(place).astype(np.int64)
        for some in windows(len(keys), 1 << 16):
            term = spans.text(table.owner[table.used[keys[some] % width]])
            yield rows(keys[some] // width, term, total[some], in_docs[some])


def whole_texts(first: np.ndarray, size: int) -> Iterator[slice]:
    """Consecutive texts with about ``size`` words; a longer text stands alone."""
    at, n = 0, len(first) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(first, first[at] + size, "right")) - 1)
        yield slice(at, stop)
        at = stop


def share_column(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 * (n + 1) / (total + terms))``, exactly."""
    whole, rest = F.lit(0).cast("long"), n + 1
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + _div(rest, total + terms)
        rest = rest % (total + terms)
    return whole + 1


def _div(a: Column, b: Column) -> Column:
    """Whole quotient of two non-negative longs."""
    return F.call_function("div", a, b)


def price_column(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def shares(n: np.ndarray, whole: int) -> np.ndarray:
    """As ``share_column``, for counts of one group; ``whole`` is its total plus the kept terms."""
    out, rest = np.zeros(len(n), np.int64), n + 1
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def prices(p: np.ndarray, q: np.ndarray) -> int:
    return int(((p - q) * (p - q) // q).sum())


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of ``few`` the place in ``many`` of the first entry not below it; both ascending.

    Every 32nd entry is placed first.  The others start from the place of the one before them and
    double their step until they have passed their value, then halve it.
    """
    if len(few) <= 32:
        low = np.zeros(len(few), np.int64)
    else:
        low = np.repeat(gallop(few[::32], many), 32)[: len(few)]
    step = np.ones(len(few), np.int64)
    high = low.copy()
    busy = np.flatnonzero(high < len(many))
    busy = busy[many[high[busy]] < few[busy]]
    while len(busy):
        low[busy] = high[busy] + 1
        high[busy] += step[busy]
        step[busy] *= 2
        busy = busy[high[busy] < len(many)]
        busy = busy[many[high[busy]] < few[busy]]
    high = np.minimum(high, len(many))
    busy = np.flatnonzero(low < high)
    while len(busy):
        middle = (low[busy] + high[busy]) // 2
        below = many[middle] < few[busy]
        low[busy[below]] = middle[below] + 1
        high[busy[~below]] = middle[~below]
        busy = busy[low[busy] < high[busy]]
    return low


def merged(ids_a, n_a, ids_b, n_b, whole_a: int, whole_b: int) -> tuple[int, int, int]:
    """Price of a's shares against b's, of b's against a's, and how many terms either has."""
    if len(ids_a) > len(ids_b):
        backward, forward, union = merged(ids_b, n_b, ids_a, n_a, whole_b, whole_a)
        return forward, backward, union
    place = gallop(ids_a, ids_b)
    both = place < len(ids_b)
    both[both] = ids_b[place[both]] == ids_a[both]
    only_b = np.ones(len(ids_b), bool)
    only_b[place[both]] = False
    zero = np.zeros(1, np.int64)
    p, q = shares(n_a, whole_a), shares(n_b, whole_b)
    p0, q0 = shares(zero, whole_a), shares(zero, whole_b)
    against = q[place[both]]
    forward = prices(p[both], against) + prices(p[~both], q0) + prices(p0, q[only_b])
    backward = prices(against, p[both]) + prices(q0, p[~both]) + prices(q[only_b], p0)
    return forward, backward, len(ids_a) + int(only_b.sum())


def pair_sums(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, one, two, forward, backward, union`` for each unordered pair of sources with a term.

    ``groups``: ``lang, source, total, terms``; ``entries``: ``lang, source, id, n``.
    """
    chunk = F.expr(f"id div {CHUNK}")
    arrays = pin(
        entries.groupBy("lang", "source", chunk.alias("chunk"))
        .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("at"))  # at most CHUNK entries
        .join(groups, ["lang", "source"])
        .select(
            "lang", "source", "chunk", (F.col("total") + F.col("terms")).alias("whole"),
            F.col("at.id").alias("ids"), F.col("at.n").alias("n"),
        )
    )
    others = groups.select("lang", F.col("source").alias("other"))
    told = pairs_of(arrays, others)
    wholes = groups.select("lang", "source", (F.col("total") + F.col("terms")).alias("whole"))

    def side(which: str, mine: str, theirs: str) -> DataFrame:
        names = {"lang": "lang", "source": mine, "other": theirs, "chunk": "chunk", "whole": "whole", "ids": "ids", "n": "n"}
        rows = told.where(which).select(*[F.col(c).alias(n) for c, n in names.items()])
        return rows.join(wholes.withColumnsRenamed({"source": theirs, "whole": "else"}), ["lang", theirs])

    left, right = side("source < other", "one", "two"), side("source > other", "two", "one")
    key = ["lang", "one", "two", "chunk"]
    schema = "lang string, one string, two string, forward long, backward long, union long"

    def task(a: pa.Table, b: pa.Table) -> pa.Table:
        def arrays_of(t: pa.Table):
            if not len(t):
                none = np.zeros(0, np.int64)
                return none, none
            return (np.asarray(t[c].combine_chunks().flatten(), np.int64) for c in ("ids", "n"))

        some = a if len(a) else b
        whole_a = (a["whole"] if len(a) else b["else"])[0].as_py()
        whole_b = (b["whole"] if len(b) else a["else"])[0].as_py()
        sums = merged(*arrays_of(a), *arrays_of(b), whole_a, whole_b)
        names = [some[c][:1] for c in ("lang", "one", "two")]
        return pa.Table.from_arrays(
            [*names, *[pa.array([x], pa.int64()) for x in sums]],
            names=["lang", "one", "two", "forward", "backward", "union"],
        )

    ship(entries.sparkSession)
    tasks = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(task, schema)
    return tasks.groupBy("lang", "one", "two").agg(*[F.sum(c).alias(c) for c in ("forward", "backward", "union")])


def pairs_of(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Rows once for each other source of their language; the result's own pairs, each of them wanted."""
    named = F.broadcast(others) if fits_broadcast(others) else others
    return rows.join(named, "lang").where(F.col("source") != F.col("other"))


def audit(
    docs: DataFrame, *, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS,
    text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank``: the pairs of each group and its own terms."""
    counts = pin(term_counts(docs, text, lang, source))
    known = counts.where(F.col("term").isNotNull())
    vocabulary = dense_numbers(
        known.groupBy("lang", "term")
        .agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("in_lang"))
        .where(F.col("in_docs") >= min_docs)
        .drop("in_docs"),
        ["lang", "term"], "id", start=0,
    )
    vocabulary = pin(vocabulary)
    entries = pin(known.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "id", "n", "in_lang"))
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = pin(
        counts.where(F.col("term").isNull())
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"])
    )
    pairs = pair_part(pair_sums(entries, groups.select("lang", "source", "total", "terms")), groups)
    return ranked(pairs).unionByName(ranked(term_part(entries, groups), top_terms))


def pair_part(sums: DataFrame, groups: DataFrame) -> DataFrame:
    both = F.array(
        F.struct(F.col("one").alias("source"), F.col("two").alias("item"), F.col("forward").alias("value")),
        F.struct(F.col("two").alias("source"), F.col("one").alias("item"), F.col("backward").alias("value")),
    )
    ways = sums.select("lang", "union", F.inline(both))
    mine = pairs_of(groups.select("lang", "source", "total", "terms"), groups.select("lang", F.col("source").alias("other")))
    other = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("other_total"))
    pairs = mine.withColumnRenamed("other", "item").join(other, ["lang", "item"])
    pairs = pairs.join(ways, ["lang", "source", "item"], "left").na.fill(0, ["value", "union"])
    none = F.lit(0).cast("long")
    p0, q0 = share_column(none, F.col("total"), F.col("terms")), share_column(none, F.col("other_total"), F.col("terms"))
    absent = (F.col("terms") - F.col("union")) * price_column(p0, q0)
    value = F.when(F.col("terms") > 0, F.col("value") + absent).otherwise(none)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))


def term_part(entries: DataFrame, groups: DataFrame) -> DataFrame:
    sized = F.broadcast(groups) if fits_broadcast(groups) else groups
    p = share_column(F.col("n"), F.col("total"), F.col("terms"))
    q = share_column(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    priced = entries.where("n > 0").join(sized, ["lang", "source"]).withColumns({"p": p, "q": q})
    value = price_column(F.col("p"), F.col("q"))
    return priced.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value")
    )


def ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if top is None else out.where(F.col("rank") <= top)
