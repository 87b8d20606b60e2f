"""SimHash near duplicates by pigeonring filtering.

1.  A text's fingerprint: of each bit of the XXH64 of its word shingles, the majority.  Shingles are
    spans of one byte array, hashed with numpy; bits are counted in eight interleaved byte counters.
2.  Fingerprints are dealt as ``SEGMENTS`` bytes on a ring.  If two differ in at most ``BUDGET`` bits,
    then from some byte on every chain of l bytes differs in at most ``floor(l * BUDGET / SEGMENTS)``
    bits.  So the first two bytes of the chain are equal, and of the next three, which differ in one
    bit at most, two are: each distinct fingerprint is filed under four such bytes, for 8 starts and
    3 choices.
3.  Rows of one file entry meet in a sorted stream.  Pairs are pruned by the budgets of the chains of
    five and seven bytes before the full Hamming check.  A task emits a spanning forest of the links,
    not pairs.
4.  An entry with over ``LIMIT`` fingerprints passes through unpaired and is filed again, under one of
    four parts of the bits it leaves open: pairs differ in three of them at most, so one part is equal.
    Each time fewer bits are open; 10 open bits have no more than ``LIMIT`` values, so this ends, with
    all links and no task that holds a large entry.
5.  Components of the forests (written out at each step) name the groups.

Contracts: null text counts as empty.  Texts without words have fingerprint zero and are linked like
others.  A component's id is its smallest doc_id, null if it has none.  Repeated rows and null ids
are rows of their own.  Columns other than id and text are left out, whatever their names.  An empty
table gives no rows.  A long text is hashed in windows of ``WINDOW`` shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.byte_words import BLANK_BYTES, Words, split, windows, xxh64
from rillflow.llm.common import map_arrow, text_slices
from rillflow.llm.jaccard_join import components
from rillflow.operators.joins import lookup
from rillflow.session import pin

SHINGLE, SEED = 3, 42
BITS, SEGMENTS, BUDGET = 64, 8, 3
LIMIT = 1024
SLICE, WINDOW = 4 << 20, 1 << 18
_WIDTH = BITS // SEGMENTS


def fingerprints_of(words: Words) -> np.ndarray:
    """Unsigned fingerprint of each text."""
    low, high, sizes = words.runs(SHINGLE, whole_if_short=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ones = np.zeros((len(sizes), BITS), np.int64)
    every = np.uint64(0x0101010101010101)
    for part in windows(len(low), WINDOW):
        h = xxh64(words.cut(low[part], high[part]), SEED)
        mine = owner[part]
        # stretches of one text, of at most 255 hashes, so that byte counters do not overflow
        begins = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        counts = -(-np.diff(np.append(begins, len(mine))) // 255)
        nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(begins, counts) + 255 * nth
        texts, stretch = mine[begins], np.cumsum(counts) - counts
        for k in range(8):
            sums = np.add.reduceat((h >> np.uint64(k)) & every, starts)
            # byte j of a sum counts bit 8j + k
            counters = sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            ones[texts, k::8] += np.add.reduceat(counters, stretch, axis=0)
    bits = (2 * ones > sizes[:, None]).astype(np.uint64)
    return (bits << np.arange(BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, fp``: the fingerprint's 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, SLICE):
                fp = fingerprints_of(split(part["text"], BLANK_BYTES))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_arrow(rows, run, "doc_id long, fp long")


def budget(length: int) -> int:
    """Bits in which a chain of so many segments may differ."""
    return length * BUDGET // SEGMENTS


#: Lengths of chains after which one more bit is allowed; the budgets of the others follow.
CHAINS = [n for n in range(1, SEGMENTS + 1) if n == SEGMENTS or budget(n + 1) > budget(n)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def segment_mask(i: int) -> int:
    return ((1 << _WIDTH) - 1) << (i % SEGMENTS) * _WIDTH


def entries_of_ring() -> list[tuple[int, int]]:
    """``(start, mask)``: the equal segments of each start and choice."""
    equal = max(n for n in range(SEGMENTS) if budget(n) == 0)
    within_one = max(n for n in range(SEGMENTS) if budget(n) <= 1)
    out = []
    for start in range(SEGMENTS):
        for left_out in range(equal, within_one):
            kept = [i for i in range(within_one) if i != left_out]
            out.append((start, signed(sum(segment_mask(start + i) for i in kept))))
    return out


def finer(mask: int) -> list[int]:
    """The mask with one of four parts of the bits it leaves open."""
    open_bits = [b for b in range(BITS) if not mask >> b & 1]
    parts = np.array_split(open_bits, BUDGET + 1)
    return [mask | sum(1 << int(b) for b in part) for part in parts if len(part)]


def near_pairs(fp: np.ndarray, start: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs inside groups (consecutive rows), by the chains from each group's start."""
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
    last = ends[np.searchsorted(ends, np.arange(len(group)), "right")] if len(group) else ends
    at, a_out, b_out = np.arange(len(group)), [], []
    step = 1
    while True:
        at = at[at + step < last[at]]
        if not len(at):
            break
        gap = fp[at] ^ fp[at + step]
        turn = (start[at] * _WIDTH).astype(np.uint64)
        ring = (gap >> turn) | (gap << ((np.uint64(BITS) - turn) & np.uint64(BITS - 1)))
        alive = np.arange(len(at))
        for length in CHAINS:
            chain = np.uint64((1 << length * _WIDTH) - 1)
            alive = alive[np.bitwise_count(ring[alive] & chain) <= budget(length)]
        a_out.append(at[alive])
        b_out.append(at[alive] + step)
        step += 1
    none = np.zeros(0, np.int64)
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest row that each of n rows is linked to: labels fall until neighbours agree."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def meet(filed: DataFrame, limit: int) -> DataFrame:
    """``id, to`` of links, and ``start, mask, id`` of what must be filed more finely.

    ``filed``: ``start, mask, fp``.
    """
    names = ["id", "to", "start", "mask"]

    def rows_of(fp, to=None, start=None, mask=None) -> pa.RecordBatch:
        def column(x):
            return pa.nulls(len(fp), pa.int64()) if x is None else pa.array(x.astype(np.int64))

        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), column(to), column(start), column(mask)], names=names)

    def linked(fp, start, mask, group) -> pa.RecordBatch:
        a, b = near_pairs(fp, start, group)
        root = forest(len(fp), a, b)
        some = np.flatnonzero(root != np.arange(len(fp)))
        return rows_of(fp[some], fp[root[some]].view(np.int64))

    def too_many(fp, start, mask) -> Iterator[pa.RecordBatch]:
        for child in finer(int(mask[0]) & (1 << BITS) - 1):
            yield rows_of(fp, None, start, np.full(len(fp), signed(child)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.uint64, np.int64, np.int64)]
        passing = None  # the large entry whose rows pass through
        for batch in batches:
            new = [batch[c].to_numpy() for c in ("fp", "start", "mask")]
            fp, start, mask = (np.concatenate([h, n.astype(h.dtype)]) for h, n in zip(held, new))
            value = fp & mask.view(np.uint64)
            changed = (value[1:] != value[:-1]) | (mask[1:] != mask[:-1]) | (start[1:] != start[:-1])
            begins = np.concatenate([[0], np.flatnonzero(changed) + 1]) if len(fp) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(begins, len(fp)))
            group = np.repeat(np.arange(len(begins)), sizes)
            large = sizes > limit
            if passing is not None and len(fp) and (start[0], mask[0], value[0]) == passing:
                large[0] = True
            for g in np.flatnonzero(large):
                part = slice(begins[g], begins[g] + sizes[g])
                yield from too_many(fp[part], start[part], mask[part])
            rest = ~large[group]
            if len(fp):
                passing = (start[-1], mask[-1], value[-1]) if large[-1] else None
                if not large[-1]:  # may go on in the next batch
                    rest[begins[-1] :] = False
                    held = [x[begins[-1] :] for x in (fp, start, mask)]
                else:
                    held = [x[:0] for x in (fp, start, mask)]
            yield linked(fp[rest], start[rest], mask[rest], group[rest])
        fp, start, mask = held
        yield linked(fp, start, mask, np.zeros(len(fp), np.int64))

    value = F.col("fp").bitwiseAND(F.col("mask"))
    dealt = filed.repartition("start", "mask", value).sortWithinPartitions("start", "mask", value)
    return map_arrow(dealt, run, "id long, to long, start long, mask long")


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``id, to``: a spanning forest, in pieces, of the links between distinct fingerprints ``fp``."""
    if limit < LIMIT:  # entries of 10 open bits must fit
        raise ValueError(f"limit must be at least {LIMIT}")
    ring = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(m).cast("long").alias("mask")) for s, m in entries_of_ring()])
    filed = distinct.select("fp", F.explode(ring).alias("at")).select("at.start", "at.mask", "fp")
    found = []
    while True:
        met = pin(meet(filed, limit))
        found.append(met.where(F.col("to").isNotNull()).select("id", "to"))
        again = met.where(F.col("to").isNull())
        if again.isEmpty():
            break
        # one entry may be reached from several larger ones
        filed = again.select("start", "mask", F.col("id").alias("fp")).distinct()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", limit: int = LIMIT) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row."""
    made = pin(fingerprints(docs, text, doc_id))
    distinct = pin(made.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp"), limit))
    named = distinct.join(roots.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    table = pin(named.join(lowest, "root").select("fp", "component_id"))
    return lookup(made, table, "fp", row_id="doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
