"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact check.

Texts are sequences of folded words.  A Chakraborty-Goldenberg-Koucky random walk turns a sequence
into a longer one: at step ``i`` it writes the current word and moves on if a random bit of
``(i, word)`` says so.  Two sequences that are few edits apart then agree in most places, so
samples of a few places make hash keys that often collide.  Each repetition has a walk and a sample
of its own.  The number of repetitions is measured, not assumed: for every class of item lengths,
items with the largest allowed number of random edits are hashed until the target recall is met.

Items are grouped in classes of similar length; the windows of a class are as long as its shortest
item and start at every word of every text.  An edit spoils at most two word pairs and three
triples, so a window can only match if all but so many for each allowed edit occur in items; these
counts are a lossless filter, and only windows that pass it walk.  What
collides is verified by the exact edit distance of the whole item to the best stretch of the text
that starts near the window.

The items are a stated query set: they go to the tasks in blocks of ``BLOCK_WORDS`` words, one pass
over the documents for each block, so what is sent to a task is bounded.  No shuffle, no group: a
passage that all documents share costs each document the same.

Null text has no words; null or empty items match nothing; repeated items and documents each give
their own rows; extra columns are left out.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import blank_split, map_arrow, row_key, text_slices, whole_text, without_empty
from rillflow.operators.joins import fits_broadcast
from rillflow.session import pin

BLOCK_WORDS = 500_000
#: Bytes of text whose windows walk side by side, about.
SLICE_BYTES = 1 << 23
#: Places sampled for a key.
SAMPLED = 3
#: Walks tried for a class of items; where they miss the target recall, every window that passes the
#: lossless filter is compared with every item of the class instead.
MAX_REPEATS = 120
TARGET_RECALL = 0.99
#: Edits allowed: one in so many words of the item.
WORDS_PER_EDIT = 6
#: Items shorter than this are too short to be told from ordinary phrases, except word for word.
SHORT = 6


def folded(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words without punctuation at their ends, and each text's number of words."""
    words, sizes = blank_split(pc.utf8_lower(texts))
    return without_empty(pc.ascii_trim(words, string.punctuation), sizes)


def word_code(word: str) -> int:
    """Positive code of a word; 0 stands for a word that is in no item."""
    return (xxhash.xxh64_intdigest(word) >> 1) | 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def allowed(n: int) -> int:
    return 0 if n < SHORT else n // WORDS_PER_EDIT


@dataclass
class Repeat:
    seed: int
    places: np.ndarray  # sampled steps of the walk, ascending


def draw_repeats(length: int, count: int, number: int) -> list[Repeat]:
    """Walks and samples for windows of ``length`` words; the same on every run."""
    rng = np.random.default_rng([length, number])
    steps = max(SAMPLED, 2 * length - 2)
    return [
        Repeat(int(rng.integers(1, 2**62)), np.sort(rng.choice(steps, SAMPLED, replace=False)))
        for _ in range(count)
    ]


def walk_keys(
    numbers: np.ndarray, code: np.ndarray, starts: np.ndarray, length: int, repeat: Repeat
) -> np.ndarray:
    """Key of each window ``numbers[start : start + length]``; all windows walk side by side.

    ``code`` has the random code of each word number; the walk's bits are the bits of the code
    mixed with the repetition's seed, 64 steps from one mixing.
    """
    at = starts.astype(np.int64)
    end, top = at + length, len(numbers) - 1
    key = np.full(len(at), repeat.seed, np.uint64)
    places = set(repeat.places.tolist())
    for step in range(int(repeat.places[-1]) + 1):
        if step % 64 == 0:
            bits = mixed(code + np.uint64((repeat.seed + step * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        # beyond its end a window has the word 0
        word = numbers[np.minimum(at, top)] * (at < end)
        if step in places:
            key = mixed(key * np.uint64(31) + code[word])
        at = at + ((bits[word] >> np.uint64(step % 64)) & np.uint64(1)).view(np.int64)
    return key


def edited(numbers: np.ndarray, edits: int, rng) -> np.ndarray:
    """A copy with that many random words put in, taken out or replaced."""
    out = numbers.tolist()
    for _ in range(edits):
        kind, i = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0:
            out[i] = 0
        elif kind == 1:
            out.insert(i, 0)
        elif len(out) > 1:
            del out[i]
    return np.array(out, np.int64)


def distance(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits from ``item`` to a stretch of ``region``, and that stretch ``[start, end)``."""
    m = len(region)
    cost = np.zeros(m + 1, np.int64)  # a stretch may start anywhere
    begin = np.arange(m + 1)
    for i, word in enumerate(item):
        skip = cost + 1
        replace = cost[:-1] + (region != word)
        new = skip.copy()
        origin = begin.copy()
        better = replace < new[1:]
        new[1:] = np.where(better, replace, new[1:])
        origin[1:] = np.where(better, begin[:-1], origin[1:])
        new[0], origin[0] = i + 1, 0
        # words put in: new[j] = min over k <= j of new[k] + j - k
        shifted = new - np.arange(m + 1)
        best = np.minimum.accumulate(shifted)
        first = np.maximum.accumulate(np.where(shifted == best, np.arange(m + 1), 0))
        cost, begin = best + np.arange(m + 1), origin[first]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


class Matcher:
    """Index of one block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], target: float = TARGET_RECALL):
        self.items: list[tuple[int | None, np.ndarray]] = []  # word numbers
        words, sizes = folded(pa.array([t or "" for _, t in items], pa.string()))
        coded = words.dictionary_encode()
        self.words = coded.dictionary  # numbered from 1 on
        numbers = np.split(coded.indices.to_numpy() + 1, np.cumsum(sizes)[:-1])
        self.items += [
            (i, n.astype(np.int64)) for (i, _), n in zip(items, numbers) if len(n)
        ]
        self.code = np.array([0, *[word_code(w) for w in self.words.to_pylist()]], np.uint64)
        self.grams = {
            q: np.unique(np.concatenate([np.zeros(0, np.uint64), *[self._gram(n, q) for _, n in self.items]]))
            for q in (2, 3)
        }
        self.classes = [self._class(n, longest, target) for n, longest in self._bounds()]

    def _bounds(self) -> list[tuple[int, int]]:
        lengths = sorted({len(c) for _, c in self.items})
        bounds: list[tuple[int, int]] = []
        for n in lengths:
            if bounds and n <= bounds[-1][0] * 1.3 + 1:
                bounds[-1] = (bounds[-1][0], n)
            else:
                bounds.append((n, n))
        return bounds

    def _class(self, length: int, longest: int, target: float):
        own = [i for i, (_, c) in enumerate(self.items) if length <= len(c) <= longest]
        # Edits may take words out before the window's end, so items are hashed at their start.
        repeats = self._enough(own, length, target)
        edits = max(allowed(len(self.items[i][1])) for i in own)
        if repeats is None:
            return length, edits, None, own
        keys, which = [], []
        numbers = np.concatenate([self.items[i][1] for i in own])
        starts = np.cumsum([0] + [len(self.items[i][1]) for i in own[:-1]])
        for repeat in repeats:
            keys.append(walk_keys(numbers, self.code, starts, length, repeat))
            which.append(np.array(own))
        table = []
        for k, w in zip(keys, which):
            order = np.argsort(k, kind="stable")
            table.append((k[order], w[order]))
        return length, edits, repeats, table

    def _enough(self, own: list[int], length: int, target: float) -> list[Repeat] | None:
        """As many repetitions as find the target share of items with all edits they may have.

        None where ``MAX_REPEATS`` do not reach it.
        """
        rng = np.random.default_rng(length)
        trial = [own[i % len(own)] for i in range(200)]
        before = [self.items[i][1] for i in trial]
        after = [edited(c, allowed(len(c)), rng) for c in before]
        filler = np.zeros(length, np.int64)
        found = np.zeros(len(trial), bool)
        repeats = draw_repeats(length, MAX_REPEATS, 0)
        for n, repeat in enumerate(repeats, 1):
            sides = []
            for group in (before, after):
                numbers = np.concatenate([x for c in group for x in (c, filler)])
                starts = np.cumsum([0] + [len(c) + length for c in group[:-1]])
                sides.append(walk_keys(numbers, self.code, starts, length, repeat))
            found |= sides[0] == sides[1]
            if found.mean() >= target and n >= 4:
                return repeats[:n]
        return None

    def _gram(self, numbers: np.ndarray, q: int) -> np.ndarray:
        """A code for each run of ``q`` words."""
        out = self.code[numbers[: max(0, len(numbers) - q + 1)]]
        for k in range(1, q):
            out = mixed(out) + self.code[numbers[k : len(numbers) - q + 1 + k]]
        return out

    def _inside(self, numbers: np.ndarray, text_of: np.ndarray, q: int) -> np.ndarray:
        """How many runs of ``q`` words that items have too start before each word."""
        n = max(0, len(numbers) - q + 1)
        known = text_of[:n] == text_of[q - 1 :]
        for k in range(q):
            known = known & (numbers[k : n + k] > 0)
        at = np.flatnonzero(known)
        code = self.code[numbers[at]]
        for k in range(1, q):
            code = mixed(code) + self.code[numbers[at + k]]
        hit = np.zeros(len(numbers) + 1, np.int32)
        if len(at) and len(own := self.grams[q]):
            near = own[np.minimum(np.searchsorted(own, code), len(own) - 1)]
            hit[at[near == code] + 1] = 1
        return np.cumsum(hit, dtype=np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of the texts (0: in no item), and each text's count of words."""
        words, sizes = folded(texts)
        known = pc.fill_null(pc.index_in(words, value_set=self.words), -1)
        return known.to_numpy(zero_copy_only=False).astype(np.int64) + 1, sizes

    def find(self, numbers: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, edits, start, end)``: the best stretch for each text and item."""
        ends = np.cumsum(sizes)
        begins = ends - sizes
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        # item pairs and item triples before each word
        inside = {q: self._inside(numbers, text_of, q) for q in (2, 3)}
        strange = np.concatenate([[0], np.cumsum(numbers == 0, dtype=np.int32)])
        pairs: set[tuple[int, int]] = set()
        for length, edits, repeats, table in self.classes:
            kept = np.flatnonzero(numbers > 0) if length - 1 <= 2 * edits else None
            for q in (2, 3):
                need = length - q + 1 - q * edits
                if need > 0:
                    kept = np.arange(len(numbers)) if kept is None else kept
                    last = np.minimum(kept + length - q + 1, len(numbers))
                    kept = kept[inside[q][last] - inside[q][kept] >= need]
            # and at most one strange word for each edit, up to the text's end
            stop = np.minimum(kept + length, ends[text_of[kept]])
            kept = kept[strange[stop] - strange[kept] <= edits]
            if not len(kept):
                continue
            if repeats is None:
                pairs.update((w, i) for w in kept.tolist() for i in table)
                continue
            # Windows must not see the words of the next text.
            padded, places = self._padded(numbers, kept, ends[text_of[kept]], length)
            for repeat, (keys, which) in zip(repeats, table):
                got = walk_keys(padded, self.code, places, length, repeat)
                left = np.searchsorted(keys, got, "left")
                for w in np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == got):
                    k = left[w]
                    while k < len(keys) and keys[k] == got[w]:
                        pairs.add((int(kept[w]), int(which[k])))
                        k += 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for start, item in sorted(pairs):
            item_words = self.items[item][1]
            t, slack = int(text_of[start]), allowed(len(item_words))
            seen = best.get((t, item))
            if seen and (seen[0] == 0 or seen[1] <= start < seen[2]):
                continue
            low = max(int(begins[t]), start - slack)
            high = min(int(ends[t]), start + len(item_words) + 2 * slack)
            if np.isin(item_words, numbers[low:high]).sum() < len(item_words) - slack:
                continue  # each word of the item that is missing costs an edit
            edits, a, b = distance(item_words, numbers[low:high])
            if edits <= slack and (seen is None or edits < seen[0]):
                best[t, item] = (edits, low + a, low + b)
        return [(t, i, e, int(a - begins[t]), int(b - begins[t])) for (t, i), (e, a, b) in best.items()]

    @staticmethod
    def _padded(numbers, kept, ends, length):
        """Windows that reach beyond their text are copied out and filled up."""
        over = kept + length > ends
        if not over.any():
            return numbers, kept
        places = kept.copy()
        extra, at = [], len(numbers)
        for i in np.flatnonzero(over):
            part = numbers[kept[i] : ends[i]]
            extra += [part, np.zeros(length - len(part), np.int64)]
            places[i] = at
            at += length
        return np.concatenate([numbers, *extra]), places


def item_blocks(items: Iterable[tuple], size: int = BLOCK_WORDS) -> Iterator[list[tuple]]:
    block, words = [], 0
    for item in items:
        block.append(item)
        words += (item[1] or "").count(" ") + 1
        if words >= size:
            yield block
            block, words = [], 0
    if block:
        yield block


_matchers: dict = {}


def matcher(block: list[tuple], target: float) -> Matcher:
    """One index per worker and block."""
    key = (hash(tuple(block)), len(block), target)
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(block, target)
    return _matchers[key]


def matches(
    docs: DataFrame, benchmark: DataFrame, target: float = TARGET_RECALL,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, item_id, edits, first_word, last_word, item_words``: verified finds."""
    name = F.col(f"`{doc_id}`").cast("long").alias("doc_id")
    return finds(docs, benchmark, name, "long", target, text)


def finds(docs: DataFrame, benchmark: DataFrame, name: Column, kind: str, target: float, text: str = "text") -> DataFrame:
    """Verified finds; ``name``, of type ``kind``, tells the rows of ``docs`` apart as ``doc_id``."""
    rows = docs.select(name, whole_text(f"`{text}`").alias("text"))
    schema = f"doc_id {kind}, item_id long, edits int, first_word long, last_word long, item_words int"
    # Items are read a block at a time; the whole benchmark is never in one place.
    stream = benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator()
    out = None
    for block in item_blocks(tuple(r) for r in stream):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            own = matcher(block, target)
            for batch in (part for whole in batches for part in text_slices(whole, SLICE_BYTES)):
                found = own.find(*own.encode(batch["text"])) if own.items else []
                at = pa.array([f[0] for f in found], pa.int64())
                items = [own.items[f[1]] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].take(at),
                        pa.array([i for i, _ in items], pa.int64()),
                        pa.array([f[2] for f in found], pa.int32()),
                        pa.array([f[3] for f in found], pa.int64()),
                        pa.array([f[4] - 1 for f in found], pa.int64()),
                        pa.array([len(n) for _, n in items], pa.int32()),
                    ],
                    names=["doc_id", "item_id", "edits", "first_word", "last_word", "item_words"],
                )

        one = map_arrow(rows, run, schema)
        out = one if out is None else out.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found; rows are told apart by id and text."""
    found = finds(docs, benchmark, row_key().alias("doc_id"), "string", TARGET_RECALL)
    found = pin(found.select(F.col("doc_id").alias("_leak")).distinct())
    leaks = F.broadcast(found) if fits_broadcast(found) else found
    return docs.join(leaks, row_key() == leaks["_leak"], "left_anti")
