"""Hidden Markov language model: Baum-Welch over the whole corpus, exact likelihoods.

A text is its words and one end token.  States write words; the model's parameters are the start
and step probabilities, a few numbers, and for each state and word an expected count, a table as
large as the vocabulary.  That table is never in one place:

* ``encode`` cuts the corpus into blocks of whole texts.  A block keeps its texts as numbers of its
  own vocabulary, and hands its words over in ``lanes`` (by the word's hash).
* ``gather`` sees one lane of all blocks: it sums up a word's counts over the corpus, and returns to
  each block the sums for the words that it has.  All words of the corpus go through it.
* ``expect`` (a block and its words' counts) runs forward and backward over the training texts and
  hands the expected counts over to the lanes again: one Baum-Welch step is one ``expect`` and one
  ``gather``, with numpy inside the tasks and Spark's shuffles between them.
* ``score`` runs the scaled forward recursion over all texts.

Each word's count is first split among the states by the word's hash, without a look at the data.
Steps over the whole corpus follow until the log-likelihood of the training texts, summed up over
all blocks, rises by no more than ``RISE`` of itself twice in a row.  A word occurs once per block in
its lane, so frequent words are no hot keys.

Null text counts as empty (the end token alone).  Repeated rows are scored each; a null id counts
as the empty text for the split.  Without training texts all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import blank_split, bucket_of_id, map_arrow, ship, whole_text
from rillflow.session import pin, reducers, unpin

STATES = 4
#: Training ends after two steps in a row that raise the log-likelihood by no more than this share.
RISE = 1e-4
BLOCK_TOKENS = 4_000_000
#: Texts with more tokens are cut into pieces that lie side by side (exactly, see ``Pieces``).
CUT = 1024
SMOOTH = 0.5
#: Forward values are scaled once in so many steps, and in each where they would become this small.
EVERY, TINY = 8, 1e-20

PACK = (
    "block string, lane int, doc_ids array<long>, lengths binary, train binary, tokens binary, held binary, "
    "ids binary, words string, counts binary"
)
LANE = "lane int, block string, place binary, counts binary, share binary, sums array<double>"


_PRESS, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def squeeze(x: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return _PRESS.compress(planes)


def stretch(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(_OPEN.decompress(packed), np.uint8).reshape(4, -1)
    out = np.empty((planes.shape[1], 4), np.uint8)
    for k, plane in enumerate(planes):
        out[:, k] = plane
    return out.reshape(-1).view("<i4")


def pack_share(share: np.ndarray) -> bytes:
    """How each word's count splits among the states, in 1/65535ths; the count itself goes apart."""
    factor = 65535 / np.maximum(share @ np.ones(share.shape[1]), 1e-30)
    planes = np.empty(share.shape[::-1], "<u2")
    for plane, part in zip(planes, share.T):  # column by column, as rows are short
        plane[:] = np.rint(part * factor)
    return _PRESS.compress(planes.view(np.uint8))


def unpack_share(packed: bytes, counts: np.ndarray, states: int) -> np.ndarray:
    raw = _OPEN.decompress(packed)
    planes = np.frombuffer(raw, "<u2").reshape(states, -1)
    factor = counts / np.maximum(planes.sum(0, dtype=np.int32), 1)
    share = np.empty((planes.shape[1], states))
    for k, plane in enumerate(planes):
        np.multiply(plane, factor, out=share[:, k])
    return share


def hashed(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(w) for w in words], np.int64)


class Block:
    """Texts gathered until they fill a block."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.ids: list = []
        self.train: list[np.ndarray] = []
        self.tokens = 0

    def add(self, batch: pa.RecordBatch) -> None:
        words, sizes = blank_split(pc.ascii_lower(batch["text"]))
        self.words.append(words)
        self.sizes.append(sizes)
        self.ids += batch["doc_id"].to_pylist()
        self.train.append(batch["train"].to_numpy(zero_copy_only=False))
        self.tokens += len(words) + len(sizes)

    def take(self, more: Block) -> None:
        self.words += more.words
        self.sizes += more.sizes
        self.ids += more.ids
        self.train += more.train
        self.tokens += more.tokens

    def coded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Tokens of all texts with their ends, lengths, training flags, vocabulary."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        vocabulary = [*coded.dictionary.to_pylist(), ""]  # no word is empty: the end token
        sizes = np.concatenate(self.sizes)
        lengths = sizes + 1
        tokens = np.full(int(lengths.sum()), len(vocabulary) - 1, np.int32)
        inner = np.ones(len(tokens), bool)
        inner[np.cumsum(lengths) - 1] = False
        tokens[inner] = coded.indices.to_numpy()
        return tokens, lengths, np.concatenate(self.train).astype(bool), vocabulary


def encode(rows: DataFrame, lanes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        names = [f.split(" ")[0] for f in PACK.split(", ")]

        def flush(block: Block) -> pa.RecordBatch:
            nonlocal number
            tokens, lengths, train, vocabulary = block.coded()
            mine = np.repeat(train, lengths)
            counts = np.bincount(tokens[mine], minlength=len(vocabulary))
            word_hash = hashed(vocabulary)
            order = np.lexsort((word_hash, word_hash % lanes))  # by lane, and in a lane as ``first_gather`` numbers them
            lane = word_hash[order] % lanes
            name, number = f"{task}-{number}", number + 1
            fitted, held = (squeeze(Pieces(lengths[of]).laid(tokens[at])) for of, at in ((train, mine), (~train, ~mine)))
            out = [(name, -1, block.ids, squeeze(lengths), train.tobytes(), fitted, held, squeeze(order), None, None)]
            for part in np.split(order, np.flatnonzero(np.diff(lane)) + 1):
                words = "\n".join([vocabulary[i] for i in part])
                out.append((name, int(word_hash[part[0]] % lanes), *[None] * 6, words, squeeze(counts[part])))
            types = [
                pa.string(), pa.int32(), pa.list_(pa.int64()), *[pa.binary()] * 5, pa.string(), pa.binary()
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)], names=names
            )

        full, block = None, Block()
        for batch in batches:
            for at in range(0, len(batch), 500):
                block.add(batch.slice(at, 500))
                if full and block.tokens >= BLOCK_TOKENS // 4:
                    yield flush(full)
                    full = None
                if block.tokens >= BLOCK_TOKENS:
                    full, block = block, Block()
        if full:  # a small rest goes with the block before it
            full.take(block)
            block = full
        if block.ids:
            yield flush(block)

    return map_arrow(rows, run, PACK)


# the recursions ------------------------------------------------------------------------------
class Layout:
    """Texts side by side, longest first: step t holds the t-th token of the first ``active[t]``."""

    def __init__(self, lengths: np.ndarray):
        self.lengths, self.every = lengths, EVERY
        self.order = np.argsort(-lengths, kind="stable")
        top = int(lengths.max(initial=0))
        self.active = len(lengths) - np.cumsum(np.bincount(lengths, minlength=top + 1))[:top]
        self.first = np.cumsum(self.active) - self.active
        self.ends = self.first[lengths[self.order] - 1] + np.arange(len(lengths))  # of the texts, longest first

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    @cached_property
    def place(self) -> np.ndarray:
        rank = np.empty(len(self.lengths), np.int64)
        rank[self.order] = np.arange(len(rank))
        step = np.arange(int(self.lengths.sum())) - np.repeat(self.starts, self.lengths)
        return self.first[step] + np.repeat(rank, self.lengths)


class Pieces:
    """Long texts cut into pieces of ``CUT`` tokens, so that few steps serve many texts.

    The first pieces of all texts lie in one layout, ``heads``, the further ones in another, ``tails``,
    behind it.  ``chained`` hands over exactly what a piece needs of its neighbours.
    """

    def __init__(self, lengths: np.ndarray):
        parts = -(-lengths // CUT)
        owner = np.repeat(np.arange(len(lengths)), parts)
        level = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        sizes = np.minimum(lengths[owner] - level * CUT, CUT)
        self.first = np.repeat(level == 0, sizes)  # whether a token is in its text's first piece
        self.heads, self.tails = Layout(sizes[level == 0]), Layout(sizes[level > 0])
        self.n_heads = int(self.heads.lengths.sum())
        self.owner, level = owner[level > 0], level[level > 0]
        by_level = np.argsort(level, kind="stable")
        self.levels = np.split(by_level, np.flatnonzero(np.diff(level[by_level])) + 1) if len(level) else []

    def laid(self, values: np.ndarray) -> np.ndarray:
        """Values of all tokens, text by text, in the order of the two layouts."""
        out = np.empty_like(values)
        out[: self.n_heads][self.heads.place] = values[self.first]
        out[self.n_heads :][self.tails.place] = values[~self.first]
        return out

    def by_text(self, laid: np.ndarray) -> np.ndarray:
        out = np.empty_like(laid)
        out[self.first] = laid[: self.n_heads][self.heads.place]
        out[~self.first] = laid[self.n_heads :][self.tails.place]
        return out


def forward(layout: Layout, emit: np.ndarray, start: np.ndarray, move: np.ndarray, alpha: np.ndarray | None = None):
    """Forward values (in ``alpha``) and scales, in the layout's order; ``emit`` is in that order too.

    ``start`` is one row for all texts or one for each, longest first.  The scales of a text multiply to
    its likelihood.  Scaling is linear and undone by ``backward``, so it may wait some steps; where values
    would get too small by then, all steps are scaled.
    """
    alpha = np.empty_like(emit) if alpha is None else alpha
    alpha[:] = emit
    scale = np.ones(len(emit), emit.dtype)
    room = np.empty((int(layout.active[0]) if len(layout.active) else 0, len(move)), emit.dtype)
    step, before, ones = move.astype(emit.dtype), None, np.ones(len(move), emit.dtype)
    for t, (first, n) in enumerate(zip(layout.first.tolist(), layout.active.tolist())):
        now = alpha[first : first + n]
        now *= start if before is None else np.dot(before[:n], step, out=room[:n])
        if (t + 1) % layout.every == 0:
            scale[first : first + n] = total = now @ ones
            now /= total[:, None]
        before = now
    total = alpha[layout.ends].sum(1)
    if layout.every > 1 and not (scale.min(initial=1) > TINY and total.min(initial=1) > TINY):
        layout.every = 1
        return forward(layout, emit, start, move, alpha)
    scale[layout.ends] *= total
    return alpha, scale


def backward(layout: Layout, emit, alpha, scale, move, enter=None, leave=None):
    """State probabilities of each token (over ``alpha``), and expected starts and moves.

    Of pieces, ``enter`` has the state probabilities before the first token and ``leave`` the backward
    values after the last one, up to a factor, both longest first.
    """
    k = len(move)
    last = alpha[layout.ends]
    total = last.sum(1)
    if leave is None:
        beta = np.repeat(1 / total[:, None], k, 1)
    else:
        beta = (leave / (last * leave).sum(1)[:, None]).astype(emit.dtype)
    scale = scale.astype(emit.dtype)
    scale[layout.ends] /= total
    moves = np.zeros((k, k))
    starts = np.zeros(k)
    back = np.ascontiguousarray(move.T.astype(emit.dtype))
    room = np.empty_like(beta)
    steps = list(zip(layout.first.tolist(), layout.active.tolist()))
    for t in range(len(steps) - 1, -1, -1):
        first, n = steps[t]
        now, after = alpha[first : first + n], beta[:n]
        if t or enter is not None:
            ahead = np.multiply(emit[first : first + n], after, out=room[:n])
            if (t + 1) % layout.every == 0:
                ahead /= scale[first : first + n, None]
            at = steps[t - 1][0]
            moves += np.dot((alpha[at : at + n] if t else enter).T, ahead)
        now *= after
        if t:
            np.dot(ahead, back, out=after)
        elif enter is None:
            starts = now.sum(0, dtype=np.float64)
    return starts, moves * move


def through(layout: Layout, emit: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Each piece as one matrix, up to a factor, longest first: from the state before it to its last one."""
    k, n = len(move), int(layout.active[0]) if len(layout.active) else 0
    step, ones, least = move.astype(emit.dtype), np.ones(k, emit.dtype), 1.0
    out = step[:, None, :] * emit[:n]  # by the state before the piece, piece, last state
    room = np.empty_like(out)
    for t, (first, n) in enumerate(zip(layout.first.tolist(), layout.active.tolist())):
        now = out[:, :n]
        if t:
            np.matmul(now, step, out=room[:, :n])
            np.multiply(room[:, :n], emit[first : first + n], out=now)
        if (t + 1) % layout.every == 0:
            total = (now @ ones).sum(0)
            least = min(least, total.min())
            now /= total[:, None]
    if layout.every > 1 and not (least > TINY and out.sum((0, 2)).min(initial=1) > TINY):
        layout.every = 1
        return through(layout, emit, move)
    return np.moveaxis(out, 0, 1)


def chained(pieces: Pieces, ends: np.ndarray, matrices: np.ndarray):
    """What the tails are entered with, and what comes after the heads and the tails.

    ``ends`` are the heads' last forward values.  All are in the order of the layouts.
    """
    heads, tails = pieces.heads, pieces.tails
    k = ends.shape[1]
    unit = lambda x: x / x.sum(1, keepdims=True)
    whole, last = np.empty((len(tails.order), k, k)), np.empty(ends.shape)
    whole[tails.order], last[heads.order] = matrices, ends
    enter, after, after_heads = np.empty((len(whole), k)), np.ones((len(whole), k)), np.ones(ends.shape)
    for number, i in enumerate(pieces.levels):
        got = np.einsum("nj,njk->nk", enter[i - 1], whole[i - 1]) if number else last[pieces.owner[i]]
        enter[i] = unit(got)
    for number, i in reversed(list(enumerate(pieces.levels))):
        got = unit(np.einsum("njk,nk->nj", whole[i], after[i]))
        if number:
            after[i - 1] = got
        else:
            after_heads[pieces.owner[i]] = got
    return enter[tails.order], after_heads[heads.order], after[tails.order]


def scaled(pieces: Pieces, emit: np.ndarray, start: np.ndarray, move: np.ndarray):
    """Forward values and scales of whole texts, and what ``backward`` needs of each layout."""
    n, alpha = pieces.n_heads, np.empty_like(emit)
    _, scale = forward(pieces.heads, emit[:n], start, move, alpha[:n])
    parts = [(pieces.heads, slice(0, n), scale, None, None)]
    if pieces.levels:
        whole = through(pieces.tails, emit[n:], move)
        enter, after_heads, after = chained(pieces, alpha[:n][pieces.heads.ends], whole)
        enter = enter.astype(emit.dtype)
        _, scale = forward(pieces.tails, emit[n:], (enter @ move).astype(emit.dtype), move, alpha[n:])
        parts = [(*parts[0][:4], after_heads), (pieces.tails, slice(n, None), scale, enter, after)]
    return alpha, parts


def emissions(share: np.ndarray, sums: np.ndarray, n_words: float) -> np.ndarray:
    """Smoothed word probabilities of each state."""
    a = SMOOTH / share.shape[1]
    table = np.empty(share.shape, np.float32)
    for k, total in enumerate(sums):
        table[:, k] = (share[:, k] + a) / (total + a * (n_words + 1))
    return table


def leveled(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's probabilities over the largest of them, and the logarithm of that one."""
    top = reduce(np.maximum, table.T)
    low = np.empty_like(table)
    for k, part in enumerate(table.T):
        low[:, k] = part / top
    return low, np.log(top.astype(np.float64))


def expected(tokens, lengths, n_words, table, start, move, laid: bool = False):
    """Expected counts by word and state, of starts, and of moves; the words' counts and the log-likelihood.

    ``laid`` says that the tokens are in the order of ``Pieces`` already.
    """
    pieces = Pieces(lengths)
    tokens = (tokens if laid else pieces.laid(tokens)).astype(np.int64)
    table, top = leveled(table)
    start, move = start.astype(np.float32), move.astype(np.float32)
    emit = np.take(table, tokens, axis=0)
    alpha, parts = scaled(pieces, emit, start, move)
    starts, moves, log_p = np.zeros(len(start)), np.zeros(move.shape), 0.0
    for layout, at, scale, enter, leave in parts:
        more_starts, more_moves = backward(layout, emit[at], alpha[at], scale, move, enter, leave)
        starts, moves = starts + more_starts, moves + more_moves
        log_p += np.log(scale[scale != 1].astype(np.float64)).sum()
    share = np.stack([np.bincount(tokens, part, n_words) for part in alpha.T]).T
    own = np.bincount(tokens, minlength=n_words)
    return share, starts, moves, own, log_p + own @ top


def normal(x: np.ndarray) -> np.ndarray:
    x = x + 1e-3
    return x / x.sum(-1, keepdims=True)


# one lane of all blocks ------------------------------------------------------------------------
def hashed_split(words: list[str], states: int) -> np.ndarray:
    """How each word's count is split among the states at first; depends on the word alone."""
    x = np.array([[xxhash.xxh32_intdigest(w, k + 1) for k in range(states)] for w in words], float)
    x = -np.log((x.reshape(-1, states) + 0.5) / 2**32)
    return x / x.sum(1, keepdims=True)


def first_gather(packs: DataFrame, states: int) -> DataFrame:
    """Counts over the corpus, and their first split by state, for each block's words of a lane."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = [w.split("\n") for w in group["words"]]
        sizes = [len(p) for p in parts]
        flat = pa.array([w for p in parts for w in p], pa.string()).dictionary_encode()
        words = flat.dictionary.to_pylist()
        order = np.argsort(hashed(words), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = rank[flat.indices.to_numpy()]  # rises with the hash, so numbers in a block differ by little
        counts = np.bincount(place, np.concatenate([stretch(c) for c in group["counts"]]), len(words))
        split = hashed_split([words[i] for i in order], states)
        places = np.split(place, np.cumsum(sizes)[:-1])
        packed = [squeeze(np.diff(p, prepend=0)) for p in places]
        stats = np.zeros(states + states**2 + 1)
        return returned(group["lane"].iloc[0], group["block"], places, packed, counts, counts[:, None] * split, stats)

    words = packs.where("lane >= 0").select("lane", "block", "words", "counts")
    return words.groupBy("lane").applyInPandas(run, LANE)


def returned(lane, blocks, places: list, packed, counts: np.ndarray, share: np.ndarray, stats) -> pd.DataFrame:
    """What each block gets of a lane, and one row without block: the lane's sums."""
    out = [
        (lane, b, place, squeeze(counts[p]), pack_share(share[p]), None)
        for b, place, p in zip(blocks, packed, places)
    ]
    sums = [float((counts > 0).sum()), float(counts.sum()), *share.sum(0).tolist(), *stats]
    out.append((lane, None, None, None, None, sums))
    return pd.DataFrame(out, columns=[f.split(" ")[0] for f in LANE.split(", ")])


def gather(found: DataFrame, states: int) -> DataFrame:
    """One lane after a Baum-Welch step: expected counts summed up over the blocks."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        places = [np.cumsum(stretch(p)) for p in group["place"]]
        n = max(int(p.max(initial=-1)) for p in places) + 1
        counts, share = np.zeros(n), np.zeros((n, states))
        for p, c, s in zip(places, group["counts"], group["share"]):
            own = stretch(c)
            counts[p] += own  # a block's words are distinct
            share[p] += unpack_share(s, own, states)
        stats = sum((np.array(x, float) for x in group["sums"] if x is not None), np.zeros(states + states**2 + 1))
        return returned(group["lane"].iloc[0], group["block"], places, group["place"], counts, share, stats)

    return found.groupBy("lane").applyInPandas(run, LANE)


def totals(lanes: DataFrame, states: int) -> np.ndarray | None:
    """Distinct training words, training tokens, each state's tokens; starts, moves and the log-likelihood
    of the step that led there: a row of a few sums, none without texts."""
    width = 2 + states + states + states**2 + 1
    row = lanes.where("block is null").agg(*[F.sum(F.col("sums")[i]) for i in range(width)]).first()
    return None if row[0] is None else np.array(row)


# one block with its words' counts -----------------------------------------------------------
def opened(pack: pd.DataFrame, words: pd.DataFrame, sums: np.ndarray, states: int):
    """A block's row, its words' rows by lane, their order, lengths, training flags, counts, probabilities."""
    row, words = pack.iloc[0], words.sort_values("lane")
    order = stretch(row["ids"])
    ours, counts = [stretch(c) for c in words["counts"]], np.empty(len(order), np.int64)
    share = np.empty((len(order), states), np.float32)
    counts[order] = np.concatenate(ours)
    found = [unpack_share(s, own, states) for s, own in zip(words["share"], ours)]
    share[order] = np.concatenate(found, dtype=np.float32)
    train = np.frombuffer(row["train"], bool)
    table = emissions(share, sums[2 : 2 + states], sums[0])
    return row, words, order, stretch(row["lengths"]).astype(np.int64), train, counts, table


def with_words(docs: DataFrame, lanes: DataFrame):
    return docs.groupBy("block").cogroup(lanes.where("block is not null").drop("sums").groupBy("block"))


def expect(docs: DataFrame, lanes: DataFrame, sums, start, move, states: int) -> DataFrame:
    """The words' expected counts of each block by lane; one of a block's rows has its other sums."""

    def run(pack: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        row, words, order, lengths, train, counts, table = opened(pack, words, sums, states)
        share, starts, moves, own, log_p = expected(
            stretch(row["tokens"]), lengths[train], len(counts), table, start, move, laid=True
        )
        share, own, at = np.take(share.T, order, axis=1).T, own[order], 0  # by state, as its memory is
        stats, out = [*starts, *moves.ravel(), log_p], []
        for lane, block, place, c in zip(words["lane"], words["block"], words["place"], words["counts"]):
            end = at + len(stretch(c))
            out.append((lane, block, place, squeeze(own[at:end]), pack_share(share[at:end]), stats))
            at, stats = end, None
        return pd.DataFrame(out, columns=[f.split(" ")[0] for f in LANE.split(", ")])

    return with_words(docs, lanes).applyInPandas(run, LANE)


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def score(packs: DataFrame, lanes: DataFrame, sums, start, move, states: int) -> DataFrame:
    n_words, n_train = sums[0], sums[1]

    def run(pack: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        row, _, _, lengths, train, counts, table = opened(pack, words, sums, states)
        low, top = leveled(table)
        per_word = np.log10((counts + 0.5) / (n_train + 0.5 * (n_words + 1)))
        ids = pd.array([None if pd.isna(i) else int(i) for i in row["doc_ids"]], "Int64")
        out = []
        for of, column in ((train, "tokens"), (~train, "held")):
            if not of.any():
                continue
            pieces, laid = Pieces(lengths[of]), stretch(row[column])
            _, parts = scaled(pieces, np.take(low, laid, axis=0), start.astype(np.float32), move.astype(np.float32))
            log_p = np.log10(np.concatenate([part[2] for part in parts]).astype(np.float64)) + top[laid] / np.log(10)
            starts = np.cumsum(lengths[of]) - lengths[of]
            sum_up = lambda x: np.add.reduceat(pieces.by_text(x), starts)  # noqa: B023, E731
            out.append(
                pd.DataFrame(
                    {
                        "doc_id": ids[of],
                        "held_out": ~train[of],
                        "n_tokens": lengths[of],
                        "n_known": sum_up((counts[laid] > 0).astype(np.int64)),
                        "train_tokens": np.full(len(starts), int(n_train)),
                        "base_score": sum_up(per_word[laid]),
                        "score": sum_up(log_p),
                    }
                )
            )
        return pd.concat(out)

    docs = packs.where("lane = -1").drop("lane", "words", "counts")
    return with_words(docs, lanes).applyInPandas(run, SCORED)


def fit_and_score(
    docs: DataFrame, states: int = STATES, rise: float = RISE, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Trains on the texts whose id's crc32 modulo 5 is not 1 and scores all texts."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        whole_text(f"`{text}`").alias("text"),
        (bucket_of_id(f"`{doc_id}`", 5) != 1).alias("train"),
    )
    packs = pin(encode(rows, reducers(docs.sparkSession)))
    table, start, move, _ = trained(packs, states, rise)
    sums = totals(table, states)
    return score(packs, table, np.zeros(2 + states) if sums is None else sums, start, move, states)


def trained(packs: DataFrame, states: int, rise: float):
    """The words' table, starts and moves, and the training log-likelihood before each step."""
    start, move = np.full(states, 1 / states), normal(np.eye(states) * 20 + 1)
    table = pin(first_gather(packs, states))
    # all steps read the training texts, so they are dealt once
    docs = packs.where("lane = -1").select("block", "lengths", "train", "tokens", "ids")
    docs = docs.repartition(reducers(packs.sparkSession), "block").sortWithinPartitions("block")
    docs = docs.persist(StorageLevel.DISK_ONLY)
    seen: list[float] = []
    flat, sums = 0, totals(table, states)
    while flat < 2 and sums is not None:
        before, table = table, pin(gather(expect(docs, table, sums, start, move, states), states))
        unpin(before)
        sums = totals(table, states)
        values = sums[2 + states :]  # a few numbers: starts, moves and the log-likelihood
        start, move = normal(values[:states]), normal(values[states:-1].reshape(states, states))
        flat = flat + 1 if seen and values[-1] - seen[-1] <= rise * abs(seen[-1]) else 0
        seen.append(float(values[-1]))
    docs.unpersist()
    return table, start, move, seen
