"""Words of many texts as spans of one byte array, hashed and compared with numpy.

``split`` folds A-Z, turns each run of separators into one blank and gives each word's span.  A run
of n words is then one span of the same array, with single blanks between the words, so n-grams need
no strings of their own.  Separators are ASCII, so bytes of longer UTF-8 characters are never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BLANK = 32
#: Spans handled at once, so that the intermediate arrays stay in cache.
_CHUNK = 1 << 15
#: Longer spans are hashed and compared one by one.
_LONG = 256


def byte_map(separators: str) -> np.ndarray:
    """Per byte what it becomes; ``separators``: inclusive ranges of hexadecimal codes, ``00-2F 3A-60``.

    A-Z are folded first, so ranges that hold them do not make them separators.
    """
    out = np.arange(256, dtype=np.uint8)
    for part in separators.split():
        low, _, high = part.partition("-")
        out[int(low, 16) : int(high or low, 16) + 1] = _BLANK
    out[65:91] = out[97:123]
    return out


# The separators of the contracts.
WORD_BYTES = byte_map("00-2F 3A-60 7B-7F")
LETTER_BYTES = byte_map("00-40 5B-60 7B-7F")
BLANK_BYTES = byte_map("20 09-0D")


@dataclass
class Spans:
    """``starts`` and ``ends`` (exclusive) in ``data``; no span is empty."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def lengths(self) -> np.ndarray:
        return self.ends - self.starts

    @cached_property
    def lanes(self) -> np.ndarray:
        """At each byte the eight bytes from there as one little-endian number."""
        whole = -(-len(self.data) // 8) * 8
        padded = np.zeros(whole + 8, np.uint8)
        padded[: len(self.data)] = self.data
        out = np.empty(whole, np.uint64)
        for k in range(8):
            out[k::8] = np.frombuffer(padded, "<u8", whole // 8, k)
        return out

    def bytes_at(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def text(self, some: np.ndarray) -> pa.Array:
        """The chosen spans as strings, cut out of the array without a loop."""
        lengths = self.lengths[some]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(offsets[-1]) + np.repeat(self.starts[some] - offsets[:-1], lengths)
        return pa.LargeStringArray.from_buffers(
            len(some), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[places])
        )


@dataclass
class Words(Spans):
    """Words of texts in order; text t has the words from ``first[t]`` to before ``first[t + 1]``."""

    first: np.ndarray

    def runs(self, n: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word and last word of each run of n words inside a text, and runs per text.

        With ``whole_if_short`` a text of fewer words has one run, all its words.
        """
        sizes = np.diff(self.first)
        counts = np.maximum(sizes - n + 1, 0)
        if whole_if_short:
            counts = np.where((counts == 0) & (sizes > 0), 1, counts)
        before = np.concatenate([[0], np.cumsum(counts)])
        low = np.arange(before[-1]) + np.repeat(self.first[:-1] - before[:-1], counts)
        high = np.minimum(low + n, np.repeat(self.first[1:], counts)) - 1
        return low, high, counts

    def cut(self, low: np.ndarray, high: np.ndarray) -> Spans:
        """Spans from word ``low`` to word ``high`` (both ascending), over the part of the bytes they need."""
        if not len(low):
            return Spans(self.data[:0], self.starts[:0], self.ends[:0])
        begin, end = self.starts[low.min()], self.ends[high.max()]
        return Spans(self.data[begin:end], self.starts[low] - begin, self.ends[high] - begin)


def split(texts: pa.Array, become: np.ndarray) -> Words:
    """Words of ``texts``; a null text has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    empty, blank = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    closed = pc.binary_join_element_wise(texts, empty, blank)
    _, offsets, data = closed.buffers()
    offsets = np.frombuffer(offsets, np.int64)[closed.offset : closed.offset + len(closed) + 1]
    if not len(closed) or data is None:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), none, none, np.zeros(len(closed) + 1, np.int64))
    folded = become[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]
    apart = folded == _BLANK
    kept = ~apart
    closing = np.flatnonzero(kept[:-1] & apart[1:]) + 1  # each text ends with a blank
    first = np.searchsorted(closing, offsets - offsets[0])
    kept[closing] = True
    data = folded[kept]
    ends = np.flatnonzero(data == _BLANK)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    return Words(data, starts, ends, first)


def windows(n: int, size: int) -> Iterator[slice]:
    for at in range(0, n, size):
        yield slice(at, min(n, at + size))


# The primes of XXH64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    )
)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _mix(x: np.ndarray) -> np.ndarray:
    return _turn(x * _P2, 31) * _P1


def xxh64(spans: Spans, seed: int = 0) -> np.ndarray:
    """Unsigned XXH64 of each span's bytes."""
    out = np.empty(len(spans), np.uint64)
    with np.errstate(over="ignore"):  # all sums are modulo 2^64
        for part in windows(len(spans), _CHUNK):
            out[part] = _xxh64(spans.lanes, spans.starts[part], spans.lengths[part], np.uint64(seed))
    for i in np.flatnonzero(spans.lengths > _LONG):
        out[i] = xxhash.xxh64_intdigest(spans.bytes_at(i), seed)
    return out


def _xxh64(lanes: np.ndarray, at: np.ndarray, lengths: np.ndarray, seed: np.uint64) -> np.ndarray:
    h = np.full(len(at), seed + _P5, np.uint64)
    at, rest = at.copy(), np.where(lengths > _LONG, 0, lengths)
    wide = np.flatnonzero(rest >= 32)
    if len(wide):
        sums = [np.full(len(wide), s, np.uint64) for s in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
        where, left = at[wide], rest[wide]
        busy = np.arange(len(wide))
        while len(busy):
            for k in range(4):
                lane = lanes[where[busy] + 8 * k]
                sums[k][busy] = _turn(sums[k][busy] + lane * _P2, 31) * _P1
            where[busy] += 32
            left[busy] -= 32
            busy = busy[left[busy] >= 32]
        merged = _turn(sums[0], 1) + _turn(sums[1], 7) + _turn(sums[2], 12) + _turn(sums[3], 18)
        for s in sums:
            merged = (merged ^ _mix(s)) * _P1 + _P4
        h[wide] = merged
        at[wide], rest[wide] = where, left
    h += lengths.astype(np.uint64)
    while True:
        more = rest >= 8
        if not more.any():
            break
        lane = lanes[np.where(more, at, 0)]
        h = np.where(more, _turn(h ^ _mix(lane), 27) * _P1 + _P4, h)
        at += 8 * more
        rest = rest - 8 * more
    lane = lanes[np.minimum(at, len(lanes) - 1)]  # what is left, up to seven bytes
    more = rest >= 4
    h = np.where(more, _turn(h ^ ((lane & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3, h)
    lane = np.where(more, lane >> np.uint64(32), lane)
    rest = rest - 4 * more
    for k in range(3):
        h = np.where(rest > k, _turn(h ^ ((lane & np.uint64(0xFF)) * _P5), 11) * _P1, h)
        lane = lane >> np.uint64(8)
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def crc32(spans: Spans, some: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of the chosen spans."""
    starts, lengths = spans.starts[some], spans.lengths[some]
    order = np.argsort(-lengths)
    starts, lengths = starts[order], lengths[order]
    sums = np.full(len(some), 0xFFFFFFFF, np.uint32)
    short = int(np.searchsorted(-lengths, -_LONG))  # longer ones come first
    busy = len(some)
    for k in range(int(lengths[short]) if short < busy else 0):
        busy = int(np.searchsorted(-lengths, -k))
        part = slice(short, busy)
        seen = spans.data[starts[part] + k]
        sums[part] = _CRC[(sums[part] ^ seen) & np.uint32(255)] ^ (sums[part] >> np.uint32(8))
    sums ^= np.uint32(0xFFFFFFFF)
    for i in range(short):
        sums[i] = zlib.crc32(spans.bytes_at(some[order[i]]))
    out = np.empty_like(sums)
    out[order] = sums
    return out


def same_bytes(spans: Spans, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether spans ``a`` and ``b`` have the same bytes, pair by pair."""
    same = spans.lengths[a] == spans.lengths[b]
    unlike = np.flatnonzero(same & (a != b))
    k = 0
    while len(unlike):
        left = spans.lengths[a[unlike]] - 8 * k
        if k * 8 >= _LONG:
            for i in unlike:
                same[i] = spans.bytes_at(a[i]) == spans.bytes_at(b[i])
            break
        gap = spans.lanes[spans.starts[a[unlike]] + 8 * k] ^ spans.lanes[spans.starts[b[unlike]] + 8 * k]
        beyond = np.maximum(8 - left, 0).astype(np.uint64) * np.uint64(8)  # bytes that belong to what follows
        same[unlike] = (gap << beyond) == 0
        unlike = unlike[same[unlike] & (left > 8)]
        k += 1
    return same


class SpanTable:
    """The distinct spans of a batch, in an open-addressed table.

    Keys are XXH64 values; a slot is a span's own only if the bytes agree too, else the next one is
    tried.  All spans that look for a place take their step at the same time: those that meet a free
    slot write their number into it, the one that stays there owns it, and the others compare
    themselves with it.  ``slot`` is each span's slot, ``owner`` the span a slot belongs to.
    """

    def __init__(self, spans: Spans, keys: np.ndarray | None = None):
        keys = xxh64(spans) if keys is None else keys
        size = 1 << max(4, int(2 * len(spans)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = np.zeros(len(spans), np.int64)
        at = (keys & np.uint64(size - 1)).astype(np.int64)
        wait = np.arange(len(spans))
        while len(wait):
            here = at[wait]
            free = self.owner[here] < 0
            self.owner[here[free]] = wait[free]
            holder = self.owner[here]
            mine = keys[holder] == keys[wait]
            mine[mine] = same_bytes(spans, holder[mine], wait[mine])
            self.slot[wait[mine]] = here[mine]
            wait = wait[~mine]
            at[wait] = (at[wait] + 1) & (size - 1)

    @cached_property
    def used(self) -> np.ndarray:
        return np.flatnonzero(self.owner >= 0)

    @cached_property
    def counts(self) -> np.ndarray:
        """Occurrences by slot."""
        return np.bincount(self.slot, minlength=len(self.owner))
