"""Token-id files: frequency-ranked ids, byte-aligned variable-length coding, numpy decoding.

``tokenize``  text -> ids with the tokenizers library.  A text is cut before single blanks between
    two other characters, where byte-level BPE always ends a piece, and each piece is encoded once
    per worker: the joined ids equal those of the whole text.  Each task notes its counts by id.
``ranks``     ids by falling frequency over all documents (ties: smaller id first).
``write``     documents in ascending doc_id order.  An id is stored as its rank in 1 to 4 bytes,
    little-endian; the lengths stand apart, two bits each, four in a control byte.  A row of the
    Parquet container is a block of whole documents: ids, token counts, control bytes, data bytes.
``read``      the documents back, by table lookup of the control bytes in numpy.

Null text counts as empty (the end token alone).  Null doc_ids come first, repeated ones stay side
by side in the order of their checksums; extra columns are left out; an empty table makes no block.
A very long text is encoded alone and is one block of its own, however many tokens it has.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm.common import map_arrow, map_pandas, text_slices, whole_text
from rillflow.session import fresh_folder, pin, reducers

#: Tokens of a block, at least (a block ends with a document), and of a shard, about.
BLOCK_TOKENS = 1 << 18
SHARD_TOKENS = 1 << 25
#: Pieces that a worker remembers; beyond that it starts anew.  Bounds memory, not results.
KNOWN_PIECES = 500_000
#: Bytes of text that are encoded together, about.  A worker holds some 20 times as much meanwhile.
SLICE_BYTES = 1 << 22

_loaded: dict = {}


#: White space beyond ASCII, in texts with which only ASCII characters count as solid.
WIDE_BLANK = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: A piece without white space, but for one blank in front.
PLAIN = r"^ ?[^\x00-\x20\x7F\x{85}\p{Z}]+$"
MARKS = ".,!#*&%$"

_BYTE = np.arange(256)
_ASCII_LETTER = np.isin(_BYTE, [*range(65, 91), *range(97, 123)])
_SOLID = (_BYTE > 32) & (_BYTE != 127)
_MARK = np.isin(_BYTE, list(MARKS.encode()))


def letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a letter ends, and whether one begins, at each byte: ASCII and U+00C0 to U+017F alone."""
    begins, ends = _ASCII_LETTER[data], _ASCII_LETTER[data]
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    sign = (data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))  # two signs among them
    lead = lead[~sign]
    begins[lead] = True
    ends[lead + 1] = True
    return begins, ends


def cut(texts: pa.Array, at_lines: bool) -> tuple[pa.Array, np.ndarray]:
    """All texts' pieces one after another, and the number of pieces of each text.

    A piece ends before a blank between two solid characters.  With ``at_lines`` also between a
    letter and a mark, and on both sides of a line feed between two words.  Where it is not known
    that a tokenizer starts a new piece there is no cut, which is always right.
    """
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    solid = _SOLID[raw]
    odd = pc.match_substring_regex(texts, WIDE_BLANK).to_numpy(zero_copy_only=False)
    if odd.any():
        solid &= ~(np.repeat(odd, np.diff(offsets)) & (raw >= 128))
    some = offsets[:-1][np.diff(offsets) > 0]
    inner = np.ones(len(raw), bool)
    inner[some] = inner[np.append(some[1:], len(raw)) - 1] = False
    edge = np.zeros(len(raw) + 1, bool)
    edge[some] = True
    blank = np.flatnonzero((raw == 32) & inner)
    edge[blank[solid[blank - 1] & solid[blank + 1]]] = True
    if at_lines:
        begins, ends = letters(raw)
        mark = np.flatnonzero(_MARK[raw[1:]]) + 1
        edge[mark[ends[mark - 1]]] = True
        line = np.flatnonzero((raw == 10) & inner)
        before = ends[line - 1] | (raw[line - 1] == 46) | (raw[line - 1] == 44)
        line = line[before & begins[line + 1]]
        edge[line] = edge[line + 1] = True
    edge[-1] = True
    bounds = np.flatnonzero(edge)
    found = pa.LargeStringArray.from_buffers(
        len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))
    )
    return found, np.diff(np.searchsorted(bounds, offsets))


class Encoder:
    """Encodes each distinct piece once; ids of the known pieces lie one after another in a table."""

    def __init__(self, model: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        ids = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        line = ids("\n")
        # true of tokenizers that split words, marks and line feeds before they merge bytes
        joins = all(ids(f"a\n{b}") == [*ids("a"), *line, *ids(b)] for b in (" b", "b", "1", " .", "."))
        joins &= all(ids(f"the{m}") == [*ids("the"), *ids(m)] for m in MARKS)
        joins &= all(ids(f"the{m}\nb") == [*ids("the"), *ids(m), *line, *ids("b")] for m in ".,")
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        joins &= not any(a.isalpha() and b in MARKS + "\n" for t in added for a, b in zip(t, t[1:]))
        self.line = line[0] if len(line) == 1 and joins else None
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.table = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)

    def learn(self, new: pa.Array) -> pa.Array:
        """Encodes pieces, plain words a thousand at a time, as line feeds between them end a piece.

        Returns them in the order in which they are known from now on.
        """
        easy = pc.match_substring_regex(new, PLAIN) if self.line is not None else pa.array([False] * len(new))
        plain, rest = new.filter(easy).to_pylist(), new.filter(pc.invert(easy)).to_pylist()
        groups = [plain[i : i + 1_000] for i in range(0, len(plain), 1_000)]
        names, sizes, table = [], [self.sizes], [self.table]
        texts = ["\n".join(g) for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(ids == self.line)
            if len(ends) != len(group) - 1:
                rest += group
                continue
            names += group
            sizes.append(np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1)
            table.append(ids[ids != self.line])
        if rest:
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            names += rest
            sizes.append(np.array([len(i) for i in coded], np.int64))
            table.append(np.array([x for i in coded for x in i], np.uint32))
        self.table, self.sizes = np.concatenate(table), np.concatenate(sizes)
        ordered = pa.array(names, pa.large_string())
        self.known = pa.concat_arrays([self.known, ordered])
        return ordered

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the number of ids of each."""
        if len(self.known) > KNOWN_PIECES:
            self.forget()
        found, counts = cut(texts, self.line is not None)
        at = pc.index_in(found, value_set=self.known)
        which = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if at.null_count:
            before = len(self.known)
            missing = found.filter(pc.is_null(at))
            fresh = self.learn(pc.unique(missing))
            which[which < 0] = before + pc.index_in(missing, value_set=fresh).to_numpy(zero_copy_only=False)
            del missing, fresh
        del found, at  # as large as the texts, and several times
        own = self.sizes[which]
        ends = np.cumsum(own)
        starts = np.cumsum(self.sizes) - self.sizes
        place = np.repeat(starts[which] - (ends - own), own)
        del which, own, starts
        place += np.arange(len(place))
        flat = self.table[place]
        del place
        of_text = np.concatenate([[0], ends])[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        return flat, np.diff(of_text, prepend=0)


def encoder(model: str) -> Encoder:
    """The worker's encoder.  A task has one core; threads of its own would each keep memory besides."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = hash(model)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Encoder(model)
    return _loaded[key]


def squeeze(ids: bytes, press: zstandard.ZstdCompressor) -> bytes:
    planes = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
    return press.compress(np.ascontiguousarray(planes).tobytes())


def stretch(packed: bytes, press: zstandard.ZstdDecompressor) -> np.ndarray:
    planes = np.frombuffer(press.decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view("<u4")


def tokenize(docs: DataFrame, model_path: str, end_id: int | None, text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, packed``: a row per document, the end token included.

    ``counts`` is null there.  Each task adds a row of nulls with its counts by id, so that the
    frequencies need no second pass over the tokens.
    """
    model = Path(model_path).read_text(encoding="utf-8")  # one vocabulary file, of bounded size
    end = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, press = encoder(model), zstandard.ZstdCompressor(level=1)
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for part in text_slices(batch, SLICE_BYTES):
                out, n = encoded(own, part, end, press)
                size = max(len(n), len(seen))
                seen = np.pad(seen, (0, size - len(seen))) + np.pad(n, (0, size - len(n)))
                yield out
        if seen.any():
            none = [None]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": none, "n_tokens": none, "ids_crc32": none, "packed": none,
                 "counts": [press.compress(seen.astype("<i8").tobytes())]},
                TOKENS,
            )

    rows = docs.select(F.col("doc_id").cast("long"), whole_text(text).alias("text"))
    return map_arrow(rows, run, "doc_id long, n_tokens long, ids_crc32 long, packed binary, counts binary")


TOKENS = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
        ("packed", pa.binary()), ("counts", pa.binary()),
    ]
)


def encoded(
    own: Encoder, part: pa.RecordBatch, end: np.ndarray, press: zstandard.ZstdCompressor
) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of a slice of documents, and how often each id is in them."""
    flat, sizes = own.texts(part["text"])
    counts = np.bincount(flat).astype(np.int64)
    for e in end:
        counts = np.pad(counts, (0, max(0, int(e) + 1 - len(counts))))
        counts[e] += len(sizes)
    ids = [
        np.concatenate([flat[b - n : b], end]).astype("<u4").tobytes()
        for b, n in zip(np.cumsum(sizes), sizes)
    ]
    columns = [
        part["doc_id"],
        pa.array([len(x) // 4 for x in ids], pa.int64()),
        pa.array([zlib.crc32(x) for x in ids], pa.int64()),
        pa.array([squeeze(x, press) for x in ids], pa.binary()),
        pa.nulls(len(ids), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=TOKENS), counts


def ranks(tokens: DataFrame) -> np.ndarray:
    """Ids by falling frequency; the driver gets one count per id of the vocabulary, no more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press, seen = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch["counts"]:
                n = np.frombuffer(press.decompress(packed), "<i8")
                size = max(len(n), len(seen))
                seen = np.pad(seen, (0, size - len(seen))) + np.pad(n, (0, size - len(n)))
        used = np.flatnonzero(seen)
        yield pd.DataFrame({"id": used, "n": seen[used]})

    noted = tokens.select("counts").where("counts IS NOT NULL")
    counts = map_pandas(noted, run, "id long, n long").groupBy("id").agg(F.sum("n"))
    found = np.array(sorted((-n, i) for i, n in counts.collect()), np.int64).reshape(-1, 2)
    return found[:, 1].astype(np.uint32)


def pack(rank: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks."""
    extra = (rank > 0xFF).astype(np.uint8) + (rank > 0xFFFF) + (rank > 0xFFFFFF)
    codes = np.zeros(-(-len(rank) // 4) * 4, np.uint8)
    codes[: len(rank)] = extra
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    planes = rank.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), planes[np.arange(4) <= extra[:, None]].tobytes()


#: For each control byte the lengths of its four ids.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        if len(more := np.flatnonzero(lengths > k)):
            out[more] |= raw[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


BLOCKS = (
    "shard int, block int, first long, doc_ids array<long>, lengths array<int>, n_tokens long, "
    "control binary, data binary"
)


def write(tokens: DataFrame, path: str) -> None:
    """Writes ``path/blocks`` and ``path/ranks``; ``tokens`` should be a written table."""
    spark = tokens.sparkSession
    by_rank = ranks(tokens)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids, lengths, coded, held = [], [], [], 0
        press = zstandard.ZstdDecompressor()

        def flush() -> pd.DataFrame:
            control, data = pack(np.concatenate(coded))
            return pd.DataFrame(
                {
                    "shard": [shard], "block": [block], "first": [first], "doc_ids": [ids],
                    "lengths": [lengths], "n_tokens": [held], "control": [control], "data": [data],
                }
            )

        for batch in batches:
            for doc_id, packed in zip(batch["doc_id"].astype(object), batch["packed"]):
                one = rank_of[stretch(packed, press)]
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                lengths.append(len(one))
                coded.append(one)
                held += len(one)
                if held >= BLOCK_TOKENS:
                    yield flush()
                    block, first = block + 1, first + held
                    ids, lengths, coded, held = [], [], [], 0
        if ids:
            yield flush()

    shards = max(reducers(spark), -(-total // SHARD_TOKENS))
    ordered = (
        tokens.where("counts IS NULL")
        .select("doc_id", "ids_crc32", "packed")
        .repartitionByRange(shards, "doc_id", "ids_crc32")
        .sortWithinPartitions("doc_id", "ids_crc32")
        .select("doc_id", "packed")
    )
    blocks = map_pandas(ordered, run, BLOCKS)
    blocks.write.option("compression", "zstd").parquet(f"{path}/blocks")
    table = pd.DataFrame({"rank": np.arange(len(by_rank)), "id": by_rank.astype(np.int64)})
    spark.createDataFrame(table, "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, ids``: a row per document, ids as 4 bytes each.

    Without ``with_ids`` the ids are decoded and summed up, but not returned.
    """
    table = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()  # one row per id in use
    id_of = table["id"].to_numpy(np.uint32)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    # One row per shard: what the shards before it hold.
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    before, at = {}, 0
    for shard, n in sums:
        before[shard], at = at, at + n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = id_of[unpack(row.control, row.data, row.n_tokens)].astype("<u4")
                ends = np.cumsum(np.asarray(row.lengths, np.int64))
                begins = ends - np.asarray(row.lengths, np.int64)
                parts = [ids[a:b].tobytes() for a, b in zip(begins, ends)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if pd.isna(x) else int(x) for x in row.doc_ids], "Int64"),
                        "start": begins + before[row.shard] + row.first,
                        "n_tokens": ends - begins,
                        "ids_crc32": [zlib.crc32(x) for x in parts],
                        "ids": parts if with_ids else None,
                    }
                )

    return map_pandas(
        blocks, run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )


def write_and_read(
    docs: DataFrame,
    model_path: str,
    end_id: int | None = 2,
    path: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Tokenizes, writes the files to ``path`` (default: a new shared folder) and reads them back."""
    spark = docs.sparkSession
    path = path or fresh_folder(spark, "tokens")
    write(pin(tokenize(docs, model_path, end_id)), path)
    return read(spark, path, with_ids)
