"""N-gram Jaccard join with banded MinHash signatures and exact verification.

1.  Each text becomes the set of the 64-bit hashes of its word 5-grams (all its words, if fewer).
    Texts with one set are one class, so thousands of copies are one member from here on.
2.  Each of ``TREES`` bands has ``LONGEST`` MinHash values, of which the first d are its key.  A pair
    at the threshold agrees on d values of one band with probability ``s**d``; d is chosen before any
    data is seen, the largest at which the bands together reach the target recall.  There is no trie.
3.  Classes whose prefixes are alike meet.  A large group is cut into blocks, and pairs of blocks
    meet in tasks of their own: no task holds more than two blocks, however hot the group is.
    Inside a task members are sorted by their longer prefixes.  A pair is verified exactly, once: in
    the first tree that brings it together.
4.  Tasks return counts of links for each class, and a spanning forest of the links, never pairs.
    Connected components of the forests give the class ids.

Contracts: null text counts as empty.  Texts without words are one class without links to others.
A class id is the smallest doc_id of the component (null if it has none).  Repeated rows count as
copies.  Columns other than id and text are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import blank_split, map_arrow, row_key, whole_row, whole_text
from rillflow.operators.joins import fits_broadcast, lookup
from rillflow.session import pin, reducers

GRAM = 5
THRESHOLD = 0.8
TREES, LONGEST = 10, 6
TARGET_RECALL = 0.999
#: Classes of a block; a task verifies one block or two against each other.
BLOCK = 400
_MIX = np.uint64(0x9E3779B97F4A7C15)


def depth_for(threshold: float, trees: int, longest: int, target: float) -> int:
    """The longest prefix at which pairs at the threshold meet with the target probability."""
    depth = longest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word grams."""
    words, sizes = blank_split(texts)
    coded = words.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    codes = known[coded.indices.to_numpy()] if len(known) else known
    grams = np.zeros(max(0, len(codes) - GRAM + 1), np.uint64)
    for k in range(GRAM):
        grams = mixed(grams + codes[k : len(grams) + k] * np.uint64(2 * k + 1))
    out, at = [], 0
    for n in sizes:
        if n >= GRAM:
            own = grams[at : at + n - GRAM + 1]
        elif n:
            short = np.uint64(n)
            for c in codes[at : at + n]:
                short = mixed(np.array([short ^ c], np.uint64))[0]
            own = np.array([short], np.uint64)
        else:
            own = np.zeros(0, np.uint64)
        out.append(np.unique(own))
        at += n
    return out


def seeds(n: int) -> np.ndarray:
    return np.random.default_rng(20_011).integers(1, 2**63, n).astype(np.uint64)


def prefixes(sets: list[np.ndarray], trees: int, longest: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per set and tree: the hash of the prefix of ``depth`` MinHash values, and the values after it."""
    n, values = len(sets), trees * longest
    mins = np.zeros((n, values), np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        joined = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for v, seed in enumerate(seeds(values)):
            mins[full, v] = np.minimum.reduceat(mixed_lightly(joined, seed), starts)
    mins = mins.reshape(n, trees, longest)
    head = np.broadcast_to(np.arange(trees, dtype=np.uint64), (n, trees)).copy()
    for d in range(depth):
        head = mixed(head * _MIX + mins[:, :, d])
    return head, mins[:, :, depth:]


def mixed_lightly(x: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A permutation of 64-bit values for each seed."""
    x = (x ^ seed) * (seed | np.uint64(1))
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def rows_of(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        whole_text(f"`{text}`").alias("text"),
        row_key(f"`{doc_id}`", f"`{text}`").alias("row"),
    )


def signatures(rows: DataFrame, depth: int) -> DataFrame:
    """``doc_id, row, key, grams, heads, tails``: a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                sets = gram_sets(part["text"])
                heads, tails = prefixes(sets, TREES, LONGEST, depth)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["row"],
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(list(heads.view(np.int64)), pa.list_(pa.int64())),
                        # 2 bytes of each value sort the trie below the prefix
                        pa.array([t.astype(np.uint16).tobytes() for t in tails], pa.binary()),
                    ],
                    names=["doc_id", "row", "key", "grams", "heads", "tails"],
                )

    schema = "doc_id long, row string, key binary, grams long, heads array<long>, tails binary"
    return map_arrow(rows, run, schema)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 columns a few thousand at a time."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    joined = np.concatenate(sets)
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    new = np.concatenate([[True], joined[1:] != joined[:-1]])
    group = np.cumsum(new) - 1
    shared = np.bincount(group) > 1  # what one member alone has is in no intersection
    keep = shared[group]
    column = (np.cumsum(shared) - 1)[group[keep]]
    owner = owner[keep]
    out = np.zeros((n, n), np.float32)
    top = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, top, 4096):
        a, b = np.searchsorted(column, [low, low + 4096])
        part = np.zeros((n, min(4096, top - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def verified(heads, tails, blocks, sets, weights, tree, i, j, threshold):
    """Links of one task: (member, linked documents) and forest edges (member, member)."""
    n = len(sets)
    order = np.lexsort(tails[:, tree].T[::-1]) if tails.shape[2] else np.arange(n)
    sizes = np.array([len(s) for s in sets], np.float32)[order]
    heads, blocks, weights = heads[order], blocks[order], weights[order]
    both = intersections([sets[k] for k in order])
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-3
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= blocks[:, None] != blocks[None, :]
    # only pairs that no earlier tree brings together
    a, b = np.nonzero(np.triu(linked))
    if len(a) and tree:
        first = ~(heads[a, :tree] == heads[b, :tree]).any(axis=1)
        a, b = a[first], b[first]
    counts = np.bincount(a, weights[b], n) + np.bincount(b, weights[a], n)
    # spanning forest: labels fall until neighbours agree
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
    used = np.flatnonzero(counts)
    return order[used], counts[used], order[root[used]]


def links(members: DataFrame, threshold: float) -> DataFrame:
    """``id, n_links, to``: per task that links a class; ``to`` is a class of the same component.

    ``members``: ``bucket, tree, i, j, id, block, n, heads, tails, set``, brought together by task.
    """

    def groups(batches):
        held, key = [], None
        for batch in batches:
            for row in batch.to_pylist():
                at = (row["bucket"], row["i"], row["j"])
                if held and at != key:
                    yield held
                    held = []
                key = at
                held.append(row)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []

        def flush():
            cols = list(zip(*out)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols], names=["id", "n_links", "to"]
            )

        for rows in groups(batches):
            if len(rows) < 2:
                continue
            tails = np.array([np.frombuffer(r["tails"], np.uint16) for r in rows])
            member, counts, root = verified(
                np.array([r["heads"] for r in rows], np.int64),
                tails.reshape(len(rows), TREES, -1),
                np.array([r["block"] for r in rows]),
                [np.frombuffer(r["set"], np.uint64) for r in rows],
                np.array([r["n"] for r in rows], np.float64),
                rows[0]["tree"], rows[0]["i"], rows[0]["j"], threshold,
            )
            ids = [r["id"] for r in rows]
            out += [(ids[m], int(c), ids[r]) for m, c, r in zip(member, counts, root)]
            if len(out) > 20_000:
                yield flush()
                out.clear()
        yield flush()

    return map_arrow(members, run, "id long, n_links long, to long")


def sets_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, set`` of the wanted classes (``id, rep, key``), computed anew from one text of each.

    Joined by the smallest document id; rows of that id with another text are told by the key.
    """
    ids = wanted.select(F.col("rep")).distinct()
    ids = F.broadcast(ids) if fits_broadcast(wanted.select("rep")) else ids
    few = rows.drop("row").join(ids, rows["doc_id"].eqNullSafe(ids["rep"]), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                sets = gram_sets(batch.slice(at, 500)["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_key(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    names=["key", "set"],
                )

    made = map_arrow(few, run, "key binary, set binary")
    return wanted.join(made, "key").groupBy("id").agg(F.first("set").alias("set"))


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for ``edges(id, to)``: the smallest id of each connected component.

    Large-star and small-star steps until nothing changes; each step is written out, so a lost
    executor repeats one step and a hub's edges are split by the adaptive skew join.
    """
    pairs = edges.where("id <> to").select(
        F.least("id", "to").alias("low"), F.greatest("id", "to").alias("high")
    )
    pairs = pin(pairs.distinct())
    state = None
    while True:
        # large star: higher neighbours go to the lowest neighbour
        both = pairs.select(F.col("low").alias("v"), F.col("high").alias("w")).unionAll(
            pairs.select(F.col("high"), F.col("low"))
        )
        least = both.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("m", "v").alias("m"))
        large = both.where("w > v").join(least, "v").select(F.col("m").alias("low"), F.col("w").alias("high"))
        large = large.where("low <> high").distinct()
        # small star: lower neighbours and the vertex itself go to the lowest of them
        floor = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (
            large.join(floor, "high")
            .select(F.col("m").alias("low"), F.col("low").alias("high"))
            .unionAll(floor.select(F.col("m").alias("low"), "high"))
            .where("low <> high")
            .distinct()
        )
        pairs = pin(small)
        new = pairs.agg(
            F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("low", "high"), F.lit(1 << 31)))
        ).first()
        if new == state:
            break
        state = new
    return pairs.select(F.col("high").alias("id"), F.col("low").alias("root"))


def join(
    docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET_RECALL,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id, class_id, n_links`` for each row of ``docs``.

    ``n_links`` counts the other rows whose word 5-gram sets are at least ``threshold`` alike.
    """
    signed, table = linked(docs, threshold, target, text, doc_id)
    return lookup(signed.select("doc_id", "key"), table.drop("root"), "key", row_id="doc_id").select(
        "doc_id", "class_id", "n_links"
    )


def linked(
    docs: DataFrame, threshold: float, target: float = TARGET_RECALL, text: str = "text", doc_id: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """``doc_id, row, key`` of each row, and ``key, root, class_id, n_links`` of each distinct set."""
    rows = rows_of(docs, text, doc_id)
    depth = depth_for(threshold, TREES, LONGEST, target)
    signed = pin(signatures(rows, depth))
    # One row per distinct set; its copies are summed up before the shuffle.
    classes = pin(
        signed.groupBy("key")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.first("grams").alias("grams"),
            F.first("heads").alias("heads"),
            F.first("tails").alias("tails"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    heads = classes.where("grams > 0").select("id", F.posexplode("heads").alias("tree", "bucket"))
    shared = heads.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = pin(heads.join(shared, "bucket"))
    wanted = met.select("id").distinct().join(classes.select("id", "rep", "key"), "id")
    sets = pin(sets_of(rows, pin(wanted)))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    k = F.col("k")
    members = (
        met.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("k", F.explode(F.sequence(F.lit(0), blocks - 1)))
        # a block meets itself in a task of its own only where it is the only one
        .select(
            "bucket", "tree", "id", "block",
            F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j"),
        )
        .join(classes.select("id", "n", "heads", "tails"), "id")
        .join(sets, "id")
    )
    dealt = members.repartition(
        max(reducers(docs.sparkSession), 4), "bucket", "i", "j"
    ).sortWithinPartitions("bucket", "i", "j", "id")
    found = pin(links(dealt, threshold))
    sums = found.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    roots = components(found.select("id", "to"))
    named = (
        classes.select("id", "key", "rep", "n")
        .join(sums, "id", "left")
        .join(roots, "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    lowest = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    table = pin(
        named.join(lowest, "root").select(
            "key", "root", "class_id", (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")
        )
    )
    return signed.select("doc_id", "row", "key"), table


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the smallest id, nulls last.

    Rows are told apart by id and text.  Rows that share both are copies; one of them stays.
    """
    signed, table = linked(docs, threshold)
    found = pin(lookup(signed, table.select("key", "root"), "key", row_id="row").select("doc_id", "row", "root"))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    first = pin(found.groupBy("root").agg(F.min(rank)["row"].alias("_first")))
    # equal rows are in one class, so a row key stays or goes as a whole
    losers = lookup(found, first, "root", row_id="row").where("row <> _first").select(F.col("row").alias("_row"))
    losers = pin(losers.distinct())
    # the columns of docs may bear any name: they are carried in a struct
    keyed = docs.select(whole_row(docs).alias("_doc"), row_key().alias("_row"))
    kept = keyed.join(F.broadcast(losers) if fits_broadcast(losers) else losers, "_row", "left_anti")
    twice = pin(found.groupBy(F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_row"))
    if not twice.isEmpty():
        kept = kept.join(twice, "_row", "left_anti").unionByName(
            kept.join(twice, "_row", "left_semi").dropDuplicates(["_row"])
        )
    return kept.select("_doc.*")
