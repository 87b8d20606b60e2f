"""Cut and cached encoding against the tokenizer on whole texts, and counts noted by the tasks."""

from __future__ import annotations

import random
import subprocess
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from rillflow.llm import token_files

MODEL = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "a", "the", "é", "×", "÷", "ŭ", "Ж", " ", "  ", "\n", ".", ",", "!", "\t", "\x0b", " ", "　", "\x85",
    "1", "23", "'s", "’", "…", "\x1c", "\x00", "\x01", "\x7f", "<|endoftext|>", "#", "日本", "́", "\r", "ſ",
]


@pytest.fixture(scope="module")
def own():
    with open(MODEL, encoding="utf-8") as f:
        return token_files.Encoder(f.read())


def odd_texts(n: int) -> list[str]:
    some = random.Random(3)
    return ["".join(some.choice(PARTS) for _ in range(some.randint(0, 14))) for _ in range(n)]


def split(flat: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    return [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_ids_equal_those_of_whole_texts(own, kind):
    texts = odd_texts(4_000)
    want = [e.ids for e in own.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert split(*own.texts(pa.array(["x y", *texts], kind)[1:])) == want
    assert split(*own.texts(pa.array(texts, kind))) == want  # all pieces known


def test_no_texts_and_empty_texts(own):
    flat, sizes = own.texts(pa.array([], pa.string()))
    assert (len(flat), len(sizes)) == (0, 0)
    flat, sizes = own.texts(pa.array(["", ""], pa.string()))
    assert (len(flat), sizes.tolist()) == (0, [0, 0])


def test_forgetting_changes_no_ids(own, monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 3)
    texts = ["one two three four five.", "two\nthree, six", "one two"]
    want = [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [split(*own.texts(pa.array([t])))[0] for t in texts] == want


def test_ranks_come_from_the_counts_of_the_tasks(spark):
    texts = [*odd_texts(300), None, "", "the the the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    tokens = token_files.tokenize(docs, MODEL, 2).persist()
    got = token_files.ranks(tokens).tolist()
    whole = token_files.Encoder(open(MODEL, encoding="utf-8").read()).tokenizer
    n = Counter(i for t in texts for i in [*whole.encode(t or "", add_special_tokens=False).ids, 2])
    assert got == [i for i, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))]
    assert tokens.where("counts IS NULL").count() == len(texts)


MEASURED = """
import re, sys, threading, time
import numpy as np, pyarrow as pa, public_tokenizers
from rillflow.llm import token_files as t
from rillflow.llm.common import text_slices

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

def watch():
    while True:
        most.append(held())
        time.sleep(0.02)

some = np.random.default_rng(5)
words = np.array(["".join(map(chr, some.integers(97, 123, 6))) for _ in range(200_000)])
texts = pa.array([" ".join(words[some.integers(0, len(words), 450)]) for _ in range(10_000)], pa.string())
batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), texts], names=["doc_id", "text"])
own = t.encoder(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
press, end, most = t.zstandard.ZstdCompressor(level=1), np.array([2], np.uint32), [held()]
threading.Thread(target=watch, daemon=True).start()
for part in text_slices(batch, t.SLICE_BYTES):
    t.encoded(own, part, end, press)
print(max(most) - most[0])
"""


def test_a_worker_encodes_a_full_batch_in_bounded_memory():
    """Two workers share an executor with a heap of 1,800 MB of 3,000 MB."""
    done = subprocess.run([sys.executable, "-c", MEASURED], capture_output=True, text=True, timeout=300, check=True)
    assert float(done.stdout) < 170  # 264 with larger slices and threads of the tokenizer
