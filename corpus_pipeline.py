"""From raw documents to token files: a pipeline of the text operators.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rillflow.llm import decontaminate, jaccard_join, mixing, quality_rules, token_files
from rillflow.llm.common import table
from rillflow.session import pin


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality_rules.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by a word 5-gram similarity of 0.8 or more."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their source's target asks for."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and for each document its place in them."""
    model = public_tokenizers.path("byte_bpe_50k.json")
    read = token_files.write_and_read(docs, model, end_id=2, with_ids=False)
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("token-id output", token_output),
]

#: The stages from the n-gram join on are not expressible in SQL; tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
