"""Which queries of this folder SQL checks, and which a brute force, a round trip or held-out rows do."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from rillflow.llm.oracles import ORACLES
from rillflow.llm.queries import QUERIES
from tests.compare import difference, duck
from tests.conftest import SF_DIR

BY_SQL = {
    "op6_chat_format", "op8_quality_rules", "op11_importance_resampling", "op12_source_divergence",
}
OTHERWISE = {
    "op1_jaccard_join": "all pairs in test_operators",
    "op2_decontamination": "planted items in test_operators",
    "op3_token_files": "the tokenizer and a round trip in test_operators",
    "op4_mixing": "targets in test_operators",
    "op5_language_model": "forward recursion in test_operators",
    "op7_license_scan": "phrases in test_operators",
    "op9_toxicity": "held-out accuracy in test_operators",
    "op10_quality_classifier": "held-out accuracy in test_operators",
    "op13_simhash_pigeonring": "all pairs in test_new_operators",
}


def test_each_query_is_checked_somehow():
    assert set(ORACLES) == BY_SQL and BY_SQL | OTHERWISE.keys() == set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(BY_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


def test_columns_of_the_mix_are_in_the_order_of_its_contract(spark):
    got = QUERIES["op4_mixing"](spark, SF_DIR).columns
    assert got[:5] == ["doc_id", "size", "source_size", "target", "taken"]
