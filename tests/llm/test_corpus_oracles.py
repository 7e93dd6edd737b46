"""Corpus queries against their SQL on the smallest tables."""

import pytest

from check_oracles import connect, differences
from marketlens.llm import queries

FOLDER = "/root/testdata/sf0.001"
# No SQL can say these; tests beside this one hold them against the libraries or held-out rows.
WITHOUT_SQL = {
    "op1_quality_classifier", "op3_sentencepiece", "op4_token_binary_output", "op5_toxicity", "op10_lm_scoring", "op12_token_alignment", "pipeline",
}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_only_known_queries_lack_sql():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_rows_agree(spark, con, name):
    assert differences(spark, con, FOLDER, name) is None
