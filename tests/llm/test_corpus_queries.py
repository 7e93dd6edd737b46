"""Corpus queries and operators on rows that repeat, lack ids or bring clashing columns."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marketlens.llm import decontaminate, embedding_dedup, queries

FOLDER = "/root/testdata/sf0.001"


def test_token_query_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    docs = sorted((r.doc_id, r.text or "") for r in queries.table(spark, FOLDER, "documents").collect())
    want, start = [], 0
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.QUERIES["op4_token_binary_output"](spark, FOLDER).collect()) == want


def test_many_equal_rows_without_ids_are_searched_once(spark):
    """Rows equal in id and text meet the index as one document, however many they are."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    hot = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.col("id").alias("mark"))
    docs = hot.unionAll(spark.createDataFrame([(1, text, 0), (1, "other words", 0), (None, "clean", 0)], "doc_id long, text string, mark long"))
    item = spark.createDataFrame([(9, text)], "item_id long, text string")
    found = decontaminate.find_contamination(docs.repartition(7), item)
    got = {(r.doc, r.text, r.n_words, r.n_hit, r["items"][0] if r["items"] else None): r.n for r in found.groupBy(
        F.col("row.doc_id").alias("doc"), F.col("row.text").alias("text"), "n_words", "n_hit", "items").agg(F.count("*").alias("n")).collect()}
    assert got == {(None, text, 12, 12, "9"): 3000, (1, text, 12, 12, "9"): 1, (1, "other words", 2, 0, None): 1, (None, "clean", 1, 0, None): 1}


def test_vectors_without_or_with_repeated_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.01], 0), (None, [1.0, 0.02], 0), (2, [0.0, 1.0], 0), (None, None, None), (3, [0.0, 1.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = embedding_dedup.near_duplicate_vectors(df)
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted(r.n_links for r in got if r.vec_id in (2, 3)) == [0, 0] and all(r.component_id == 1 for r in got if r.vec_id == 1)


@pytest.mark.parametrize("number", [1, 2, 3, 4])
def test_stages_on_empty_tables_and_clashing_columns(spark, number):
    docs = queries.table(spark, FOLDER, "documents").limit(12)
    clashing = docs.withColumns({name: F.lit("x") for name in ("mark", "__mark", "row", "w", "n_hit", "component", "key", "shard", "model")})
    name, stage = corpus_pipeline.STAGES[number]
    for df in (docs.limit(0), clashing):
        found = stage(spark, df, FOLDER)
        assert found.count() <= df.count()
        assert number == 4 or found.columns == df.columns, name
