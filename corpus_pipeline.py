"""From raw documents to training tokens: five stages, each written as Parquet before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import decontaminate, jaccard_join, line_dedup, pieces, quality, queries
from marketlens.llm.scratch import Scratch


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity their language's trusted documents do not exceed."""
    return quality.keep_good(docs, queries.table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line that ten documents have stays in the first of them; documents left without a line go."""
    found = line_dedup.drop_repeated_lines(docs, keep_first=True)
    found = found.where("n_dropped < n_lines").withColumn("n_chars", F.char_length("text").cast("long"))
    return found.select(docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity 0.8."""
    return jaccard_join.keep_one_of_each(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words of a benchmark item, or the whole of a shorter one."""
    benchmark = queries.table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(docs, benchmark)
    return found.where("n_hit = 0").select("row.*").select(docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a hash of the text decoded from them."""
    found = pieces.encode_and_decode(docs, queries.vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_stage),
]

# SQL can express neither the first stage's models nor the last one's pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    scratch = Scratch(spark, "pipeline")
    docs = queries.table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.keep(docs, f"stage{number}")
            scratch.drop(f"stage{number - 1}")
    return docs
