"""Quality by perplexity under a Kneser-Ney model of trusted text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm import kneser_ney
from marketlens.llm.scratch import Scratch, own_name

#: A language's threshold: this quantile of its trusted documents' perplexities, times the slack. A
#: quantile nearer to 1 would hang on a few odd documents where a language has few.
QUANTILE, SLACK = 0.98, 1.0
#: A language's quantile is its own from so many trusted documents on, else that of all.
LEAST_DOCS = 30


def perplexity(docs: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, mark, n_words, perplexity, trained) per row of `docs`.

    `trusted` holds ids of documents to learn from; the model takes all of that half of them whose
    hash is even. Perplexity is per word, null for no words. Words outside the vocabulary pay for
    their shape, and as words: the model's texts' most frequent by their share there, all others by
    their letters.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), kneser_ney.mark(text_column).alias("mark"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    half = F.xxhash64("doc_id") % 2 == 0
    chosen = scratch.keep(trusted.select("doc_id").where("doc_id IS NOT NULL").where(half).distinct(), "chosen")
    # Written, so that its size is known: Spark broadcasts the ids while they are few.
    training = scratch.keep(rows.where(half).join(chosen, "doc_id").select("text", F.lit(0).alias("model")), "training")
    vocabulary = kneser_ney.learn_vocabulary(training, kneser_ney.VOCABULARY, fold=False, letters_only=False)
    kneser_ney.learn_letters(training, vocabulary, scratch)
    scratch.drop("rare")
    tables = kneser_ney.train(training, vocabulary, 1, scratch)
    scratch.drop("training")  # counted by now: its n-grams are written
    tables = scratch.keep(kneser_ney.packed(tables), "tables")
    scratch.drop("trigrams", "bigrams")
    scored = kneser_ney.log_likelihoods(rows, tables, vocabulary, 1)
    scored = scored.select(
        "doc_id", "mark", "n_words", F.when(F.col("n_words") > 0, F.exp(-F.col("log_likelihood")[0] / F.col("n_words"))).alias("perplexity")
    )
    scored = scratch.keep(scored, "scored")
    scratch.drop("tables")
    return scored.join(chosen.withColumn("trained", F.lit(True)), "doc_id", "left").withColumn("trained", F.coalesce("trained", F.lit(False)))


def classify(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK,
    id_column: str = "doc_id", text_column: str = "text", language_column: str = "lang", label_column: str = "quality",
) -> DataFrame:
    """(doc_id, mark, lang, n_words, perplexity, threshold, kept) per row of `docs`.

    Documents labelled 1 are trusted. A language's threshold is `slack` times that quantile of
    the perplexities of its trusted documents, those that the model learned from left out; languages with few of
    them, and null ones, have that of all. Documents above it are rejected, and so are those
    without words (null and empty texts). With no trusted documents at all there is no threshold and
    all with words are kept. Repeated rows get equal results, null ids are kept; `mark` is a hash of
    the text, which tells rows of equal id apart. Other columns are ignored.
    """
    trusted = labels.where(F.col(f"`{label_column}`") == 1).select(F.col(f"`{id_column}`").cast("long").alias("doc_id")).distinct()
    scored = perplexity(docs, trusted, id_column, text_column)
    languages = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), kneser_ney.mark(text_column).alias("own"), F.col(f"`{language_column}`").cast("string").alias("lang")
    ).groupBy("id", "own").agg(F.min("lang").alias("lang"))
    scored = scored.join(languages, scored["doc_id"].eqNullSafe(languages["id"]) & (scored["mark"] == languages["own"]), "left").drop("id", "own")
    measured = scored.join(trusted, "doc_id", "left_semi").where("NOT trained AND perplexity IS NOT NULL")
    cut = F.percentile_approx("perplexity", F.lit(quantile), F.lit(100_000))
    # One row per language. Its size is known once it is written, so that Spark broadcasts it if it is
    # small and no language's documents have to meet in one task.
    by_language = measured.where("lang IS NOT NULL").groupBy("lang").agg(cut.alias("own_cut"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_DOCS)
    by_language = Scratch(docs.sparkSession, "cuts").keep(by_language.select("lang", "own_cut"), "cuts")
    overall = measured.agg(cut.alias("any_cut"))
    judged = scored.join(by_language, "lang", "left").crossJoin(F.broadcast(overall))  # one row
    threshold = slack * F.coalesce("own_cut", "any_cut")
    return judged.select(
        "doc_id", "mark", "lang", "n_words", "perplexity", threshold.alias("threshold"),
        ((F.col("n_words") > 0) & (threshold.isNull() | (F.col("perplexity") <= threshold))).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that are not rejected, all columns as they are: see `classify`."""
    scratch = Scratch(docs.sparkSession, "kept")
    rejected = classify(docs, labels, id_column=id_column, text_column=text_column).where("NOT kept").select("doc_id", "mark").distinct()
    rejected = scratch.keep(rejected, "rejected")
    own = own_name(docs)
    rows = docs.withColumn(own, kneser_ney.mark(text_column))
    gone = rows[id_column].cast("long").eqNullSafe(rejected["doc_id"]) & (rows[own] == rejected["mark"])
    return rows.join(rejected.hint("merge"), gone, "left_anti").drop(own)
