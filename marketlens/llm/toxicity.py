"""Toxicity by class-conditional Kneser-Ney models.

One trigram model learns from toxic documents, one from ordinary ones. Expressions that the classes
do not use significantly unlike each other have one shared, pooled count in both, and both fall back
on the same pooled counts of words, so that rare expressions weigh alike. A document's evidence is
the difference of its two log-likelihoods, normalised by its words, by their square root, and as a
bounded sum; a logistic curve fitted on labelled training documents turns it into a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm import kneser_ney
from marketlens.llm.scratch import Scratch
from marketlens.llm.words import Words, slices, windows

#: Training documents of each class for the models, and as many again for the curve: the bounds.
TRAINING_DOCS = 3000
FOLDS = 5


def held_out(id_column: str = "doc_id") -> Column:
    """One document of FOLDS is held out; null ids are never."""
    fold = F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def _signed(batches):
    """Texts with the smallest hash of their five-word windows: near copies mostly share it."""
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"), fold=True)
            hashes, first = words.hashes(), words.first
            signs = [int(windows(hashes[a:b], min(5, b - a)).min()) if b > a else 0 for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [piece.column("text"), piece.column("model"), pa.array(np.array(signs, np.uint64).view(np.int64))], ["text", "model", "sign"]
            )


def _fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve with both classes weighing the same, by Newton steps."""
    x = np.column_stack((x, np.ones(len(x))))
    share = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (y - p)) - 1e-4 * w
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic"
) -> DataFrame:
    """(doc_id, mark, n_words, evidence, score, predicted, held_out) per row of `docs`.

    Labels are learned only from documents that are not held out, of near copies mostly from one; nothing but texts enters a score.
    Scores are in 0 to 1; texts without words (null, empty) have the score of no evidence. Null and
    unlabelled ids are scored and not learned from; an id with both labels counts as toxic. With
    labels of one class only, or none, all scores are 0.5. Repeated rows get equal scores; `mark`
    is a hash of the text. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    rows = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), kneser_ney.mark(text_column).alias("mark"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    known = (
        labels.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{label_column}`").cast("int").alias("model"))
        .where("doc_id IS NOT NULL AND model IN (0, 1)").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("model").alias("model"))
    )
    order = F.xxhash64("doc_id", F.lit(7))
    # The first of each class by hash: half of them for the models, half for the curve.
    chosen = None
    for model in (0, 1):
        own = known.where(F.col("model") == model).orderBy(order, "doc_id").limit(2 * TRAINING_DOCS)
        chosen = own if chosen is None else chosen.unionAll(own)
    chosen = scratch.keep(chosen.withColumn("curve", F.xxhash64("doc_id", F.lit(8)) % 2 == 0), "chosen")
    sizes = {(r.model, r.curve): r["count"] for r in chosen.groupBy("model", "curve").count().collect()}
    # A class too small to be halved is learned from and fitted on as a whole.
    halved = all(sizes.get((m, c), 0) >= 300 for m in (0, 1) for c in (False, True))
    learned = chosen.where("NOT curve") if halved else chosen
    training = rows.join(F.broadcast(learned), "doc_id").select("text", F.col("model").cast("int").alias("model"))
    # A group of near copies would make all its words look telling: one of them is enough.
    training = training.mapInArrow(_signed, "text string, model int, sign long").groupBy("model", "sign")
    training = training.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))  # the same one in every run
    training = scratch.keep(training.select("text", "model"), "training")
    vocabulary = kneser_ney.learn_vocabulary(training, kneser_ney.VOCABULARY, fold=True, letters_only=True)
    kneser_ney.learn_telling(training, vocabulary)
    tables = scratch.keep(kneser_ney.packed(kneser_ney.train(training, vocabulary, 2, scratch)), "tables")
    more = F.col("log_likelihood")[1] - F.col("log_likelihood")[0]
    scored = kneser_ney.log_likelihoods(rows, tables, vocabulary, 2).select(
        "doc_id", "mark", "n_words", F.when(F.col("n_words") > 0, more / F.col("n_words")).otherwise(0.0).alias("evidence")
    )
    scored = scratch.keep(scored, "scored")
    root = F.sqrt(F.col("n_words").cast("double"))
    bounded = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.col("evidence") * F.col("n_words")))
    fitted = chosen.where("curve") if halved else chosen
    sample = scored.join(F.broadcast(fitted), "doc_id").select("evidence", (F.col("evidence") * root).alias("rooted"), bounded.alias("bounded"), "model").toPandas()
    if len(set(sample["model"])) == 2:
        w = [float(v) for v in _fitted(sample[["evidence", "rooted", "bounded"]].to_numpy(), sample["model"].to_numpy())]
    else:
        w = [0.0] * 4
    line = F.col("evidence") * w[0] + F.col("evidence") * root * w[1] + bounded * w[2] + w[3]
    score = 1 / (1 + F.exp(-line))
    return scored.select(
        "doc_id", "mark", "n_words", "evidence", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), held_out("doc_id").alias("held_out")
    )
