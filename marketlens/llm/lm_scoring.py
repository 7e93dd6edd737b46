"""Masked pseudo-likelihood of documents under a small bidirectional window network.

The network sees the words left and right of a masked one and predicts it: embeddings, one hidden
layer, and a softmax in two steps (a class of numbers, then the number in its class). The most
frequent words have numbers of their own; all others share the number of their shape, and a third
step gives the word within its shape: its share of the shape's uses in the corpus. A document's score
is the sum of the log-probabilities of all its words, each predicted from both sides.

Words are counted over the whole corpus, and the table of their shares grows with its distinct
words: it is sharded by word and joined. The network is trained in numpy on all documents: in each
epoch every task goes on from the common weights over its own documents, and Spark averages the
results. Weights and numbers are of a fixed size, which is all that is collected or broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.kneser_ney import REPEATS, SHAPES, Vocabulary, mark
from marketlens.llm.scratch import Scratch
from marketlens.llm.words import Words, slices

CLASSES, MEMBERS = 32, 32
#: Words that have a number of their own; others go by their shape, and their share of its uses.
KNOWN = CLASSES * MEMBERS - SHAPES
SIDE, EMBEDDED, HIDDEN = 2, 16, 24
#: One document of so many is trained on.
SHARE = 1
EPOCHS = 1
BATCH = 16384
STEP = 0.15


#: The first number that stands for a shape: those before are for repetitions of the word before.
FIRST_SHAPE = 1 + REPEATS
NO_WORDS = Vocabulary(np.empty(0, np.uint64), False, False)


def _count(batches):
    """Uses of each word and its shape's number; repetitions count for their numbers only."""
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            numbers = NO_WORDS.numbers(words)
            names = np.where(numbers < FIRST_SHAPE, numbers.astype(np.uint64), words.hashes())
            own, at, uses = np.unique(names, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "word": own.view(np.int64), "number": numbers[at].astype(np.int32), "uses": uses.astype(np.int64)
            })


class Network:
    """Weights by name; words are known by their rank, the most frequent first."""

    def __init__(self, counts: np.ndarray):
        random = np.random.default_rng(1)
        self.rank = np.empty(len(counts), np.int64)
        self.rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        share = np.sort(counts)[::-1].astype(np.float64) + 0.5
        share = (share / share.sum()).reshape(CLASSES, MEMBERS)
        # One more embedding stands for what lies beyond a text. Biases begin at the words' shares.
        self.weights = {
            "embedding": random.normal(0, 0.1, (len(counts) + 1, EMBEDDED)),
            "hidden": random.normal(0, 0.1, (2 * SIDE * EMBEDDED, HIDDEN)), "hidden_bias": np.zeros(HIDDEN),
            "cls": np.zeros((HIDDEN, CLASSES)), "cls_bias": np.log(share.sum(axis=1)),
            "member": np.zeros((CLASSES, HIDDEN, MEMBERS)), "member_bias": np.log(share / share.sum(axis=1, keepdims=True)),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name, w in self.weights.items():
            self.weights[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size

    def examples(self, words: Words, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ranks of all words, of the words around each, the text of each, and words per text."""
        ranks, counts = self.rank[numbers], words.counts
        owner = np.repeat(np.arange(len(counts)), counts)
        beyond, n = len(self.rank), len(ranks)
        around = np.full((n, 2 * SIDE), beyond, np.int16)
        for k, shift in enumerate([s for s in range(-SIDE, SIDE + 1) if s]):
            to = slice(max(0, -shift), n - max(0, shift))
            off = slice(max(0, shift), n - max(0, -shift))
            if n > abs(shift):
                around[to, k] = np.where(owner[to] == owner[off], ranks[off], beyond)
        return ranks, around, owner, counts

    def _places(self) -> list[np.ndarray]:
        """The part of the hidden weights that each place around a word has."""
        return np.split(self.weights["hidden"], 2 * SIDE)

    def _forward(self, around: np.ndarray) -> np.ndarray:
        """Hidden values: each place adds a row of its table, which is made once for all words."""
        total = np.tile(self.weights["hidden_bias"], (len(around), 1))
        for k, own in enumerate(self._places()):
            total += np.take(self.weights["embedding"] @ own, around[:, k], axis=0)
        return np.tanh(total, out=total)

    def log_probabilities(self, ranks: np.ndarray, around: np.ndarray) -> np.ndarray:
        w, hidden = self.weights, self._forward(around)
        own, member = ranks // MEMBERS, ranks % MEMBERS
        logits = hidden @ w["cls"] + w["cls_bias"]
        out = logits[np.arange(len(own)), own] - _log_sum(logits)
        order = np.argsort(own.astype(np.uint8), kind="stable")
        cuts = np.searchsorted(own[order], np.arange(CLASSES + 1))
        for c in range(CLASSES):
            at = order[cuts[c] : cuts[c + 1]]
            if len(at):
                logits = hidden[at] @ w["member"][c] + w["member_bias"][c]
                out[at] += logits[np.arange(len(at)), member[at]] - _log_sum(logits)
        return out

    def learn(self, ranks: np.ndarray, around: np.ndarray, squares: dict[str, np.ndarray]) -> None:
        """One step of scaled gradient descent on a batch; weights that it does not touch stay."""
        order = np.argsort((ranks // MEMBERS).astype(np.uint8), kind="stable")
        ranks, around = ranks[order], around[order]
        w, n = self.weights, len(ranks)
        hidden = self._forward(around)
        own, member, at = ranks // MEMBERS, ranks % MEMBERS, np.arange(n)
        p = _softmax(hidden @ w["cls"] + w["cls_bias"])
        p[at, own] -= 1
        back = p @ w["cls"].T
        grad = {"cls": (..., hidden.T @ p), "cls_bias": (..., p.sum(axis=0))}
        begins = np.flatnonzero(np.diff(own, prepend=-1))
        classes, parts = own[begins], [slice(x, y) for x, y in zip(begins, np.append(begins[1:], n))]
        logits = w["member_bias"][own]
        for c, part in zip(classes, parts):
            logits[part] += hidden[part] @ w["member"][c]
        p = _softmax(logits)
        p[at, member] -= 1
        grad["member"] = classes, np.stack([hidden[part].T @ p[part] for part in parts])
        grad["member_bias"] = classes, np.add.reduceat(p, begins)
        for c, part in zip(classes, parts):
            back[part] += p[part] @ w["member"][c].T
        back *= 1 - hidden * hidden
        # What comes back to each word at each place, added up by word.
        by_word = [_sums(back, around[:, k], len(w["embedding"])) for k in range(2 * SIDE)]
        grad["hidden"] = ..., np.concatenate([w["embedding"].T @ sums for sums in by_word])
        grad["hidden_bias"] = ..., back.sum(axis=0)
        grad["embedding"] = ..., sum(sums @ own.T for sums, own in zip(by_word, self._places()))
        for name, (rows, g) in grad.items():
            g = g / n
            squares[name][rows] += g * g
            w[name][rows] -= STEP * g / (np.sqrt(squares[name][rows]) + 1e-6)


def _sums(values: np.ndarray, entry: np.ndarray, size: int) -> np.ndarray:
    """Rows of values added up by entry."""
    order = np.argsort(entry, kind="stable")
    begins = np.flatnonzero(np.diff(entry[order], prepend=-1))
    out = np.zeros((size, values.shape[1]), values.dtype)
    out[entry[order[begins]]] = np.add.reduceat(np.take(values, order, axis=0), begins)
    return out


def _log_sum(logits: np.ndarray) -> np.ndarray:
    top = logits.max(axis=1, keepdims=True)
    return np.log(np.exp(logits - top) @ np.ones(logits.shape[1], logits.dtype)) + top[:, 0]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = logits - logits.max(axis=1, keepdims=True)
    np.exp(e, out=e)
    e /= (e @ np.ones(e.shape[1], e.dtype))[:, None]
    return e


def _train(batches, network: Network, vocabulary: Vocabulary, epoch: int):
    """Weights after the task's documents, times the words it saw, and that number (entry -1)."""
    squares = {k: np.full_like(v, 1e-4) for k, v in network.weights.items()}
    random, seen = np.random.default_rng(epoch), 0
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            ranks, around, _, _ = network.examples(words, vocabulary.numbers(words))
            order = random.permutation(len(ranks))
            for begin in range(0, len(order), BATCH):
                at = order[begin : begin + BATCH]
                network.learn(ranks[at], around[at], squares)
            seen += len(ranks)
    flat = network.flat() * seen
    yield pa.RecordBatch.from_pydict({"entry": np.arange(-1, len(flat), dtype=np.int32), "value": np.concatenate(([float(seen)], flat))})


SCORED = "row long, doc_id long, mark long, n_words long, log_probability double, words array<long>, uses array<int>"


def _score(batches, network: Network, vocabulary: Vocabulary):
    """Scores by the network, and the distinct words of each text that go by their shape."""
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"))
            numbers = vocabulary.numbers(words)
            ranks, around, owner, counts = network.examples(words, numbers)
            total = np.zeros(len(counts))
            for begin in range(0, len(ranks), 1 << 16):
                at = slice(begin, begin + (1 << 16))
                total += np.bincount(owner[at], network.log_probabilities(ranks[at], around[at]), len(counts))
            shaped = np.flatnonzero((numbers >= FIRST_SHAPE) & (numbers < SHAPES))
            names, texts = words.hashes()[shaped], owner[shaped]
            # By text, and within by most of the hash: a word's entries may come in parts, which add up.
            order = np.argsort((texts << 43) | (names >> np.uint64(21)).astype(np.int64))
            names, texts = names[order], texts[order]
            new = np.ones(len(names), bool)
            new[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
            starts = np.flatnonzero(new)
            cuts = pa.array(np.searchsorted(texts[starts], np.arange(len(counts) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "row": row + np.arange(len(counts)), "doc_id": piece.column("doc_id"), "mark": piece.column("mark"),
                "n_words": counts.astype(np.int64), "log_probability": total,
                "words": pa.ListArray.from_arrays(cuts, pa.array(names[starts].view(np.int64))),
                "uses": pa.ListArray.from_arrays(cuts, pa.array(np.diff(np.append(starts, len(names))).astype(np.int32))),
            })
            row += len(counts)


def pseudo_likelihood(docs: DataFrame, share: int = SHARE, epochs: int = EPOCHS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, mark, n_words, log_probability) per row of `docs`.

    Words are runs of bytes other than ASCII white space. A word is predicted by its number, and
    one without a number of its own by its share of the uses of its shape too; a word equal to the
    one before it by the number of the repetition alone. One document of `share`, chosen by the
    hash of its id and text, is trained on; with none chosen the score is that of the words' shares
    in the corpus. Null and empty texts have no words and the score 0. Null ids and repeated rows
    are scored as they are; `mark` is a hash of the text. Other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "scoring")
    docs = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), mark(text_column).alias("mark"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    counted = docs.select("text").mapInArrow(_count, "word long, number int, uses long").groupBy("word", "number").agg(F.sum("uses").alias("uses"))
    counted = scratch.keep(counted, "words")
    own = counted.where(F.col("number") >= FIRST_SHAPE)
    top = own.orderBy(F.desc("uses"), "word").limit(KNOWN).toArrow()
    words, shapes, uses = (top.column(c).to_numpy() for c in ("word", "number", "uses"))
    order = np.argsort(words.view(np.uint64))
    vocabulary = Vocabulary(words[order].view(np.uint64), False, False)
    numbers = counted.groupBy("number").agg(F.sum("uses").alias("uses")).toArrow()  # a row per shape at most
    counts = np.zeros(CLASSES * MEMBERS, np.int64)
    counts[numbers.column("number").to_numpy()] = numbers.column("uses").to_numpy()
    np.subtract.at(counts, shapes, uses)
    counts[SHAPES : SHAPES + len(words)] = uses[order]
    training = docs.select("text")
    if share > 1:
        training = scratch.keep(docs.where(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(share)) == 0).select("text"), "training")
    network = Network(counts)
    for epoch in range(epochs):
        found = training.mapInArrow(lambda b, e=epoch: _train(b, network, vocabulary, e), "entry int, value double")
        found = found.groupBy("entry").agg(F.sum("value").alias("value")).toArrow()  # as many rows as weights
        entry, value = found.column("entry").to_numpy(), found.column("value").to_numpy()
        values = np.zeros(len(network.flat()) + 1)
        values[entry + 1] = value
        if values[0]:
            network.load(values[1:] / values[0])
    scored = scratch.keep(docs.mapInArrow(lambda b: _score(b, network, vocabulary), SCORED), "scored")
    if len(words) < KNOWN:
        return scored.select("doc_id", "mark", "n_words", "log_probability")  # each word has a number of its own
    # All words after the last one with a number, in the order of the numbers, go by their shapes.
    last = (F.col("uses") == int(uses[-1])) & (F.col("word") > int(words[-1]))
    totals = spark.createDataFrame([(k, int(n)) for k, n in enumerate(counts[:SHAPES])], "number int, total long")
    shares = own.where((F.col("uses") < int(uses[-1])) | last).join(F.broadcast(totals), "number")
    shares = shares.select("word", F.log(F.col("uses") / F.col("total")).alias("log_share"))
    found = scored.select("row", F.explode(F.arrays_zip("words", "uses")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.uses").alias("n"))
    within = found.join(shares.hint("merge"), "word").groupBy("row").agg(F.sum(F.col("n") * F.col("log_share")).alias("within"))
    return scored.drop("words", "uses").join(within.hint("merge"), "row", "left").select(
        "doc_id", "mark", "n_words", (F.col("log_probability") + F.coalesce("within", F.lit(0.0))).alias("log_probability")
    )
