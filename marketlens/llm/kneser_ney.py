"""Interpolated modified Kneser-Ney trigram models, scored by joining sharded counts.

Training counts n-grams of the training documents with Spark and joins them, order by order,
into four tables: discounted trigram probabilities, weights of their contexts, bigram probabilities
and weights of theirs. All are dealt to shards by the middle word, and within by the first.

Documents never meet a whole model. A task turns its block of documents into trigrams, deals them
to the same shards, sorted and packed, and each shard looks its trigrams up in its part of the
counts and hands back one sum per document. Neither texts nor models are collected or broadcast;
what is broadcast is the vocabulary, whose sizes are parameters, and the letters of unknown words.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.pieces import pack, unpack
from marketlens.llm.scratch import Scratch
from marketlens.llm.words import Words, slices

VOCABULARY = 8192
#: Words beyond those that are known by their share among the words that go by their shapes.
RARE_WORDS = 1 << 19
BITS = 14
MIDDLES, FIRSTS = 16, 4  # shards
BLOCK_BYTES = 4 << 20
#: Twice the log of the likelihood ratio, and how many times the other share of texts, from which
#: on an expression's counts are its model's own.
TELLING, TIMES = 25.0, 20.0
#: Share of the other model's texts that may have it: common expressions tell little in single texts.
RARE = 0.001
#: Bytes of the beginnings of words that are looked at, and the name of the whole word.
WHOLE = 1 << 20
LENGTHS = (WHOLE, 7, 6, 5, 4)

# Kinds of bytes whose mixture is a word's shape. Words outside the vocabulary are
# known by their shape and length, and spelled by a model of letters where one is learned; a word
# equal to the one before it is known as a first, second or later repetition.
KIND = np.full(256, 16, np.uint8)
KIND[ord("a") : ord("z") + 1] = 1
KIND[ord("A") : ord("Z") + 1] = 2
KIND[ord("0") : ord("9") + 1] = 4
KIND[[ord("."), ord(",")]] = 8
KIND[128:] = 32
START, REPEAT, REPEATS = 0, 1, 3
SHAPES = 1 + REPEATS + 64 * 4

EVENTS = "shard int, salt int, kind int, key long, block long, payload binary"
PACKED = "shard int, kind int, key long, payload binary"
TRIGRAM, CONTEXT, BIGRAM, MIDDLE = range(4)
#: A letter is a byte, or the edge of a word (0); a key is a letter after those before it.
LETTERS, LETTER_BITS, LETTER_ORDER = 257, 9, 5


class Letters:
    """Witten-Bell model of a word's bytes: probabilities of words, over all strings one in sum."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """Distinct keys of the highest order and their counts."""
        self.tables: list = []
        for order in range(1, LETTER_ORDER + 1):
            own, at = np.unique(keys & ((1 << (LETTER_BITS * order)) - 1), return_inverse=True)
            uses = np.bincount(at, counts, len(own))
            contexts, of, kinds = np.unique(own >> LETTER_BITS, return_inverse=True, return_counts=True)
            total = np.bincount(of, uses, len(contexts)) + kinds
            left = kinds / total
            p = uses / total[of] + left[of] * self.probabilities(own)
            self.tables.append(((own, p), (contexts, left)))

    def probabilities(self, keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1 / LETTERS)
        for order, (known, contexts) in enumerate(self.tables, 1):
            own = keys & ((1 << (LETTER_BITS * order)) - 1)
            p = _look_up(known, own, _look_up(contexts, own >> LETTER_BITS, 1.0) * p)
        return p


def letters_of(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each byte of the chosen words and of their ends, and the place of the word in `chosen`."""
    begin, sizes = words.begin[chosen], words.end[chosen] - words.begin[chosen]
    word = np.repeat(np.arange(len(chosen)), sizes + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(sizes + 1) - sizes - 1, sizes + 1)
    letter = np.zeros(len(word), np.int64)
    inside = place < sizes[word]
    letter[inside] = words.data[(begin[word] + place)[inside]].astype(np.int64) + 1
    keys = letter.copy()
    for back in range(1, LETTER_ORDER):
        keys[back:] |= np.where(place[back:] >= back, letter[:-back], 0) << (LETTER_BITS * back)
    return keys, word


@dataclass
class Vocabulary:
    """Hashes of the known words, sorted; a word's number is SHAPES plus its place."""

    hashes: np.ndarray
    fold: bool
    letters_only: bool
    #: Beginnings of words, by length, and whole words that tell two models apart: longer ones first,
    #: so that a word goes by its shortest telling beginning.
    telling: dict[int, np.ndarray] = field(default_factory=dict)
    unigrams: list[np.ndarray] = field(default_factory=list)
    #: How words that go by their shapes are spelled: the training texts' most frequent by their share
    #: there (hashes, log-probabilities), with the log of what is left for all strings of letters.
    letters: Letters | None = None
    rare: tuple[np.ndarray, np.ndarray] = (np.empty(0, np.uint64), np.empty(0))
    left: float = 0.0

    def spelled(self, words: Words, numbers: np.ndarray) -> np.ndarray:
        """Per text, the log-probability of its words where they go by their shapes."""
        chosen = np.flatnonzero((numbers > REPEATS) & (numbers < SHAPES))
        if self.letters is None or not len(chosen):
            return np.zeros(len(words.counts))
        names, first, same = np.unique(words.hashes()[chosen], return_index=True, return_inverse=True)
        keys, word = letters_of(words, chosen[first])
        keys, at = np.unique(keys, return_inverse=True)
        each = self.left + np.bincount(word, np.log(self.letters.probabilities(keys))[at])
        each = np.logaddexp(_look_up(self.rare, names, -np.inf), each)
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        return np.bincount(owner[chosen], each[same], len(words.counts))

    def numbers(self, words: Words) -> np.ndarray:
        hashes = words.hashes()
        if not len(hashes):
            return np.empty(0, np.int64)
        kinds = KIND[words.data]
        lengths = words.end - words.begin
        spans = np.ravel(np.column_stack((words.begin, words.end)))
        shape = np.bitwise_or.reduceat(np.append(kinds, np.uint8(0)), spans)[::2].astype(np.int64)
        out = 1 + REPEATS + shape * 4 + np.searchsorted(np.array([3, 8, 20]), lengths)
        _renumber(out, hashes, self.hashes, SHAPES)
        base = SHAPES + len(self.hashes)
        for length, own in self.telling.items():
            _renumber(out, hashes if length == WHOLE else words.hashes(length), own, base)
            base += len(own)
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = hashes[1:] != hashes[:-1]
        edges = words.first[1:-1]
        fresh[edges[edges < len(hashes)]] = True  # texts lie side by side
        at = np.arange(len(hashes))
        run = np.minimum(at - np.maximum.accumulate(np.where(fresh, at, 0)), REPEATS)
        out[run > 0] = REPEAT + run[run > 0] - 1
        return out

    @property
    def size(self) -> int:
        return SHAPES + len(self.hashes) + sum(map(len, self.telling.values()))

    @property
    def telling_numbers(self) -> range:
        return range(SHAPES + len(self.hashes), self.size)


def _renumber(out: np.ndarray, hashes: np.ndarray, known: np.ndarray, base: int) -> None:
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        found = known[at] == hashes
        out[found] = base + at[found]


def trigrams(column: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, text) of each word with the two before it, and the number of words of each text."""
    words = Words(column, vocabulary.fold, vocabulary.letters_only)
    return trigrams_of(words, vocabulary.numbers(words))


def trigrams_of(words: Words, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = words.counts
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(numbers)) - np.repeat(words.first[:-1], counts)
    before = np.concatenate(([START], numbers[:-1])) if len(numbers) else numbers
    earlier = np.concatenate(([START, START], numbers[:-2])) if len(numbers) > 1 else np.zeros_like(numbers)
    before = np.where(place >= 1, before, START)
    earlier = np.where(place >= 2, earlier, START)
    return (earlier << (2 * BITS)) | (before << BITS) | numbers, owner, counts


def shard_of(first, middle):
    return (middle * 40503 >> 4) % MIDDLES * FIRSTS + (first * 40503 >> 4) % FIRSTS


def _shard(first: str, middle: str):
    return F.expr(f"CAST(shiftright({middle} * 40503, 4) % {MIDDLES} * {FIRSTS} + shiftright({first} * 40503, 4) % {FIRSTS} AS INT)")


def _count_words(batches, fold: bool, letters_only: bool):
    for batch in batches:
        for piece in slices(batch):
            hashes, counts = np.unique(Words(piece.column("text"), fold, letters_only).hashes(), return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": hashes.view(np.int64), "uses": counts.astype(np.int64)})


def _count_trigrams(batches, vocabulary: Vocabulary):
    for batch in batches:
        for piece in slices(batch):
            keys, owner, _ = trigrams(piece.column("text"), vocabulary)
            model = piece.column("model").to_numpy().astype(np.int64)[owner] if len(owner) else owner
            both, counts = np.unique((model << (3 * BITS)) | keys, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "model": (both >> (3 * BITS)).astype(np.int32), "key": both & ((1 << (3 * BITS)) - 1), "c": counts.astype(np.int64)
            })


def learn_vocabulary(training: DataFrame, size: int, fold: bool, letters_only: bool) -> Vocabulary:
    """The most frequent words of the training texts; `size` bounds what is collected."""
    counted = training.select("text").mapInArrow(lambda b: _count_words(b, fold, letters_only), "word long, uses long")
    top = counted.groupBy("word").agg(F.sum("uses").alias("uses")).where("uses > 1").orderBy(F.desc("uses"), "word").limit(size)
    hashes = np.sort(top.select("word").toArrow().column("word").to_numpy().view(np.uint64))
    return Vocabulary(hashes, fold, letters_only)


def _count_letters(batches, vocabulary: Vocabulary):
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"), vocabulary.fold, vocabulary.letters_only)
            numbers = vocabulary.numbers(words)
            keys, uses = np.unique(letters_of(words, np.flatnonzero((numbers > REPEATS) & (numbers < SHAPES)))[0], return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": keys, "uses": uses.astype(np.int64)})


def _count_rare(batches, vocabulary: Vocabulary):
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"), vocabulary.fold, vocabulary.letters_only)
            numbers = vocabulary.numbers(words)
            hashes, uses = np.unique(words.hashes()[(numbers > REPEATS) & (numbers < SHAPES)], return_counts=True)
            yield pa.RecordBatch.from_pydict({"word": hashes.view(np.int64), "uses": uses.astype(np.int64)})


def most_used(counted: DataFrame, most: int) -> DataFrame:
    """Words of (word, uses) used at least so often that no more than `most` are; equal uses go together."""
    by_uses = counted.groupBy("uses").agg(F.count(F.lit(1)).alias("n")).toArrow()  # a row per number of uses
    uses, n = by_uses.column("uses").to_numpy(), by_uses.column("n").to_numpy()
    order = np.argsort(-uses)
    kept = uses[order][np.cumsum(n[order]) <= most]
    return counted.where(F.col("uses") >= int(kept[-1])) if len(kept) else counted.limit(0)


def learn_letters(training: DataFrame, vocabulary: Vocabulary, scratch: Scratch, most: int = RARE_WORDS) -> None:
    """Give the vocabulary the most frequent of the training texts' other words, and the letters of
    all of them for the rest; `most` bounds the words that are collected."""
    counted = training.select("text").mapInArrow(lambda b: _count_rare(b, vocabulary), "word long, uses long")
    counted = scratch.keep(counted.groupBy("word").agg(F.sum("uses").alias("uses")), "rare")
    found = most_used(counted, most).toArrow()
    words, uses = found.column("word").to_numpy().view(np.uint64), found.column("uses").to_numpy()
    every = counted.agg(F.sum("uses")).first()[0] or 0
    order, total = np.argsort(words), max(every + len(uses), 1)
    vocabulary.rare = words[order], np.log(uses[order] / total)
    vocabulary.left = float(np.log(max(every - uses.sum() + len(uses), 1) / total))
    counted = training.select("text").mapInArrow(lambda b: _count_letters(b, vocabulary), "key long, uses long")
    found = counted.groupBy("key").agg(F.sum("uses").alias("uses")).toArrow()  # runs of letters: not many more in more texts
    vocabulary.letters = Letters(found.column("key").to_numpy(), found.column("uses").to_numpy())


def _discounts(counts: DataFrame, models: int) -> list[tuple[float, float, float]]:
    """Modified Kneser-Ney discounts d1, d2, d3 of each model from its counts of counts."""
    found = counts.agg(*[F.count_if(F.col(f"c{m}") == k).alias(f"n{m}_{k}") for m in range(models) for k in range(1, 5)]).first()
    out = []
    for m in range(models):
        n = [0, *(found[f"n{m}_{k}"] for k in range(1, 5))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        # Tiny samples may lack a count of counts; half of the count is taken off then.
        out.append(tuple(max(0.05 * k, k - (k + 1) * y * n[k + 1] / n[k]) if n[1] and n[k] else k / 2 for k in (1, 2, 3)))
    return out


def _interpolated(counts: DataFrame, context: list[str], models: int) -> tuple[DataFrame, DataFrame]:
    """Discounted probabilities a0, a1 of counts c0, c1, and the weights g0, g1 that each context
    leaves to the lower order; null where a model has no such count."""
    each = list(zip(range(models), _discounts(counts, models)))
    taken = {
        f"taken{m}": F.least(F.when(F.col(f"c{m}") == 1, d[0]).when(F.col(f"c{m}") == 2, d[1]).otherwise(d[2]), F.col(f"c{m}")) for m, d in each
    }
    counts = counts.withColumns(taken)
    sums = [F.sum(f"{name}{m}").alias(f"{name}_all{m}") for m, _ in each for name in ("c", "taken")]
    totals = counts.groupBy(*context).agg(*sums)
    a = {f"a{m}": F.when(F.col(f"c{m}") > 0, (F.col(f"c{m}") - F.col(f"taken{m}")) / F.col(f"c_all{m}")) for m, _ in each}
    g = [F.when(F.col(f"c_all{m}") > 0, F.col(f"taken_all{m}") / F.col(f"c_all{m}")).alias(f"g{m}") for m, _ in each]
    return counts.join(totals, context).withColumns(a), totals.select(*context, *g)


def _count_expressions(batches, fold: bool, letters_only: bool):
    """In how many texts of each model each word and each beginning of a word stands."""
    for batch in batches:
        for piece in slices(batch):
            words = Words(piece.column("text"), fold, letters_only)
            owner = np.repeat(np.arange(len(words.counts)), words.counts)
            model = piece.column("model").to_numpy().astype(np.int64)
            for length in LENGTHS:
                hashes = words.hashes() if length == WHOLE else words.hashes(length)
                order = np.lexsort((owner, hashes))
                h, o = hashes[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                own, at = np.unique(h[new], return_inverse=True)
                toxic = np.bincount(at, model[o[new]], len(own)) if len(own) else np.empty(0)
                every = np.bincount(at, minlength=len(own))
                yield pa.RecordBatch.from_pydict({
                    "length": np.full(len(own), length, np.int32), "word": own.view(np.int64),
                    "there": toxic.astype(np.int64), "every": every.astype(np.int64),
                })


def learn_telling(training: DataFrame, vocabulary: Vocabulary, most: int = 2048) -> None:
    """Give the vocabulary the expressions that model 1's texts have far more often than model 0's.

    An expression is a word or the beginning of one; it tells when its likelihood ratio is at least
    TELLING and its share of texts TIMES as high, with at most
    RARE of the other texts having it. `most` bounds what is collected.
    """
    sizes = {r.model: r.n for r in training.groupBy("model").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return
    counted = training.select("text", "model").mapInArrow(
        lambda b: _count_expressions(b, vocabulary.fold, vocabulary.letters_only), "length int, word long, there long, every long"
    ).groupBy("length", "word").agg(F.sum("there").alias("x"), (F.sum("every") - F.sum("there")).alias("y"))

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    x, y, both, n = F.col("x"), F.col("y"), F.col("x") + F.col("y"), n1 + n0
    ratio = 2 * (part(x, both * n1 / n) + part(y, both * n0 / n) + part(n1 - x, n1 - both * n1 / n) + part(n0 - y, n0 - both * n0 / n))
    found = counted.withColumn("ratio", ratio).where(
        (F.col("ratio") >= TELLING) & ((x + 0.5) / (n1 + 1) >= TIMES * (y + 0.5) / (n0 + 1)) & (y <= RARE * n0)
    ).orderBy(F.desc("ratio"), "length", "word").limit(most).select("length", "word").toArrow()
    length, word = found.column("length").to_numpy(), found.column("word").to_numpy().view(np.uint64)
    vocabulary.telling = {k: np.sort(word[length == k]) for k in LENGTHS}


def shared_counts(tri: DataFrame, telling: range) -> DataFrame:
    """Counts of two models in which only n-grams that end in a telling expression differ.

    All other n-grams get the pooled count in both, so that chance differences between rare
    expressions do not tell the models apart; those of telling words are scaled to the pooled size.
    """
    totals = tri.agg(F.sum("c0"), F.sum("c1")).first()
    sizes = [int(n or 0) for n in totals]
    own = [
        F.when(F.col(f"c{m}") > 0, F.greatest(F.lit(1), F.round(F.col(f"c{m}") * (sum(sizes) / (sizes[m] or 1)))).cast("long")).otherwise(0)
        for m in range(2)
    ]
    tells = F.col("w").between(telling.start, telling.stop - 1)
    return tri.withColumns({f"c{m}": F.when(tells, own[m]).otherwise(F.col("c0") + F.col("c1")) for m in range(2)})


def train(training: DataFrame, vocabulary: Vocabulary, models: int, scratch: Scratch) -> DataFrame:
    """Tables of the models from rows (text, model), as rows for the shards; sets the unigrams.

    A row has what all models say of a key: null where one has nothing. Two models share the counts
    of all but telling words, and the lowest order of each falls back on the pooled continuation
    counts, so that rare words weigh alike in both.
    """
    every = range(models)
    counted = training.select("text", "model").mapInArrow(lambda b: _count_trigrams(b, vocabulary), "model int, key long, c long")
    part = lambda shift: F.expr(f"shiftright(key, {shift}) & {(1 << BITS) - 1}")
    tri = counted.groupBy("key").agg(*[F.sum(F.when(F.col("model") == m, F.col("c")).otherwise(0)).alias(f"c{m}") for m in every])
    columns = [f"c{m}" for m in every]
    tri = scratch.keep(tri.select("key", part(2 * BITS).alias("u"), part(BITS).alias("v"), part(0).alias("w"), *columns), "trigrams")
    if models == 2:
        tri = shared_counts(tri, vocabulary.telling_numbers)
    bi = tri.groupBy("v", "w").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in columns])
    bi = scratch.keep(bi, "bigrams")
    uni = bi.groupBy("w").agg(*[F.count_if(F.col(c) > 0).alias(c) for c in columns]).toArrow()  # a row per word of the vocabulary
    counts = np.zeros((models, vocabulary.size))
    for m in every:
        counts[m, uni.column("w").to_numpy()] = uni.column(f"c{m}").to_numpy()
    pooled = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * vocabulary.size)
    vocabulary.unigrams = []
    for own in counts:
        taken = np.minimum(own, 0.75)
        left = taken.sum() / max(own.sum(), 1) if own.sum() else 1.0
        vocabulary.unigrams.append((own - taken) / max(own.sum(), 1) + left * pooled)
    a3, g3 = _interpolated(tri, ["u", "v"], models)
    a2, g2 = _interpolated(bi, ["v"], models)
    lowest = tri.sparkSession.createDataFrame(
        [(w, *map(float, p)) for w, p in enumerate(zip(*vocabulary.unigrams))], "w long, " + ", ".join(f"p{m} double" for m in every)
    )
    p2 = a2.join(g2, ["v"]).join(lowest, ["w"]).withColumns({f"p{m}": F.col(f"a{m}") + F.col(f"g{m}") * F.col(f"p{m}") for m in every})

    def rows(table, kind, key, value):
        values = [F.col(f"{value}{m}") if m < models else F.lit(None) for m in range(2)]
        return table.select(
            "shard", F.lit(kind).alias("kind"), key.cast("long").alias("key"),
            *[v.cast("float").alias(name) for v, name in zip(values, ("value", "other"))],
        )

    first = F.explode(F.sequence(F.lit(0), F.lit(FIRSTS - 1)))
    v_w, u_v = F.expr(f"shiftleft(v, {BITS}) | w"), F.expr(f"shiftleft(u, {BITS}) | v")
    return (
        rows(a3.withColumn("shard", _shard("u", "v")), TRIGRAM, F.col("key"), "a")
        .unionAll(rows(g3.withColumn("shard", _shard("u", "v")), CONTEXT, u_v, "g"))
        .unionAll(rows(p2.withColumn("first", first).withColumn("shard", _spread("first")), BIGRAM, v_w, "p"))
        .unionAll(rows(g2.withColumn("first", first).withColumn("shard", _spread("first")), MIDDLE, F.col("v"), "g"))
    )


def _spread(first: str):
    return F.expr(f"CAST(shiftright(v * 40503, 4) % {MIDDLES} * {FIRSTS} + {first} AS INT)")


def _planes(values: np.ndarray, width: int) -> list[np.ndarray]:
    return [((values >> (8 * k)) & 255).astype(np.uint8) for k in range(width)]


def _merged(planes: list[bytes]) -> np.ndarray:
    return sum(np.frombuffer(p, np.uint8).astype(np.int64) << (8 * k) for k, p in enumerate(planes))


def _packed(batches):
    """Runs of sorted rows of one shard and kind: steps between their keys, and each model's values."""
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        shard, kind, key = (batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "kind", "key"))
        values = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.float32) for c in ("value", "other")]
        cuts = (np.flatnonzero(np.diff((shard << 16) | kind)) + 1).tolist()
        out = []
        for begin, end in zip([0, *cuts], [*cuts, len(key)]):
            if begin < end:
                steps = _planes(np.diff(key[begin:end], prepend=0), 6)
                out.append({"shard": shard[begin], "kind": kind[begin], "key": key[begin], "payload": pack(*(v[begin:end] for v in values), *steps)})
        yield pa.RecordBatch.from_pylist(out, schema)


def packed(tables: DataFrame) -> DataFrame:
    """The rows of `train` for writing: some bytes an n-gram, in the order in which the shards read them."""
    rows = tables.repartition("shard").sortWithinPartitions("shard", "kind", "key")
    return rows.mapInArrow(_packed, PACKED)


def _events(batches, vocabulary: Vocabulary, salts: int):
    """Blocks of documents to packed trigrams by shard, and one row about the documents."""
    part, count = TaskContext.get().partitionId(), 0
    held: list = []
    size = 0

    def rows():
        block = (part << 32) + count
        keys, owners, docs, marks, counts, spelled, base = [], [], [], [], [], [], 0
        for piece in held:
            words = Words(piece.column("text"), vocabulary.fold, vocabulary.letters_only)
            numbers = vocabulary.numbers(words)
            key, owner, own = trigrams_of(words, numbers)
            spelled.append(vocabulary.spelled(words, numbers))
            keys.append(key)
            owners.append(owner + base)
            counts.append(own)
            docs += piece.column("doc_id").to_pylist()
            marks += piece.column("mark").to_pylist()
            base += len(own)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        mask = (1 << BITS) - 1
        shard = shard_of(key >> (2 * BITS), (key >> BITS) & mask)
        order = np.lexsort((owner, key, shard))
        key, owner, shard = key[order], owner[order], shard[order]
        cuts = np.searchsorted(shard, np.arange(MIDDLES * FIRSTS + 1))
        head = pack(
            np.array([d or 0 for d in docs], np.int64), np.array([d is not None for d in docs], bool),
            np.array(marks, np.int64), np.concatenate(counts).astype(np.int64),
            np.concatenate(spelled),
        )
        out = [{"shard": -1 - block % 1024, "salt": 0, "kind": 9, "key": 0, "block": block, "payload": head}]
        for k in range(MIDDLES * FIRSTS):
            own, text = key[cuts[k] : cuts[k + 1]], owner[cuts[k] : cuts[k + 1]]
            if len(own):
                new = np.concatenate(([True], own[1:] != own[:-1]))
                uses = np.diff(np.append(np.flatnonzero(new), len(own)))
                step = np.diff(own[new], prepend=0)
                payload = pack(np.array([base], np.int64), *_planes(uses, 4), *_planes(step, 6), *_planes(text, 4))
                out.append({"shard": k, "salt": block % salts, "kind": 9, "key": 0, "block": block, "payload": payload})
        return pa.RecordBatch.from_pylist(out, EVENT_SCHEMA)

    for batch in batches:
        for piece in slices(batch):
            held.append(piece)
            size += piece.nbytes
            if size >= BLOCK_BYTES:
                yield rows()
                held, size, count = [], 0, count + 1
    if held:
        yield rows()


EVENT_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("salt", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()),
    ("block", pa.int64()), ("payload", pa.binary()),
])


def _look_up(table: tuple[np.ndarray, np.ndarray] | None, keys: np.ndarray, default) -> np.ndarray:
    if table is None or not len(table[0]):
        return np.broadcast_to(np.asarray(default, np.float64), keys.shape).copy()
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return np.where(table[0][at] == keys, table[1][at], default)


def _score(batches, vocabulary: Vocabulary, models: int):
    """Rows by (shard, salt, kind, key): a shard's tables, then its packed trigrams."""
    current, parts, tables = None, {}, None
    mask = (1 << BITS) - 1
    schema = pa.schema([("block", pa.int64()), ("payload", pa.binary())])
    for batch in batches:
        shard, salt, kind = (batch.column(c).to_numpy().astype(np.int64) for c in ("shard", "salt", "kind"))
        group = ((shard + (1 << 20)) << 40) | (salt << 16) | kind
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)] if len(group) else [0]
        for begin, end in zip(edges, edges[1:]):
            place = (int(shard[begin]), int(salt[begin]))
            if place != current:
                current, parts, tables = place, {}, None
            if kind[begin] < 9:
                for payload in batch.column("payload").slice(begin, end - begin).to_pylist():
                    value, other, *steps = unpack(payload)
                    key = np.cumsum(_merged(steps))
                    for m, own in enumerate((value, other)[:models]):
                        own = np.frombuffer(own, np.float32)
                        known = ~np.isnan(own)
                        parts.setdefault((m, int(kind[begin])), []).append((key[known], own[known]))
                continue
            if tables is None:
                tables, parts = {name: tuple(np.concatenate(x) for x in zip(*pieces)) for name, pieces in parts.items()}, {}
            for k in range(begin, end):
                block, payload = batch.column("block")[k].as_py(), batch.column("payload")[k].as_py()
                if place[0] < 0:
                    yield pa.RecordBatch.from_pydict({"block": [block], "payload": [b"H" + payload]}, schema=schema)
                    continue
                size, *planes = unpack(payload)
                size = int(np.frombuffer(size, np.int64)[0])
                uses, found, text = _merged(planes[:4]), np.cumsum(_merged(planes[4:10])), _merged(planes[10:])
                u_v, v, v_w, w = found >> BITS, (found >> BITS) & mask, found & ((1 << (2 * BITS)) - 1), found & mask
                sums = []
                for m in range(models):
                    lower = _look_up(tables.get((m, MIDDLE)), v, 1.0) * vocabulary.unigrams[m][w]
                    lower = _look_up(tables.get((m, BIGRAM)), v_w, lower)
                    p = _look_up(tables.get((m, TRIGRAM)), found, 0.0) + _look_up(tables.get((m, CONTEXT)), u_v, 1.0) * lower
                    sums.append(np.bincount(text, np.repeat(np.log(p), uses), size).astype(np.float32))
                yield pa.RecordBatch.from_pydict({"block": [block], "payload": [b"S" + pack(*sums)]}, schema=schema)


def _collect(batches, models: int):
    """Rows by block: sums of the shards and the row about the documents, in any order."""
    current, head, sums = None, None, None

    def rows():
        docs, valid, marks, counts, spelled = head
        docs, valid = np.frombuffer(docs, np.int64), np.frombuffer(valid, bool)
        own = sums if sums is not None else np.zeros((models, len(docs)))
        own = own + np.frombuffer(spelled, np.float64)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(docs) + 1, dtype=np.int32) * models), pa.array(own.T.ravel()))
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(docs, pa.int64(), mask=~valid), "mark": np.frombuffer(marks, np.int64),
            "n_words": np.frombuffer(counts, np.int64), "log_likelihood": flat,
        })

    for batch in batches:
        for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload").to_pylist()):
            if block != current:
                if head is not None:
                    yield rows()
                current, head, sums = block, None, None
            parts = unpack(payload[1:])
            if payload[:1] == b"H":
                head = parts
            else:
                more = np.array([np.frombuffer(p, np.float32) for p in parts], np.float64)
                sums = more if sums is None else sums + more
    if head is not None:
        yield rows()


def mark(text_column: str):
    return F.xxhash64(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))


def log_likelihoods(docs: DataFrame, tables: DataFrame, vocabulary: Vocabulary, models: int) -> DataFrame:
    """(doc_id, mark, n_words, log_likelihood of each model) per row of docs (doc_id, mark, text).

    `tables` are those of `train`, packed or not.
    """
    spark = docs.sparkSession
    if "payload" not in tables.columns:
        tables = packed(tables)
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // (MIDDLES * FIRSTS))
    shared = spark.sparkContext.broadcast(vocabulary)
    events = docs.select("doc_id", "mark", "text").mapInArrow(lambda b: _events(b, shared.value, salts), EVENTS)
    model = tables.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "kind", "key",
        F.lit(None).cast("long").alias("block"), "payload",
    )
    rows = events.unionAll(model).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind", "key", "block")
    scored = rows.mapInArrow(lambda b: _score(b, shared.value, models), "block long, payload binary")
    rows = scored.repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(lambda b: _collect(b, models), "doc_id long, mark long, n_words long, log_likelihood array<double>")
