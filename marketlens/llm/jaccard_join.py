"""Near-duplicate documents: a Jaccard self-join on word shingles by T-occurrence search.

Two sets of sizes m and n are linked when 100 |A & B| >= percent |A | B|, so they must share
T = ceil(percent (m + n) / (100 + percent)) shingles. A search takes one set as the query, the
inverted lists of its shingles over the other sets, merges the short lists by counting, keeps what
reaches T less the number of long lists, and looks the rest up in the long lists by bisection
(DivideSkip).

What is searched where is decided by Spark: equal sets become one class; every class is filed under
its rarest shingles, as many as any partner must share one of; files are split by size. First each
file's smallest class is the query against the rest of its file. Classes found connected need no
further comparison, so a group of thousands of near copies costs its size, not its square. Then
every remaining pair that shares a rare shingle, is not yet connected and can still reach T goes
through the same search. No link between different components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.components import connected
from marketlens.llm.kneser_ney import mark as text_mark
from marketlens.llm.scratch import Scratch, own_name
from marketlens.llm.words import ODD, Words, mixed, slices, windows

SHINGLE = 5
PERCENT = 80
STAR_ROUNDS = 2
#: Counters of the frequency sketch, and bits of the filter of classes: bounds of what is broadcast.
SLOTS = 1 << 22
FILTER_BITS = 1 << 24
#: Sets in the index of one search.
CHUNK = 256
#: Lists that are probed rather than merged; any number gives the same links.
MOST_LONG = 32


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted by (text, hash), and where each text begins."""
    words = Words(column, fold=True)
    hashes, counts = words.hashes(), words.counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), sizes)
    starts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(starts, sizes) + np.repeat(words.first[:-1], sizes)
    full = windows(hashes, width)
    out = np.empty(len(at), np.uint64)
    whole = np.repeat(counts >= width, sizes)
    out[whole] = full[at[whole]]
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        begin = words.first[text]
        few = hashes[begin : begin + counts[text]]
        out[starts[text]] = windows(few, len(few), seed=1)[0]
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[new], owner[new]
    return out, np.searchsorted(owner, np.arange(len(counts) + 1))


def class_ids(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number per set, equal for equal sets; 0 for empty sets."""
    sizes = np.diff(first)
    sums = np.zeros(len(sizes), np.uint64)
    some = sizes > 0
    if some.any():
        sums[some] = np.add.reduceat(mixed(hashes ^ ODD[5]), first[:-1][some])
    out = mixed(sums + sizes.astype(np.uint64) * ODD[9])
    out[~some] = 0
    return out.view(np.int64)


def _heavy_slots(width: int):
    """Slots of the sketch that many documents of a task use; the rest is left at zero."""

    def run(batches):
        counts, seen = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for piece in slices(batch):
                hashes, _ = shingle_sets(piece.column("text"), width)
                seen += len(hashes)
                counts += np.bincount((hashes >> np.uint64(20)).astype(np.int64) % SLOTS, minlength=SLOTS)
        heavy = np.flatnonzero(counts >= 2 + 2 * seen / SLOTS)
        yield pa.RecordBatch.from_pydict({"slot": heavy.astype(np.int32), "uses": counts[heavy]})

    return run


def _frequency(docs: DataFrame, width: int) -> np.ndarray:
    """A small number per slot, higher where more documents use it: an order, bounded in size."""
    found = docs.mapInArrow(_heavy_slots(width), "slot int, uses long").groupBy("slot").agg(F.sum("uses").alias("uses"))
    rows = found.toArrow()
    rank = np.zeros(SLOTS, np.uint8)
    uses = rows.column("uses").to_numpy()
    rank[rows.column("slot").to_numpy()] = np.minimum(4 * np.log2(np.maximum(uses, 1)), 255).astype(np.uint8)
    return rank


def _prefixes(width: int, percent: int, rank):
    """doc_id, set size, class and, in the order rare first, the shingles of which partners share one."""

    def run(batches):
        table = rank.value
        for batch in batches:
            for piece in slices(batch):
                hashes, first = shingle_sets(piece.column("text"), width)
                sizes = np.diff(first)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                weight = table[(hashes >> np.uint64(20)).astype(np.int64) % SLOTS]
                order = np.lexsort((hashes, weight, owner))
                place = np.arange(len(hashes)) - np.repeat(first[:-1], sizes)
                lengths = np.where(sizes > 0, sizes - -(-percent * sizes // 100) + 1, 0)
                kept = hashes[order][place < np.repeat(lengths, sizes)]
                ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": piece.column("doc_id"),
                    "mark": piece.column("mark"),
                    "n_shingles": sizes.astype(np.int64),
                    "class": class_ids(hashes, first),
                    "prefix": pa.ListArray.from_arrays(pa.array(ends), pa.array(kept.view(np.int64))),
                })

    return run


def _held(classes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the classes the filter may hold."""
    spot = classes.view(np.uint64) % np.uint64(FILTER_BITS)
    return (bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def _needed_texts(width: int, bits):
    """(class, packed text) of the classes that the filter may hold, once per task."""

    def run(batches):
        wanted, done, squeeze = bits.value, set(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch):
                classes = class_ids(*shingle_sets(piece.column("text"), width))
                ids, packed = [], []
                for text in np.flatnonzero(_held(classes, wanted) & (classes != 0)):
                    if (name := int(classes[text])) not in done:
                        done.add(name)
                        ids.append(name)
                        packed.append(squeeze.compress(piece.column("text")[int(text)].as_buffer()))
                yield pa.RecordBatch.from_pydict({"class": pa.array(ids, pa.int64()), "packed": pa.array(packed, pa.binary())})

    return run


def _picked(bits):
    """The rows (class, packed text) of the classes that the filter may hold."""

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_held(batch.column("class").to_numpy(), bits.value)))

    return run


def _filter(classes: DataFrame) -> np.ndarray:
    """Bits of the classes, ored together before they leave the executors: a fixed size."""
    # FILTER_BITS divides 2^64, so pmod agrees with the remainder of the unsigned reading.
    words = (
        classes.select(F.pmod(F.col("class"), F.lit(FILTER_BITS)).alias("spot"))
        .select(F.expr("CAST(spot DIV 64 AS INT)").alias("at"), F.expr("shiftleft(1L, CAST(spot % 64 AS INT))").alias("bits"))
        .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def overlaps(query: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """T-occurrence search by DivideSkip: which of `sets` are linked with `query`. All are sorted."""
    sizes = np.array([len(s) for s in sets])
    needed = -(-percent * (sizes + len(query)) // (100 + percent))
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    entry = np.minimum(np.searchsorted(query, tokens), len(query) - 1)
    hit = query[entry] == tokens
    entry, owner = entry[hit], owner[hit]
    # One inverted list per shingle of the query: (list, set) in order.
    order = np.argsort(entry, kind="stable")
    entry, owner = entry[order], owner[order]
    lengths = np.bincount(entry, minlength=len(query))
    n_long = min(int(needed.min() / (0.01 * np.log2(lengths.max(initial=0) + 1) + 1)), len(query), MOST_LONG)
    long_lists = np.sort(np.argsort(-lengths, kind="stable")[:n_long])
    is_long = np.zeros(len(query), bool)
    is_long[long_lists] = True
    counts = np.bincount(owner[~is_long[entry]], minlength=len(sets))
    candidates = np.flatnonzero(counts >= needed - n_long)
    if len(candidates) and n_long:
        postings = entry * len(sets) + owner
        probes = long_lists[:, None] * len(sets) + candidates[None, :]
        at = np.minimum(np.searchsorted(postings, probes), max(len(postings) - 1, 0))
        counts[candidates] += (postings[at] == probes).sum(axis=0) if len(postings) else 0
    linked = np.zeros(len(sets), bool)
    shared = counts[candidates]
    linked[candidates] = 100 * shared >= percent * (sizes[candidates] + len(query) - shared)
    return linked


def _search(width: int, percent: int):
    """Rows in the order (query, salt, role): the query's text, then the texts to search."""

    def run(batches):
        query, name, names, sets = None, None, [], []
        expand = zstandard.ZstdDecompressor()

        def links():
            found = [names[k] for k in np.flatnonzero(overlaps(query, sets, percent))] if sets else []
            names.clear()
            sets.clear()
            return found

        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                piece = batch.slice(begin, CHUNK)
                texts = [expand.decompress(packed.as_buffer()) for packed in piece.column("packed")]
                hashes, first = shingle_sets(pa.array(texts, pa.binary()).cast(pa.string()), width)
                a, b = [], []
                for k, (center, role, member) in enumerate(
                    zip(piece.column("a").to_pylist(), piece.column("role").to_pylist(), piece.column("class").to_pylist())
                ):
                    if role == 0 or len(sets) >= CHUNK:
                        found = links()
                        a += [name] * len(found)
                        b += found
                    own = hashes[first[k] : first[k + 1]]
                    if role == 0:
                        query, name = own, center
                    else:
                        names.append(member)
                        sets.append(own)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        found = links()
        yield pa.RecordBatch.from_pydict({"a": pa.array([name] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return run


def _texts(docs: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """(class, packed text) of some classes and a few others, one row each in every task that has it."""
    bits = docs.sparkSession.sparkContext.broadcast(_filter(classes))
    return docs.mapInArrow(_needed_texts(width, bits), "class long, packed binary")


def _linked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked, found by searching a's shingles in the b's texts."""
    # A query with very many candidates is searched in several tasks, each with a share of them.
    load = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / (4 * CHUNK)).cast("int").alias("salts"))
    queries = load.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    members = pairs.join(load, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.col("b").alias("class"))
    wanted = members.select("a", "salt", F.lit(1).alias("role"), "class").unionAll(
        queries.select("a", "salt", F.lit(0).alias("role"), F.col("a").alias("class"))
    )
    # Only texts that are asked for are shuffled; copies from several tasks meet there.
    bits = pairs.sparkSession.sparkContext.broadcast(_filter(pairs.select(F.explode(F.array("a", "b")).alias("class"))))
    texts = texts.mapInArrow(_picked(bits), "class long, packed binary").dropDuplicates(["class"])
    rows = wanted.join(texts, "class").repartition("a", "salt").sortWithinPartitions("a", "salt", "role", "class")
    return rows.mapInArrow(_search(width, percent), "a long, b long")


def near_duplicate_components(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text", marks: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_class): one row per row of `docs`.

    With `marks` also mark, a hash of the text, and component, a key of the component that is null
    only where the set is empty: they tell rows of equal or null id apart.

    Words are runs of bytes other than ASCII white space, A-Z in lower case; a set holds the
    distinct `width`-word shingles, or the whole sequence where there are fewer words. Rows link
    when 100 |A & B| >= percent |A | B|. component_id is the smallest id that links reach, the
    row's own included; n_class counts the rows with the same set. Null and empty texts, and texts
    without words, have an empty set and link with nothing. Null ids take part and are never the
    smallest, so a component of only such rows has a null id. Repeated rows are equal sets. Other
    columns are ignored. No rows give no rows.

    Sets are held as 64-bit hashes of their shingles and compared by them.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    docs = docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"), text_mark(text_column).alias("mark"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    rank = spark.sparkContext.broadcast(_frequency(docs, width))
    prefixes = scratch.keep(
        docs.mapInArrow(_prefixes(width, percent, rank), "doc_id long, mark long, n_shingles long, class long, prefix array<long>"), "prefixes"
    )
    distinct = prefixes.where("n_shingles > 0").dropDuplicates(["class"]).select("class", F.col("n_shingles").cast("int").alias("n"), "prefix")
    distinct = scratch.keep(distinct, "distinct")
    rows = scratch.keep(prefixes.drop("prefix"), "rows")
    scratch.drop("prefixes")
    files = scratch.keep(_files(distinct, percent), "files")
    scratch.drop("distinct")

    texts = scratch.keep(_texts(docs, files.select("class"), width), "texts")
    state = _filed(files).withColumn("component", F.col("class"))
    links = None
    for round_ in range(STAR_ROUNDS):
        stars = scratch.keep(_enough(_stars(state, round_), files, percent), f"stars{round_}")
        found = scratch.keep(_linked(stars, texts, width, percent), f"star-links{round_}")
        component = connected(found if links is None else links.unionAll(found), scratch, f"component{round_}")
        # What is connected goes on as stars: fewer edges, and fewer rounds the next time.
        links = component.select(F.col("node").alias("a"), F.col("component").alias("b"))
        own = files.join(component.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        state = _filed(scratch.keep(own, f"state{round_}"))
    state = scratch.keep(_live(state), "live")
    rest = scratch.keep(_enough(_pairs_apart(state, percent), files, percent), "rest")
    links = links.unionAll(scratch.keep(_linked(rest, texts, width, percent), "rest-links"))
    component = connected(links, scratch, "component")

    classes = rows.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_class"))
    of = classes.join(component.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least_of = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least_of, "component").select("class", "component", "component_id", "n_class")
    return rows.join(named, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_class", F.lit(1)).alias("n_class"), *(["mark", "component"] if marks else []),
    )


def _files(distinct: DataFrame, percent: int) -> DataFrame:
    """(class, n, band, part, tokens, places): of each prefix what another class has in its own too.

    All that two prefixes share is in it, so it stands for them from here on: the shingles of one
    class only, which are most, move once.
    """
    filed = distinct.select("class", "n", F.posexplode("prefix").alias("place", "token"))
    common = filed.groupBy("token").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1").select("token")
    shared = filed.join(common.hint("merge"), "token", "left_semi")
    own = shared.groupBy("class", "n").agg(F.collect_list(F.struct("token", "place")).alias("own"))
    band = F.floor(F.log(F.col("n")) / float(-np.log(percent / 100))).cast("int").alias("band")
    # Classes that share most of their prefix come first as centers: the text that others were made from.
    part = (F.size("own") / (F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)).alias("part")
    return own.select("class", "n", band, part, F.col("own.token").alias("tokens"), F.col("own.place").alias("places"))


def _filed(files: DataFrame) -> DataFrame:
    """The files as one row per class and shingle."""
    others = [c for c in files.columns if c not in ("tokens", "places")]
    each = files.select(*others, F.explode(F.arrays_zip("tokens", "places")).alias("own"))
    return each.select(*others, F.col("own.tokens").alias("token"), F.col("own.places").alias("place"))


def _live(state: DataFrame) -> DataFrame:
    """Files (one per shingle) that classes of more than one component share."""
    live = state.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return state.join(live.select("token").hint("merge"), "token", "left_semi")


def _stars(state: DataFrame, round_: int) -> DataFrame:
    """Pairs of each file's two centers, which change from round to round, with its other classes."""
    # Within a band sizes differ by less than the limit allows.
    names = F.xxhash64("class", F.lit(round_)).alias("key"), F.col("class").alias("a"), F.col("component").alias("of")
    entry = F.struct(*names)
    first = F.max(F.struct("part", *names)) if round_ == 0 else F.min(entry)
    ends = state.groupBy("token", "band").agg(first.alias("first"), F.max(entry).alias("last"), F.count(F.lit(1)).alias("uses")).where("uses > 1")
    centers = F.explode(F.array(*[F.struct(f"{end}.a", f"{end}.of") for end in ("first", "last")])).alias("c")
    centers = ends.select("token", "band", centers).select("token", "band", "c.a", "c.of")
    pairs = state.join(centers.hint("merge"), ["token", "band"]).where("component <> of")
    return pairs.select(F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b")).distinct()


def _pairs_apart(state: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components that can be linked by where they share a shingle."""
    x, y = state.alias("x"), state.alias("y")
    least = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent))
    # The first shingle that two linked sets share leaves enough of both to reach the overlap.
    most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    near = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component")) & near & (most >= least))
    return pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def _enough(pairs: DataFrame, files: DataFrame, percent: int) -> DataFrame:
    """The pairs whose prefixes share as many shingles as those of linked sets do at least."""
    x = files.select(F.col("class").alias("a"), F.col("n").alias("m"), F.col("tokens").alias("p"))
    y = files.select(F.col("class").alias("b"), "n", F.col("tokens").alias("q"))
    enough = F.size(F.array_intersect("p", "q")) >= _least_in_prefix("m", "n", percent)
    return pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").where(enough).select("a", "b")


def _least_in_prefix(m: str, n: str, percent: int) -> Column:
    """How many shingles of their prefixes two linked sets of these sizes share at least.

    Of the two prefixes let p end first, in the common order: what the sets share outside of it is
    at most what the set has outside of its prefix, ceil(percent size / 100) - 1.
    """
    overlap = F.ceil(percent * (F.col(m) + F.col(n)) / (100 + percent))
    return F.greatest(F.lit(1), overlap - F.ceil(percent * F.greatest(F.col(m), F.col(n)) / 100) + 1)


def keep_one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` (doc_id, text and others) without near duplicates, columns as they are.

    Of a group the row with the smallest id stays, null ids last, and of its texts the one with the
    smallest hash. Of rows equal in id and text one stays, whatever else they hold; texts without
    words (null and empty ones too) are no duplicates otherwise. Rows go by id and text, so that
    equal and null ids do not take others with them. Very long texts are compared whole; no rows
    give no rows.
    """
    scratch = Scratch(docs.sparkSession, "groups")
    found = near_duplicate_components(docs, width=width, percent=percent, marks=True)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    found = scratch.keep(found.select("component", row.alias("row")), "found")
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min("row").alias("first"))
    gone = found.join(first.hint("merge"), "component").where("row <> first").select("row.doc_id", "row.mark").distinct()
    gone = scratch.keep(gone, "gone")
    own = own_name(docs)
    rows = docs.withColumn(own, text_mark("text"))
    kept = rows.join(gone.hint("merge"), rows["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (rows[own] == gone["mark"]), "left_anti")
    if not found.groupBy("row").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", own])
    return kept.drop(own)
