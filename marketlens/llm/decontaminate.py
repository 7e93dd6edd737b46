"""Benchmark decontamination by a positional inverted index.

The index holds postings (term, document, position) of the training texts for the terms that the
test windows are looked up by: the two rarest of each window, counted over all documents. A search
begins with the list of a window's rarest term, shifts its positions by the term's offset, meets the
list of the second rarest in the same way, and compares what is left with the document's words.
Windows whose two rarest terms stand close to where they should, but not as the phrase, come back
as proximity matches.

Only DataFrame functions are used: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch

# A-Z fold to a-z; all of ASCII but digits and letters parts words.
UPPER = "".join(map(chr, range(0x41, 0x5B)))
APART = "".join(chr(c) for c in range(0x80) if not chr(c).isalnum())
WINDOW = 10
SLOP = 2


def words_of(text: Column) -> Column:
    """Words in lower case, by one pass over the letters and one cut at spaces."""
    even = F.translate(F.coalesce(text, F.lit("")), UPPER + APART, UPPER.lower() + " " * len(APART))
    return F.array_remove(F.split(even, " "), "")


def test_windows(benchmark: DataFrame, width: int, item_column: str, text_column: str, short_items: bool) -> DataFrame:
    """Distinct windows (w, terms, items); w is a hash of the terms, items the ids as text."""
    items = benchmark.select(F.col(f"`{item_column}`").cast("string").alias("item"), words_of(F.col(f"`{text_column}`")).alias("words"))
    least = 1 if short_items else width
    starts = F.when(F.size("words") >= width, F.sequence(F.lit(1), F.size("words") - width + 1)).otherwise(F.array(F.lit(1)))
    return (
        items.where(F.size("words") >= least)
        .select("item", "words", F.explode(starts).alias("begin"))
        .select("item", F.expr(f"slice(words, begin, {width})").alias("terms"))
        .groupBy(F.xxhash64("terms").alias("w"), "terms")
        .agg(F.collect_set("item").alias("items"))
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WINDOW,
    slop: int = SLOP,
    short_items: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """What of the benchmark each document holds: one row per row of `docs`.

    Columns: row (all columns of `docs`, as a struct), n_words, n_hit (words inside an occurrence of
    a window), hits (begin and end of each occurrence, in order), items (ids, as sorted strings, of
    items with an occurring window), n_near (windows met by their two rarest terms within `slop`
    words, but not as a phrase).

    Words are runs of digits, letters and all characters above ASCII, A-Z in lower case. A window
    is `width` consecutive words of an item; an item of fewer, but not none, is one window, or is
    left out without `short_items`. Null texts have no words; items without words have no windows.
    Items without id count for n_hit and are not listed. Repeated documents are found alike, and so
    are repeated items. No documents give no rows; an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    text = F.col(f"`{text_column}`")
    # Repeated ids with different texts stay apart by the hash of the text.
    who = [
        F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(-(2**63))).alias("doc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"),
    ]
    windows = scratch.keep(test_windows(benchmark, width, item_column, item_text_column, short_items), "windows", release=False)
    vocabulary = scratch.keep(windows.select(F.explode("terms").alias("term")).distinct(), "vocabulary", release=False)
    # The size of the written vocabulary is known: Spark broadcasts it if that is small, else shuffles.
    uses = scratch.keep(
        docs.select(F.explode(words_of(text)).alias("term")).join(vocabulary, "term", "left_semi")
        .groupBy("term").agg(F.count(F.lit(1)).alias("uses")),
        "uses",
    )
    offsets = windows.select("w", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term")).join(uses, "term")
    ranked = offsets.groupBy("w", "n").agg(
        F.array_sort(F.collect_list(F.struct("uses", "offset", "term"))).alias("ranked")
    ).where(F.size("ranked") == F.col("n"))  # a term that no document has ends the window's search
    anchors = scratch.keep(
        ranked.select(
            "w",
            F.col("ranked")[0]["term"].alias("rarest"), F.col("ranked")[0]["offset"].alias("rarest_at"),
            F.get("ranked", F.lit(1))["term"].alias("second"), F.get("ranked", F.lit(1))["offset"].alias("second_at"),
        ),
        "anchors", release=False,
    )
    # A null stands after each document's last word, so that its place is the number of words.
    last = spark.createDataFrame([(None,)], "term string")
    looked_up = scratch.keep(
        anchors.select(F.col("rarest").alias("term")).unionAll(anchors.select(F.col("second").alias("term"))).unionAll(last).distinct(),
        "terms", release=False,
    )
    ended = F.concat(words_of(text), F.array(F.lit(None).cast("string")))
    placed = docs.select(*who, F.posexplode(ended).alias("place", "term"))
    # Rows that are equal in id and text are one document here.
    placed = placed.join(looked_up, placed["term"].eqNullSafe(looked_up["term"]), "left_semi").distinct()
    placed = scratch.keep(placed, "index")
    index, lengths = placed.where("term IS NOT NULL"), placed.where("term IS NULL").select("doc", "mark", F.col("place").alias("n_words"))

    first = index.join(anchors, F.col("term") == F.col("rarest")).select(
        "doc", "mark", "w", (F.col("place") - F.col("rarest_at")).alias("begin"), "second", "second_at"
    ).where("begin >= 0")
    alone = first.where("second IS NULL").select("doc", "mark", "w", "begin", F.lit(True).alias("phrase"))
    # Places are met in cells of 2 slop + 1 words: a place and its surroundings touch two at most.
    cell = 2 * slop + 1
    due = first.where("second IS NOT NULL").withColumn("due", F.col("begin") + F.col("second_at"))
    due = due.withColumn(
        "cell", F.explode(F.array_distinct(F.array(F.floor((F.col("due") - slop) / cell), F.floor((F.col("due") + slop) / cell))))
    )
    place = index.select("doc", "mark", F.col("term").alias("second"), "place", F.floor(F.col("place") / cell).alias("cell"))
    met = (
        due.join(place, ["doc", "mark", "second", "cell"])
        .where(F.abs(F.col("place") - F.col("due")) <= slop)
        .groupBy("doc", "mark", "w", "begin")
        .agg(F.max(F.col("place") == F.col("due")).alias("phrase"))
    )
    candidates = met.unionAll(alone).join(windows, "w").groupBy("doc", "mark").agg(
        F.collect_list(F.when(F.col("phrase"), F.struct("begin", "terms", "items"))).alias("phrases"),
        F.collect_set(F.when(~F.col("phrase"), F.col("w"))).alias("near"),
    )
    candidates = scratch.keep(lengths.join(candidates, ["doc", "mark"], "left"), "candidates")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *who)
    joined = rows.join(candidates, ["doc", "mark"], "left").select(
        "row", "phrases", "near", "n_words",
        # Only documents with a candidate are cut into words once more.
        F.when(F.size("phrases") > 0, words_of(F.col("row").getField(text_column))).alias("words"),
    )
    true = F.filter("phrases", lambda c: F.slice(F.col("words"), c["begin"] + 1, F.size(c["terms"])) == c["terms"])
    judged = joined.select("row", F.col("n_words").cast("long").alias("n_words"), "near", true.alias("true"))
    spans = F.array_sort(
        F.array_distinct(F.transform("true", lambda c: F.struct(c["begin"].alias("begin"), (c["begin"] + F.size(c["terms"])).alias("end"))))
    )
    none = F.array().cast("array<struct<begin:int,end:int>>")
    listed = judged.select(
        "row", "n_words", "near", F.coalesce(spans, none).alias("hits"),
        F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("true", lambda c: c["items"])))), F.array().cast("array<string>")).alias("items"),
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda so, s: F.struct(
            (so["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["begin"], so["upto"]))).alias("n"),
            F.greatest(so["upto"], s["end"]).alias("upto"),
        ),
        lambda so: so["n"],
    )
    return listed.select(
        "row", "n_words", covered.cast("long").alias("n_hit"), "hits", "items", F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near")
    )
