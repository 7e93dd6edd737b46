"""Line de-duplication by levelled sorted runs of line hashes.

A store of runs grows batch by batch, as a log-structured merge tree does: each batch of documents
adds one run, a table of (line hash, documents having it, first document) hashed into buckets and
sorted by hash; when a level has `fanout` runs they are merged into one run of the next level, so a
key is rewritten once per level. Documents are then joined with the runs by merge, on hashes alone.

Only DataFrame functions are used: no Python runs on the executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch

# ASCII white space that is stripped, and the letters that are folded.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_DOCUMENTS = 10
MIN_CODE_POINTS = 1
BATCHES = 4
FANOUT = 2


def folded(text: Column) -> Column:
    """A-Z in lower case, all else as it is. lower() does just that where all bytes are ASCII."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def line_key(line: Column) -> Column:
    return folded(F.btrim(line, F.lit(BLANKS)))


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(line: Column, min_chars: int) -> Column:
    """128 bits of the key, null for keys that are too short."""
    key = line_key(line)
    digest = F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return F.when(F.char_length(key) >= min_chars, digest)


class LineRuns:
    """Runs of line hashes in levels, one bucketed and sorted table each.

    Columns of a run: h1, h2 (128-bit key), n_docs (documents in the run having the key), first
    (smallest document id among them, null ids last). All runs have the same buckets, so merging
    them and joining with them needs no further shuffle of a run.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            run.repartition(self.buckets, "h1", "h2")
            .write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            .option("path", f"{self.folder}/{name}").option("compression", "zstd")
            .saveAsTable(name)
        )
        return name

    def add(self, keys: DataFrame) -> None:
        """Add one batch: `keys` has a row (h1, h2, first) per document and distinct key."""
        run = keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"))
        self._place(self._write(run), 0)

    def _place(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(full))
            self._drop(full)
            self._place(merged, level + 1)

    def _merged(self, names: Iterable[str]) -> DataFrame:
        """Some runs as one: outer joins of sorted buckets, a key at most once on either side."""
        tables = [self.spark.table(name) for name in names]
        merged = tables[0]
        for more in tables[1:]:
            more = more.withColumnsRenamed({"n_docs": "more_docs", "first": "more_first"})
            merged = merged.join(more.hint("merge"), ["h1", "h2"], "full_outer").select(
                "h1", "h2",
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("more_docs", F.lit(0))).alias("n_docs"),
                F.least("first", "more_first").alias("first"),
            )
        return merged

    def compact(self) -> DataFrame:
        """All levels as one run."""
        names = [name for level in self.levels for name in level]
        if len(names) > 1:
            merged = self._write(self._merged(names))
            self._drop(names)
            names = [merged]
        self.levels = [names]
        return self.spark.table(names[0])

    def _drop(self, names: Iterable[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name} PURGE")

    def unseen(self, lines: DataFrame) -> DataFrame:
        """Lines whose key no run has."""
        for name in [name for level in self.levels for name in level]:
            lines = lines.join(self.spark.table(name).hint("merge"), ["h1", "h2"], "left_anti")
        return lines

    def close(self) -> None:
        self._drop(name for level in self.levels for name in level)
        self.levels = []


def drop_repeated_lines(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CODE_POINTS,
    keep_first: bool = False,
    batches: int = BATCHES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Drop lines whose key at least `min_documents` documents have.

    A key is the line stripped of ASCII white space, A-Z in lower case; keys of fewer than
    `min_chars` code points never count. With `keep_first` the document with the smallest id keeps
    its lines. Returns all columns of `docs` with the text replaced, and n_lines, n_dropped (columns
    of these names in `docs` are replaced).

    Null and empty texts are one empty line and come back as ''. A null text with nothing dropped
    is '' too. Each row counts as one document, rows with equal id and text included: they get
    equal results. Null ids are kept and come last in the order of ids. No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lines")
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    whole = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    text = F.col(f"`{text_column}`")
    mark = F.xxhash64(F.coalesce(text, F.lit("")))
    keyed = docs.select(
        F.col(f"`{id_column}`").alias("first"),
        mark.alias("mark"),
        F.pmod(F.xxhash64(F.col(f"`{id_column}`"), mark), F.lit(batches)).cast("int").alias("batch"),
        F.transform(lines_of(text), lambda line: line_hash(line, min_chars)).alias("keys"),
    )
    keyed = scratch.keep(keyed, "keyed", "batch")
    runs = LineRuns(spark, scratch.path("runs"))
    for batch in range(batches):
        part = keyed.where(F.col("batch") == batch)
        runs.add(
            part.select("first", F.explode(F.array_distinct("keys")).alias("key"))
            .where("key IS NOT NULL")
            .select("key.h1", "key.h2", F.struct(F.col("first").isNull().alias("none"), F.col("first").alias("id")).alias("first"))
        )
    repeated = runs.compact().where(F.col("n_docs") >= min_documents).select("h1", "h2", F.col("first.id").alias("kept"))
    hits = (
        keyed.select("first", "mark", F.posexplode("keys").alias("line", "key"))
        .select("first", "mark", "line", "key.h1", "key.h2")
        .join(repeated.hint("merge"), ["h1", "h2"])
    )
    if keep_first:
        hits = hits.where(~F.col("first").eqNullSafe(F.col("kept")))
    dropped = hits.groupBy("first", "mark").agg(F.collect_set("line").alias("dropped"))
    dropped = scratch.keep(dropped, "dropped")
    runs.close()
    scratch.drop("keyed")
    rows = docs.select(whole, F.col(f"`{id_column}`").alias("id"), mark.alias("mark"))
    joined = rows.join(dropped.hint("merge"), rows["id"].eqNullSafe(dropped["first"]) & (rows["mark"] == dropped["mark"]), "left")
    lines = lines_of(F.col("row").getField(text_column))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("dropped", F.array().cast("array<int>")))
    kept_text = F.when(F.col("dropped").isNull(), F.coalesce(F.col("row").getField(text_column), F.lit(""))).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    )
    return joined.select("row", "dropped", lines.alias("lines")).select(
        *[(kept_text.alias(c) if c == text_column else F.col("row").getField(c).alias(c)) for c in others],
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )
