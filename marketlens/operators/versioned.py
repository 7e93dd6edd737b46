"""Parquet tables that change by version.

A table is a folder of immutable Parquet folders and one small manifest per version that lists
those which count. Every change writes new folders first and then one manifest, put in place by a
rename that fails when another writer was faster. So a reader sees one version from its first file
to its last, a write that dies leaves the old version, and repeating it is safe.

Rows are dealt to pieces by the leading bits of a hash of their key. A table starts with one piece;
when its pieces hold more than `piece_rows` rows on average, new rows use one more bit. Older
pieces stay where they are, as ancestors of the new ones, until they are next rewritten. A change
reads the pieces its keys fall into and no others.

Appended rows are `base` folders. Replaced rows are `delta` folders of whole rows, newer than all
before them: a reader takes the newest row of a key. `compact` rewrites pieces with many deltas.

The driver handles folder names and row counts only, some bytes for each piece of a million rows.
"""

import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketlens.operators.rows import first_per_key

PIECE_ROWS = 1_000_000
#: Runs whose outcome a table remembers; a run is repeated soon after it failed, if at all.
KEPT_RUNS = 1_000
#: Keys up to this size are sent to every task of a look-up.
BROADCAST_BYTES = 8 << 20
PIECE, NEWER = "__piece", "__version"


class ChangedMeanwhile(RuntimeError):
    """Another writer made the version this one wanted to make."""


class _Files:
    """Small files and folder names of a store that Spark reads, through Spark's own access to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> None:
        """Write a file whole under a name that nobody has taken."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        none = self.jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            context.rename(self.fs.makeQualified(draft), self.fs.makeQualified(self.path(name)), none)
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise ChangedMeanwhile(name) from error
            raise

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def piece_of(key: Column, depth: int) -> Column:
    """Name of the piece at a depth: the leading bits of the key's hash."""
    if depth == 0:
        return F.lit("p")
    return F.concat(F.lit("p"), F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64(key), 64 - depth)), depth, "0"))


def families(names: Iterable[str]) -> dict[str, list[str]]:
    """Pieces by their outermost ancestor."""
    out: dict[str, list[str]] = {}
    for name in sorted(names):
        root = next((r for r in (name[:n] for n in range(1, len(name) + 1)) if r in out), name)
        out.setdefault(root, []).append(name)
    return out


class VersionedTable:
    """A stored table with a key, or with `place` for pieces named by a column's value instead."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | None = None, key: str = "job_id",
        piece_rows: int = PIECE_ROWS, place: Column | None = None,
    ):
        self.spark, self.path, self.key, self.piece_rows = spark, path.rstrip("/"), key, piece_rows
        self.files, self.place, self._schema = _Files(spark, self.path), place, schema

    # -- versions

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names("versions") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> dict:
        """What a version consists of; the newest one by default."""
        known = self.versions()
        if version == 0 or version is None and not known:
            return {"version": 0, "depth": 0, "pieces": {}, "facts": {}, "runs": {}, "schema": None}
        return json.loads(self.files.text(f"versions/{version or known[-1]:012d}.json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def schema(self, manifest: dict) -> T.StructType:
        stored = manifest["schema"]
        return self._schema or (T.StructType.fromJson(stored) if stored else T.StructType([]))

    def _commit(self, before: dict, pieces: dict, schema: T.StructType, facts: dict | None = None, run: tuple | None = None) -> dict:
        rows = sum(n for p in pieces.values() for n in p["base"].values())
        depth = before["depth"]
        while self.place is None and rows / 2**depth > self.piece_rows:
            depth += 1
        runs = {**before["runs"], **({run[0]: run[1]} if run else {})}
        after = {
            "version": before["version"] + 1, "depth": depth, "pieces": pieces, "schema": schema.jsonValue(),
            "facts": {**before["facts"], **(facts or {})}, "runs": dict(list(runs.items())[-KEPT_RUNS:]),
        }
        self.files.put_new(f"versions/{after['version']:012d}.json", json.dumps(after))
        return after

    # -- reading

    def _folders(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/{folder}" for folder in folders]
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _rows(self, pieces: dict, schema: T.StructType) -> DataFrame:
        """The newest row of every key of some pieces."""
        base = self._folders([f"{w}/{PIECE}={name}" for name, p in pieces.items() for w in p["base"]], schema)
        deltas = [f"{w}/{PIECE}={name}" for name, p in pieces.items() for w in p["delta"]]
        if not deltas:
            return base
        changed = self._folders(deltas, T.StructType([*schema.fields, T.StructField(NEWER, T.LongType())]))
        newest = first_per_key(changed, [self.key], [F.col(NEWER).desc()]).drop(NEWER)
        # The changed keys are few between two compactions; Spark broadcasts them by their size.
        kept = base.join(changed.select(self.key).distinct(), self.key, "left_anti").select(*schema.names)
        return kept.unionByName(newest.select(*schema.names))

    def read(self, version: int | None = None, pieces: Callable[[str], bool] = lambda name: True) -> DataFrame:
        """All rows of a version, or those in the pieces whose names are chosen."""
        manifest = self.manifest(version)
        return self._rows({name: p for name, p in manifest["pieces"].items() if pieces(name)}, self.schema(manifest))

    def _touched(self, manifest: dict, keys: DataFrame) -> tuple[dict, int]:
        """The pieces that may hold some keys, and the keys' size; a row per piece, however many keys."""
        size = F.sum(F.octet_length(F.col(self.key)) + F.lit(16))
        place = piece_of(F.col(self.key), manifest["depth"])
        found = {r[0]: r[1] or 0 for r in keys.select(self.key, place.alias(PIECE)).groupBy(PIECE).agg(size).collect()}
        known = {name[:n] for name in found for n in range(1, len(name) + 1)}
        return {name: p for name, p in manifest["pieces"].items() if name in known}, sum(found.values())

    def lookup(self, keys: DataFrame, columns: list[str] | None = None) -> DataFrame:
        """Stored rows of the given keys, from the pieces the keys fall into.

        Keys of some megabytes at most are broadcast, so that the stored side is not shuffled; how
        large they are is counted with the pieces they fall into. More keys meet the stored ones in
        a shuffle of the asked-for columns.
        """
        manifest = self.manifest()
        schema = self.schema(manifest)
        pieces, size = self._touched(manifest, keys)
        rows = self._rows(pieces, schema).select(*(columns or schema.names))
        wanted = keys.select(self.key).distinct()
        return rows.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, self.key, "left_semi")

    def stored_keys(self, keys: DataFrame) -> DataFrame:
        """Stored keys, among them all that are in `keys`, to leave those out by.

        A few asked-for keys are broadcast as in a look-up. For many, the keys of the pieces they
        fall into come as they are: who joins by key anyway needs no other join before.
        """
        manifest = self.manifest()
        if not manifest["pieces"]:
            return self.spark.createDataFrame([], T.StructType([keys.schema[self.key]]))
        pieces, size = self._touched(manifest, keys)
        rows = self._rows(pieces, self.schema(manifest)).select(self.key)
        return rows.join(F.broadcast(keys.select(self.key).distinct()), self.key, "left_semi") if size <= BROADCAST_BYTES else rows

    def changed_since(self, version: int, until: int | None = None) -> DataFrame:
        """Rows, as they are `until` a version or now, of folders that `version` did not list.

        Rewritten pieces count as changed; a version that is gone makes all rows changed.
        """
        now = self.manifest(until)
        schema = self.schema(now)
        old = self.manifest(version)["pieces"] if version in self.versions() else {}
        fresh = {}
        for name, p in now["pieces"].items():
            known = {w for kind in ("base", "delta") for w in old.get(name, {}).get(kind, {})}
            part = {kind: {w: n for w, n in p[kind].items() if w not in known} for kind in ("base", "delta")}
            if part["base"] or part["delta"]:
                fresh[name] = part
        return self._rows(fresh, schema)

    # -- writing

    def _write(self, rows: DataFrame, depth: int, order: list[str]) -> tuple[str, dict[str, int]]:
        """Write rows by piece; the new folder, and the rows of each piece."""
        name = uuid.uuid4().hex
        place = piece_of(F.col(self.key), depth) if self.place is None else self.place
        placed = rows.withColumn(PIECE, place)
        if self.place is not None or depth > 0:  # a single piece needs no dealing
            placed = placed.hint("rebalance", PIECE)
        if order:
            placed = placed.sortWithinPartitions(PIECE, *order)
        placed.write.partitionBy(PIECE).parquet(f"{self.path}/data/{name}")
        # Counting reads the files' footers only.
        counted = self.spark.read.schema(T.StructType([T.StructField(PIECE, T.StringType())])).parquet(f"{self.path}/data/{name}")
        return name, {r[PIECE]: r["n"] for r in counted.groupBy(PIECE).agg(F.count(F.lit(1)).alias("n")).collect()}

    @staticmethod
    def _with(pieces: dict, kind: str, folder: str, counts: dict[str, int]) -> dict:
        out = {name: {k: dict(v) for k, v in p.items()} for name, p in pieces.items()}
        for name, n in counts.items():
            out.setdefault(name, {"base": {}, "delta": {}})[kind][folder] = n
        return out

    def append(
        self, rows: DataFrame, run: str | None = None, facts: dict | None = None, order: list[str] = (), expected_rows: int = 0,
    ) -> int:
        """Add rows whose keys are not stored; their number. A run that is known adds nothing.

        `expected_rows` gives the first write of a large table its pieces.
        """
        before = self.manifest()
        if run is not None and run in before["runs"]:
            return before["runs"][run]
        schema, depth = rows.schema, before["depth"]
        while self.place is None and expected_rows / 2**depth > self.piece_rows:
            depth += 1
        folder, counts = self._write(rows, depth, list(order))
        total = sum(counts.values())
        pieces = self._with(before["pieces"], "base", folder, counts)
        self._commit({**before, "depth": depth}, pieces, self._schema or schema, facts, (run, total) if run is not None else None)
        return total

    def replace_rows(self, rows: DataFrame, facts: dict | None = None) -> int:
        """Put whole rows in the place of those with the same keys, or add them; their number.

        Keys must be distinct. Nothing stored is rewritten: the rows are a delta.
        """
        before = self.manifest()
        newer = rows.withColumn(NEWER, F.lit(before["version"] + 1).cast("long"))
        folder, counts = self._write(newer, before["depth"], [self.key])
        if not counts:
            return 0
        self._commit(before, self._with(before["pieces"], "delta", folder, counts), self._schema or rows.schema, facts)
        return sum(counts.values())

    def replace_pieces(self, rows: DataFrame, names: Iterable[str], facts: dict | None = None, order: list[str] = ()) -> dict:
        """Put `rows` in the place of the named pieces; the others keep their files."""
        before, gone = self.manifest(), set(names)
        folder, counts = self._write(rows, before["depth"], list(order))
        pieces = self._with({n: p for n, p in before["pieces"].items() if n not in gone}, "base", folder, counts)
        return self._commit(before, pieces, self._schema or rows.schema, facts)

    def record(self, facts: dict) -> None:
        """A version with the same rows and other facts."""
        before = self.manifest()
        self._commit(before, before["pieces"], self.schema(before), facts)

    def compact(self, share: float = 0.1, folders: int = 16, order: list[str] = ()) -> list[str]:
        """Rewrite pieces with deltas beyond a share of their rows, with many folders, or too large.

        Large pieces are split to the present depth. Returns the names of the rewritten pieces.
        """
        manifest = self.manifest()
        pieces, due = manifest["pieces"], []
        for root, names in families(pieces).items():
            base = sum(n for name in names for n in pieces[name]["base"].values())
            delta = sum(n for name in names for n in pieces[name]["delta"].values())
            count = max(len(pieces[name]["base"]) for name in names)
            split = len(root) - 1 < manifest["depth"] and base > self.piece_rows
            if (delta and delta > share * base) or count > folders or split:
                due += names
        if due:
            rows = self._rows({name: pieces[name] for name in due}, self.schema(manifest))
            self.replace_pieces(rows, due, order=order)
        return due

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions before the last `keep`, and folders that no kept version lists.

        Readers of removed versions, and writers that are not done, lose their files: run it alone.
        """
        known = self.versions()
        for version in known[:-keep]:
            self.files.remove(f"versions/{version:012d}.json")
        listed = {w for v in known[-keep:] for p in self.manifest(v)["pieces"].values() for kind in ("base", "delta") for w in p[kind]}
        gone = [name for name in self.files.names("data") if name not in listed]
        for name in gone:
            self.files.remove(f"data/{name}")
        return gone
