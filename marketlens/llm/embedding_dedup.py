"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine c or more are at most eps = sqrt(2 - 2 c) apart, and so are their
projections on any orthonormal directions. Vectors are sorted by label and by the cells, eps wide,
of their projections on the leading principal directions; a run of the sorted sequence is a block.
Blocks without a common label, or whose bounds are more than eps apart in some direction, are
skipped; the others are joined by splitting them into intervals, again and again, skipping distant
ones. What is left is compared as a matrix product of the leading principal coordinates and the
length of the rest, whose product bounds the cosine from above; cosines that may be large enough are
computed from the whole vectors in double precision.

Blocks meet where they lie: a task reads two groups of blocks from the shared folder, so that no
vector is shuffled for a pair, and adds up what it finds, so that it writes each vector once at most.
Disk grows with the vectors and with what is linked, not with the pairs of blocks.

Equal vectors of one label are one class, so a vector that a third of all rows repeat is compared
once. The directions need one pass of sums over all vectors, whose size does not depend on the rows.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from marketlens.llm.components import connected
from marketlens.llm.scratch import Scratch

COSINE = 0.93
DIRECTIONS = 6
#: Vectors of a block, fewer if they are long: a block has BLOCK_BYTES at most, or one vector.
BLOCK = 8192
BLOCK_BYTES = 2 << 20
#: A task joins two groups of blocks of this size or less.
GROUP_BYTES = 32 << 20
#: Arrow batches of pairs of blocks, which both sides hold in memory several times over.
PAIRS_BYTES = 16 << 20
LEAF = 512
#: Rounding: bounds are compared with this much to spare, cosines are not.
SLACK = 1e-6

BLOCKS = (
    "block long, first string, last string, labels array<string>, starts binary, class binary, copies binary, vectors binary, "
    "first_low array<double>, first_high array<double>, last_low array<double>, last_high array<double>"
)


def _matrix(column: pa.Array, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.float64)


def _packed(batches, kind: str):
    """Vectors that can link as their numbers (-0.0 as 0.0), None for others."""
    for batch in batches:
        lists, label = batch.column("embedding"), batch.column("label")
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)  # null parts are NaN
        ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)), dtype=np.int64)
        odd, some = (np.append(0, np.cumsum(mark))[ends] for mark in (~np.isfinite(values), values != 0))
        usable = label.is_valid().to_numpy(zero_copy_only=False) & (np.diff(odd) == 0) & (np.diff(some) > 0)
        offsets = (ends * values.itemsize).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), batch.num_rows, [pa.array(usable).buffers()[1], pa.py_buffer(offsets), pa.py_buffer(values)])
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), label, found], ["vec_id", "label", "vector"])


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaling by the largest part first keeps squares of extreme numbers finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _sums(batches, width: int, kind: str):
    """One row per entry of the moment matrix: its sum over the task's unit vectors."""
    total = np.zeros((width, width))
    for batch in batches:
        unit = _unit(_matrix(batch.column("vector"), width, kind)) if batch.num_rows else np.zeros((0, width))
        total += unit.T @ unit
    yield pa.RecordBatch.from_pydict({"entry": np.arange(width * width, dtype=np.int32), "sum": total.ravel()})


def _place(batches, width: int, kind: str, directions: np.ndarray, cell: float):
    for batch in batches:
        if batch.num_rows:
            at = np.floor(_unit(_matrix(batch.column("vector"), width, kind)) @ directions / cell).astype(np.int32)
            cells = pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), at.shape[1]).cast(pa.list_(pa.int32()))
            yield batch.append_column("cells", cells)


def _blocks(batches, width: int, kind: str, directions: np.ndarray, most: int):
    """Runs of the sorted rows as one row: vectors, where labels start, bounds of the first and the last label."""
    part, count, held, n = TaskContext.get().partitionId(), 0, [], 0

    def block():
        rows = pa.Table.from_batches(held).combine_chunks()
        label, at = rows.column("label").combine_chunks(), _unit(_matrix(rows.column("vector"), width, kind)) @ directions
        codes = label.dictionary_encode().indices.to_numpy()
        starts = np.append(0, np.flatnonzero(np.diff(codes)) + 1)
        labels, first, last = label.take(pa.array(starts)).to_pylist(), at[: starts[1] if len(starts) > 1 else None], at[starts[-1] :]
        numbers = lambda name: rows.column(name).to_numpy().astype(np.int64).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in (
            ((part << 32) + count, pa.int64()), (labels[0], pa.string()), (labels[-1], pa.string()), (labels, pa.list_(pa.string())),
            (starts.astype(np.int32).tobytes(), pa.binary()), (numbers("class"), pa.binary()), (numbers("copies"), pa.binary()),
            (b"".join(rows.column("vector").to_pylist()), pa.binary()),
            *((bound.tolist(), pa.list_(pa.float64())) for side in (first, last) for bound in (side.min(0), side.max(0))),
        )], [field.split()[0] for field in BLOCKS.split(", ")])

    for batch in batches:
        while batch.num_rows:
            held.append(batch.slice(0, most - n))
            batch, n = batch.slice(held[-1].num_rows), n + held[-1].num_rows
            if n == most:
                yield block()
                count, held, n = count + 1, [], 0
    if n:
        yield block()


class Sequence:
    """A block in memory: unit vectors, leading coordinates with the length of the rest, runs of labels."""

    def __init__(self, row: dict, end: str, width: int, kind: str, directions: np.ndarray):
        get = lambda name, kind: np.frombuffer(row[name + end].as_buffer(), kind)
        # Copies, so that a block that is kept does not keep its whole batch.
        self.block, self.classes, self.copies = row["block" + end].as_py(), get("class", np.int64).copy(), get("copies", np.int64).copy()
        self.unit = _unit(get("vectors", kind).reshape(-1, width).astype(np.float64))
        self.at = self.unit @ directions
        rest = np.sqrt(np.maximum(1 - (self.at * self.at).sum(axis=1, keepdims=True), 0))
        self.head = np.concatenate([self.at, rest], axis=1).astype(np.float32)
        self.at = np.ascontiguousarray(self.at[:, :DIRECTIONS].T)
        starts = get("starts", np.int32).tolist()
        self.runs = dict(zip(row["labels" + end].as_py(), zip(starts, [*starts[1:], len(self.classes)])))


def close_pairs(a: Sequence, b: Sequence, run: tuple, run_b: tuple, eps: float, cosine: float):
    """Index pairs of two runs with at least this cosine, by recursive interval splitting; a run meets itself with x < y."""
    same = a is b and run == run_b
    # Of single precision, four times what rounding may take away.
    enough = cosine - a.head.shape[1] * 2.0**-21
    todo = [(*run, *run_b)]
    while todo:
        i, j, k, m = todo.pop()
        if same and k < i:
            continue
        gap = np.maximum(a.at[:, i:j].min(1) - b.at[:, k:m].max(1), b.at[:, k:m].min(1) - a.at[:, i:j].max(1))
        if gap.max() > eps + SLACK:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            flat = np.flatnonzero(a.head[i:j] @ b.head[k:m].T >= enough)
            if 16 * len(flat) > (j - i) * (m - k):
                x, y = np.nonzero(a.unit[i:j] @ b.unit[k:m].T >= cosine)
                keep = x + i < y + k if same else slice(None)
                x, y = x[keep] + i, y[keep] + k
            elif len(flat):
                x, y = flat // (m - k) + i, flat % (m - k) + k
                if same:
                    x, y = x[x < y], y[x < y]
                keep = np.einsum("ij,ij->i", a.unit[x], b.unit[y]) >= cosine
                x, y = x[keep], y[keep]
            else:
                continue
            if len(x):
                yield x, y
            continue
        # Halves end at multiples of LEAF from the start, so that a sequence meets itself evenly.
        p = i + -(-(j - i) // (2 * LEAF)) * LEAF if j - i > LEAF else j
        q = k + -(-(m - k) // (2 * LEAF)) * LEAF if m - k > LEAF else m
        todo += [(s, t, u, v) for s, t in ((i, p), (p, j)) if s < t for u, v in ((k, q), (q, m)) if u < v]


class Links:
    """What a task has found: how many vectors each class is linked with, and the components."""

    def __init__(self):
        self.begin: dict[int, int] = {}
        self.classes, self.counts, self.root = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _at(self, sequence: Sequence) -> int:
        if sequence.block not in self.begin:
            n, more = len(self.classes), len(sequence.classes)
            self.begin[sequence.block] = n
            self.classes = np.append(self.classes, sequence.classes)
            self.counts = np.append(self.counts, np.zeros(more, np.int64))
            self.root = np.append(self.root, np.arange(n, n + more))
        return self.begin[sequence.block]

    def add(self, a: Sequence, b: Sequence, x: np.ndarray, y: np.ndarray) -> None:
        left, right = self._at(a) + x, self._at(b) + y
        np.add.at(self.counts, left, b.copies[y])
        np.add.at(self.counts, right, a.copies[x])
        while True:
            v, w = self.root[left], self.root[right]
            apart = v != w
            if not apart.any():
                return
            left, right, v, w = left[apart], right[apart], v[apart], w[apart]
            np.minimum.at(self.root, np.maximum(v, w), np.minimum(v, w))
            while not np.array_equal(self.root, above := self.root[self.root]):
                self.root = above

    def batches(self, rows: int = 1 << 16):
        """(class, links, None) of linked classes, and (class, 0, to) links that connect what all links connect."""
        counted, below = np.flatnonzero(self.counts), np.flatnonzero(self.root != np.arange(len(self.root)))
        for at in range(0, len(counted), rows):
            some = counted[at : at + rows]
            yield self._batch(self.classes[some], self.counts[some], pa.nulls(len(some), pa.int64()))
        for at in range(0, len(below), rows):
            some = below[at : at + rows]
            yield self._batch(self.classes[some], np.zeros(len(some), np.int64), pa.array(self.classes[self.root[some]]))

    @staticmethod
    def _batch(classes, links, to) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(classes), pa.array(links), to], ["class", "links", "to"])


def _join(batches, width: int, kind: str, directions: np.ndarray, eps: float, cosine: float):
    """Of all pairs of blocks of a task: the links of each class, and links that connect them."""
    found, a = Links(), None
    for batch in batches:
        for k in range(batch.num_rows):
            row = {name: batch.column(name)[k] for name in batch.schema.names}
            if a is None or a.block != row["block"].as_py():
                a = Sequence(row, "", width, kind, directions)
            b = a if row["block_b"].as_py() == a.block else Sequence(row, "_b", width, kind, directions)
            for label, run in a.runs.items():
                if label in b.runs:
                    for x, y in close_pairs(a, b, run, b.runs[label], eps, cosine):
                        found.add(a, b, x, y)
        batch = row = None  # goes before the next is read
    yield from found.batches()


@contextmanager
def _batch_bytes(spark: SparkSession, most: int):
    """Arrow batches have at most so many bytes, or one row."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _met(blocks: DataFrame, groups: int, eps: float) -> DataFrame:
    """The pairs of blocks that may have links, each once. Tasks read them where they lie: nothing is shuffled."""
    body = ["block", "labels", "starts", "class", "copies", "vectors"]
    # Coalescing merges pieces of the scan; the join then reads each group of one side for each of the other.
    x = blocks.coalesce(groups).alias("x")
    y = blocks.coalesce(groups).alias("y").hint("shuffle_replicate_nl")

    def near(left: str, right: str):
        # In the order by label, two blocks share the last label of one and the first of the other at most.
        p, q = (F.zip_with(f"{s}_low", f"{t}_high", lambda low, high: low - high) for s, t in (
            (f"{left}.last", f"{right}.first"), (f"{right}.first", f"{left}.last"),
        ))
        gap = F.array_max(F.zip_with(p, q, lambda u, v: F.greatest(u, v)))
        return (F.col(f"{left}.last") == F.col(f"{right}.first")) & (gap <= eps + SLACK)

    one, other = F.col("x.block"), F.col("y.block")
    # Of the two orders of a pair one is taken, by chance: tasks on both sides of the diagonal get as much.
    chosen = (one < other) == (F.xxhash64(F.least(one, other), F.greatest(one, other)) % 2 == 0)
    pairs = x.join(y, (one == other) | ((one != other) & chosen & (near("x", "y") | near("y", "x"))))
    return pairs.select(*[F.col(f"x.{name}") for name in body], *[F.col(f"y.{name}").alias(f"{name}_b") for name in body])


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    Rows link when their labels are equal and the cosine of their vectors, in double precision, is
    at least `cosine`. n_links counts the other rows linked directly, component_id is the smallest
    id that links reach, and a row is kept if that is its own. Null labels, vectors that are null,
    zero or hold null or non-finite components, and vectors of differing lengths link with nothing.
    Equal rows are linked with each other. Rows of equal id are apart. A null id is never the
    smallest. Other columns are ignored, no rows give no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be in (0, 1]")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    given = vectors.select(F.col(f"`{vector_column}`")).schema[0].dataType
    # Single precision is kept as it is; all computing is in double precision.
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    kind, size = ("float32", 4) if single else ("float64", 8)
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("string").alias("label"),
        F.col(f"`{vector_column}`").cast("array<float>" if single else "array<double>").alias("embedding"),
    )
    # Labels and lengths keep vectors apart, so both are in the class and in the order.
    key = F.when(F.col("vector").isNotNull(), F.xxhash64("label", "vector"))
    packed = rows.mapInArrow(lambda b: _packed(b, kind), "vec_id long, label string, vector binary").withColumn("class", key)
    packed = scratch.keep(packed, "packed")
    classes = packed.where("vector IS NOT NULL").groupBy("class", "label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = scratch.keep(classes.withColumn("width", (F.octet_length("vector") / size).cast("int")), "classes")
    # From here on a vector is in one table at a time.
    every = scratch.keep(packed.select("vec_id", "class"), "every")
    scratch.drop("packed")
    known = scratch.keep(classes.select("class", "copies", "least"), "known")
    eps = float(np.sqrt(2 - 2 * cosine))
    pairs_found = None
    for width, n in classes.groupBy("width").count().collect():  # as many as there are vector lengths
        own = classes.where(F.col("width") == width)
        sums = own.select("vector").mapInArrow(lambda b, w=width: _sums(b, w, kind), "entry int, sum double")
        moments = sums.groupBy("entry").agg(F.sum("sum").alias("sum")).toArrow()  # width squared rows
        matrix = np.zeros(width * width)
        matrix[moments.column("entry").to_numpy()] = moments.column("sum").to_numpy()
        spread, directions = (side[..., ::-1] for side in np.linalg.eigh(matrix.reshape(width, width)))
        # So many leading coordinates that the rest alone, on average, comes to two thirds of the cosine.
        heads = max(DIRECTIONS, 1 + int((1 - np.cumsum(spread) / n > 2 / 3 * cosine).sum()))
        heads, leading = directions[:, :heads].copy(), directions[:, :DIRECTIONS].copy()
        placed = own.select("class", "label", "vector", "copies").mapInArrow(
            lambda b, w=width, d=leading: _place(b, w, kind, d, max(eps, 1e-4)), "class long, label string, vector binary, copies long, cells array<int>"
        )
        most = max(1, min(BLOCK, BLOCK_BYTES // (size * width)))
        groups = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n * (size * width + 16) / GROUP_BYTES))
        groups = min(groups, math.ceil(n / most))
        ordered = placed.repartitionByRange(groups, "label", "cells", "class").sortWithinPartitions("label", "cells", "class").drop("cells")
        blocks = scratch.keep(ordered.mapInArrow(lambda b, w=width, d=leading, m=most: _blocks(b, w, kind, d, m), BLOCKS), f"blocks{width}")
        found = _met(blocks, groups, eps).mapInArrow(lambda b, w=width, d=heads: _join(b, w, kind, d, eps, cosine), "class long, links long, to long")
        with _batch_bytes(spark, PAIRS_BYTES):
            found = scratch.keep(found, f"found{width}")
        scratch.drop(f"blocks{width}")
        pairs_found = found if pairs_found is None else pairs_found.unionAll(found)
    scratch.drop("classes")
    if pairs_found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = pairs_found.groupBy("class").agg(F.sum("links").alias("others"))
    component = connected(pairs_found.where("to IS NOT NULL").select(F.col("class").alias("a"), F.col("to").alias("b")), scratch, "component")
    named = known.join(links, "class", "left").join(
        component.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("class", "component_id", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = every.join(named, "class").select("vec_id", "n_links", "component_id")
    odd = every.where("class IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(odd).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

