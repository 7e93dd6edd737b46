"""Centroid clustering of integer vectors by scalar lookup tables.

Components are turned into integers, so few values occur in a dimension. A block of vectors keeps
the values that occur in each dimension and, per vector, the number of its value. A round tabulates
the squared difference of each occurring value and each centroid; a vector's distances are then the
sum of one table row per dimension. All arithmetic is exact.

Blocks are written once. A round is one pass over them: each task adds up its vectors by cluster,
Spark adds up the tasks, and the driver gets one row per cluster. Nothing else leaves the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch

BLOCK_ROWS = 4096
#: Beyond it the squared distance of 64 components may not fit into a long.
MOST = 1 << 27

BLOCK = "ids binary, valid binary, sizes binary, values binary, codes binary"
FIELDS = pa.schema([(name, pa.binary()) for name in ("ids", "valid", "sizes", "values", "codes")])


def usable(vector: Column, dimensions: int, scale: int) -> Column:
    """The vector has all its components, and each is a finite number that fits."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(MOST // scale))
    return F.coalesce((F.size(vector) == dimensions) & F.forall(vector, number), F.lit(False))


def integers(docs: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """vec_id and the integers floor(scale * x) of the usable vectors."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector"), dimensions, scale))
    return rows.select("vec_id", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale)))).alias("vector"))


def _blocks(batches, dimensions: int, rows: int):
    """Rows to blocks: ids, and per dimension the occurring values and each vector's value number."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            piece = batch.slice(begin, rows)
            ids = piece.column("vec_id")
            matrix = pc.list_flatten(piece.column("vector")).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            found = [np.unique(matrix[:, d], return_inverse=True) for d in range(dimensions)]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in (
                pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).tobytes(), ids.is_valid().to_numpy(zero_copy_only=False).tobytes(),
                np.array([len(values) for values, _ in found], np.int32).tobytes(),
                np.concatenate([values for values, _ in found]).tobytes(),
                np.concatenate([codes.astype(np.uint16) for _, codes in found]).tobytes(),
            )], schema=FIELDS)


class Block:
    """Vectors of a block as value numbers, dimension by dimension."""

    def __init__(self, ids: bytes, valid: bytes, sizes: bytes, values: bytes, codes: bytes):
        self.ids, self.valid = np.frombuffer(ids, np.int64), np.frombuffer(valid, bool)
        sizes = np.frombuffer(sizes, np.int32)
        self.values = np.split(np.frombuffer(values, np.int64), np.cumsum(sizes)[:-1])
        self.codes = np.frombuffer(codes, np.uint16).reshape(len(sizes), -1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid, the smallest of equally near ones, and the squared distance."""
        reach = max(int(max(abs(v[0]), abs(v[-1]))) for v in self.values) + int(np.abs(centroids).max())
        # As narrow as the sums allow: gathers are bound by memory.
        kind = np.int32 if len(self.values) * reach**2 < 1 << 31 else np.int64
        total = np.zeros((len(self.ids), len(centroids)), kind)
        for values, codes, own in zip(self.values, self.codes, centroids.T):
            total += ((values[:, None] - own) ** 2).astype(kind)[codes]
        cluster = total.argmin(1)
        return cluster, total[np.arange(len(total)), cluster].astype(np.int64)

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums by cluster, from how often each value occurs in it."""
        out = np.zeros((k, len(self.values)), np.int64)
        for d, (values, codes) in enumerate(zip(self.values, self.codes)):
            uses = np.bincount(cluster * len(values) + codes, minlength=k * len(values))
            out[:, d] = uses.reshape(k, -1) @ values
        return out


def _read(batches) -> Iterator[Block]:
    for batch in batches:
        for row in zip(*(batch.column(name) for name in FIELDS.names)):
            yield Block(*(part.as_py() for part in row))


def _partial(batches, centroids: np.ndarray):
    """(cluster, n, sums) of a task's vectors."""
    k, dimensions = centroids.shape
    n, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
    for block in _read(batches):
        cluster, _ = block.nearest(centroids)
        n += np.bincount(cluster, minlength=k)
        sums += block.sums(cluster, k)
    used = np.flatnonzero(n)
    yield pa.RecordBatch.from_pydict({
        "cluster": pa.array(used, pa.int32()), "n": pa.array(n[used], pa.int64()), "sums": pa.array(sums[used].tolist(), pa.list_(pa.int64())),
    })


def _assigned(batches, centroids: np.ndarray):
    """vec_id, cluster and distance of every vector."""
    for block in _read(batches):
        cluster, distance = block.nearest(centroids)
        yield pa.RecordBatch.from_pydict({
            "vec_id": pa.array(block.ids, pa.int64(), mask=~block.valid), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance, pa.int64()),
        })


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: floor of the mean; one without vectors stays."""
    k, dimensions = centroids.shape
    parts = blocks.mapInArrow(lambda batches: _partial(batches, centroids), "cluster int, n long, sums array<long>")
    wide = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"d{d}") for d in range(dimensions)]
    out = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *wide).collect():  # a row per cluster
        out[row["cluster"]] = [int(row[f"d{d}"]) // row["n"] for d in range(dimensions)]
    return out


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dimensions: int = 64, scale: int = 256,
    id_column: str = "vec_id", vector_column: str = "embedding", block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """Clusters of the vectors after `rounds` rounds, and the final centroids (k, dimensions).

    The frame has vec_id, cluster, distance (squared), cluster_inertia, inertia: a row per usable
    vector. Vectors that are null, of another length, or with null, non-finite or huge (2^27 / scale
    and more, whose distances may not fit into a long) components are left out. The first centroids
    are the k vectors whose SHA-256 of "seed:vec_id" is smallest, null ids last, equal ids by their
    components; fewer vectors make fewer centroids. Repeated rows stay repeated and count as often.
    Without vectors there are no rows and no centroids. Other columns are ignored.
    """
    if not 0 < block_rows <= 1 << 16:
        raise ValueError("block_rows must be at most 65536")
    spark = vectors.sparkSession
    scratch = Scratch(spark, "centroids")
    numbers = integers(vectors, id_column, vector_column, dimensions, scale)
    blocks = scratch.keep(numbers.mapInArrow(lambda batches: _blocks(batches, dimensions, block_rows), BLOCK), "blocks")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = numbers.withColumn("key", key).orderBy(F.col("key").asc_nulls_last(), "vector").limit(k)
    centroids = np.array([row["vector"] for row in first.select("vector").collect()], np.int64).reshape(-1, dimensions)
    if not len(centroids):
        empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long"
        return spark.createDataFrame([], empty), centroids
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    found = blocks.mapInArrow(lambda batches: _assigned(batches, centroids), "vec_id long, cluster int, distance long")
    found = scratch.keep(found, "found")
    sums = {row["cluster"]: row["s"] for row in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # a row per cluster
    own = spark.createDataFrame(sorted(sums.items()), "cluster int, cluster_inertia long")
    # Broadcast: one row per centroid.
    return found.join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(sums.values())).cast("long").alias("inertia")), centroids


def clusters_with_digests(vectors: DataFrame, **options) -> DataFrame:
    """`cluster_vectors` with the hash of each vector's final centroid."""
    found, centroids = cluster_vectors(vectors, **options)
    if not len(centroids):
        return found.withColumn("centroid_sha256", F.lit("").cast("string"))
    names = F.array(*[F.lit(centroid_digest(c)) for c in centroids])
    return found.withColumn("centroid_sha256", names[F.col("cluster")])
