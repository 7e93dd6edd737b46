"""Blocks of vectors meet in the tasks that read them, and all their links are found."""

import numpy as np
import pyarrow as pa
import pytest

from marketlens.llm import embedding_dedup, scratch


def made(sizes, width, seed):
    """Labels and vectors: a third near copies of others, a group of near copies, some equal."""
    r = np.random.default_rng(seed)
    label = np.repeat([f"l{k}" for k in range(len(sizes))], sizes)
    v = r.standard_normal((len(label), width))
    for k in range(0, len(label) - 1, 3):
        v[k] = v[k + 1] + r.standard_normal(width) * r.uniform(0.05, 0.5)
    v[:60] = v[0] + r.standard_normal((60, width)) * 0.02
    v[100:110] = v[100]
    return label, v.astype(np.float32)


def plain(label, v, cosine):
    """Links and smallest index reached of each row, from all pairs."""
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= cosine) & (label[:, None] == label)
    np.fill_diagonal(near, True)
    least = np.arange(len(u))
    while not np.array_equal(least, lower := np.where(near, least, len(u)).min(1)):
        least = lower
    return near.sum(1) - 1, least


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_blocks_meet_without_a_shuffle(spark, monkeypatch, kind):
    plans = {}
    keep = scratch.Scratch.keep

    def seen(self, df, name, *args, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return keep(self, df, name, *args, **options)

    monkeypatch.setattr(scratch.Scratch, "keep", seen)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    label, v = made([700, 400, 90, *[3] * 100, 130, 1], 12, 4)
    order = np.random.default_rng(5).permutation(len(v))
    rows = [(int(k), v[k].tolist(), str(label[k])) for k in order]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label string").repartition(5)
    found = sorted(embedding_dedup.near_duplicate_vectors(df).collect())
    links, least = plain(label, v, embedding_dedup.COSINE)
    assert links.sum() > 4_000 and len(set(least)) < 0.8 * len(v)
    assert [tuple(row) for row in found] == [(k, links[k], least[k], k == least[k]) for k in range(len(v))]
    join = [plan for name, plan in plans.items() if name.startswith("found")]
    assert join and not any("Exchange" in plan for plan in join)  # a shuffle there grows with the pairs of blocks


@pytest.mark.parametrize("width, cosine", [(3, 0.99), (24, 0.93), (64, 0.5)])
def test_runs_longer_than_a_leaf(width, cosine):
    _, v = made([3 * embedding_dedup.LEAF + 7, 40], width, 6)
    u = embedding_dedup._unit(v.astype(np.float64))
    directions = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, : max(1, width // 2)].copy()
    order = np.lexsort(np.floor((u @ directions)[:, ::-1].T))
    count, starts = np.arange(len(v)), np.array([0, 900], np.int32)
    row = {
        "block": 1, "labels": ["a", "b"], "starts": starts.tobytes(), "class": count.tobytes(), "copies": (count + 1).tobytes(), "vectors": v[order].tobytes(),
    }
    a = embedding_dedup.Sequence({name: pa.scalar(value) for name, value in row.items()}, "", width, "float32", directions)
    assert a.runs == {"a": (0, 900), "b": (900, len(v))}
    eps, close = float(np.sqrt(2 - 2 * cosine)), u[order] @ u[order].T >= cosine
    for run, other in (((0, len(v)), (0, len(v))), ((0, 900), (900, len(v))), ((900, len(v)), (900, len(v)))):
        pairs = [pair for x, y in embedding_dedup.close_pairs(a, a, run, other, eps, cosine) for pair in zip(x.tolist(), y.tolist())]
        want = {(x, y) for x, y in zip(*np.nonzero(close)) if run[0] <= x < run[1] and other[0] <= y < other[1] and (x < y or run != other)}
        assert len(pairs) == len(set(pairs)) and set(pairs) == want and want


def test_links_of_a_task_are_added_up():
    class Block:
        def __init__(self, block, classes, copies):
            self.block, self.classes, self.copies = block, np.array(classes), np.array(copies)

    a, b, found = Block(7, [70, 71, 72], [1, 2, 3]), Block(4, [40, 41], [5, 6]), embedding_dedup.Links()
    found.add(a, a, np.array([0]), np.array([2]))
    found.add(a, b, np.array([2, 0]), np.array([1, 1]))
    found.add(b, a, np.array([0]), np.array([1]))
    rows = [tuple(row.values()) for batch in found.batches(2) for row in batch.to_pylist()]
    assert sorted(r[:2] for r in rows if r[2] is None) == [(40, 2), (41, 4), (70, 9), (71, 5), (72, 7)]
    assert sorted((c, to) for c, n, to in rows if to is not None) == [(40, 71), (41, 70), (72, 70)] and all(n == 0 for _, n, to in rows if to is not None)
