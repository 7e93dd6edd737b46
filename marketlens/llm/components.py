"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.scratch import Scratch

MAX_ROUNDS = 64


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for all ends of `edges` (a, b): the smallest node that can be reached.

    Alternating stars: every node hands its larger neighbours to its smallest neighbour, then its
    smaller ones, until only stars are left; some log(n) rounds of grouped minima. Minima are taken
    before the shuffle, and the join that follows splits a node with very many neighbours. Each
    round is a table in the shared folder; the table before it is removed. Loops and repeated edges
    are allowed. The ids must not be null. Edges that are stars already, and no edges, take no round:
    a round is some six shuffles, whose plans and task records the driver holds.
    """
    nodes = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    current = scratch.keep(nodes, f"{name}-0", release=False)
    for round_ in range(1, MAX_ROUNDS + 1):
        if _only_stars(current):
            break
        both = current.select("u", "v").unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(best, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(best.select("u", F.col("m").alias("v")))
            .distinct()
        )
        current = scratch.keep(small, f"{name}-{round_}", release=False)
        scratch.drop(f"{name}-{round_ - 1}")
    else:
        if not _only_stars(current):
            raise RuntimeError(f"no stars after {MAX_ROUNDS} rounds")
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())


def _only_stars(edges: DataFrame) -> bool:
    """Whether each larger end u has one smaller end v, which is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionAll(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    return counted.where("ups > 1 OR (ups > 0 AND down > 0)").isEmpty()
