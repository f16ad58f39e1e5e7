"""Connected components by alternating large-star and small-star steps, all on executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks.llm.common import Scratch, lean

#: Edges that a task joins up at a time.
HELD = 500_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that join what the task's own edges join, with each node tied to the least one that these reach."""

    def joined(edges: np.ndarray) -> pa.RecordBatch:
        nodes, at = np.unique(edges, return_inverse=True)
        up = np.arange(len(nodes))
        a, b = at.reshape(edges.shape)
        while True:  # each node to the least of its neighbours' roots, then to its root's root
            x, y = up[a], up[b]
            least = np.minimum(x, y)
            new = up.copy()
            np.minimum.at(new, x, least)
            np.minimum.at(new, y, least)
            new = new[new]
            if (new == up).all():
                break
            up = new
        tied = up != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[tied]), pa.array(nodes[up[tied]])], names=["u", "v"])

    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)]))
        if sum(x.shape[1] for x in held) >= HELD:
            yield joined(np.concatenate(held, axis=1))
            held = []
    if held:
        yield joined(np.concatenate(held, axis=1))


def _stars(edges: DataFrame, large: bool, scratch: Scratch, name: str) -> DataFrame:
    """One step on edges (u, v): each node's greater (large) or lesser (small) neighbours are tied to its least one.

    The least neighbours are a table of their own, so that both sides of the join come straight from an exchange and Spark can split the
    partition of a node with very many neighbours.
    """
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    sides = edges.union(back)
    if not large:
        sides = sides.where("v < u")
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    least = scratch.write(least, f"least-{name}")
    tied = sides.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is the least node reachable. Edges are (u, v), both long.

    Tasks first join up what they hold, so that fewer and shorter chains are left. Each round is written to the shared folder; rounds grow with the logarithm of the longest chain.
    """
    at = scratch.write(edges.select("u", "v").where("u <> v").mapInArrow(lean(_forest), "u long, v long").distinct(), "edges0")
    k = 0
    while True:
        k += 1
        big = scratch.write(_stars(at, True, scratch, f"large{k}"), f"large{k}")
        at = scratch.write(_stars(big, False, scratch, f"edges{k}"), f"edges{k}")
        scratch.drop(f"large{k}", f"edges{k - 1}", f"least-large{k}", f"least-edges{k}")
        # Edges lead to lesser nodes. All trees are stars once no node has two edges, or one edge and another node's.
        ends = at.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(at.select("v", F.lit(0), F.lit(1)))
        deep = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out = 1 and into = 1")
        if deep.isEmpty():
            break
    return at.select(F.col("u").alias("node"), F.col("v").alias("root")).union(at.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
