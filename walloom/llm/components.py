"""Connected components of an edge table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges (a, b) and the smallest node that each one reaches."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _stars(batches, most: int = 1 << 20):
    """Edges of one task, reduced to (node, smallest node reached) in runs of a bounded number of rows."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        nodes, least = roots(a, b)
        far = nodes != least
        return pa.RecordBatch.from_pydict({"a": nodes[far], "b": least[far]})

    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(x[0]) for x in held) >= most:
            yield out()
    if held:
        yield out()


#: Edges that one task of a step takes, about. A step of few edges so leaves few files, however many partitions the session's shuffles have.
EDGES = 1 << 18


def fitted(df: DataFrame, rows: int, per: int = EDGES) -> DataFrame:
    """The rows in as few partitions as hold about `per` each; never in more than there are."""
    return df.coalesce(max(1, -(-rows // per)))


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b longs) -> (node, component): for each node of an edge, the smallest node it reaches.

    Each task first reduces its own edges to stars, and does so again where what is left is one task's work. Then large-star and small-star steps alternate until nothing
    changes: every node is moved to its least neighbour, so that chains shorten by a factor each time. Each step is
    an aggregate with map-side combine and a join that AQE can split when one node has very many neighbours. No edges give no rows; loops and repeated edges
    change nothing.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = checkpointed(edges.mapInArrow(_stars, "a long, b long"))
    rows, mark = edges.count(), None
    edges = fitted(edges, rows)
    if rows <= EDGES:  # all in one task: it may as well reduce what the tasks before it left
        edges = checkpointed(edges.mapInArrow(_stars, "a long, b long"))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("n")).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = checkpointed(fitted(small.where("a <> b").distinct(), rows))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
