"""Connected components of links that stay distributed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, store

#: Links that one task settles by itself, at most; more are settled by rounds over all tasks.
SETTLED = 1 << 18


def _settled(batches):
    """``node``, ``component`` of all nodes of a partition's links."""
    links = [np.stack([np.asarray(b.column(c)) for c in ("a", "b")]) for b in batches if b.num_rows]
    if not links:
        return
    nodes, at = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    parent = list(range(len(nodes)))
    for x, y in at.reshape(2, -1).T.tolist():
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        # nodes are in order, so a root is the smallest of its tree
        parent[max(x, y)] = min(x, y)
    for i, up in enumerate(parent):
        parent[i] = parent[up]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[parent])], ["node", "component"])


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger end first; loops go."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    out = both.join(low, both.a == low.u).where(F.col("b") > F.col("u"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    out = edges.join(low, edges.a == low.u).select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
    return _oriented(out)


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for each node of edges (``a``, ``b`` long).

    Up to SETTLED links, by their exact count, are settled by one task: rounds
    over a small graph cost their number of tasks, not its links.  More are settled by
    alternating the large-star and small-star steps of Kiveris et al. until the
    edges stop changing; they are then (node, root).  Each round is a written
    table, nothing but a count and a checksum reaches the driver, and a node with many
    links costs a partially aggregated minimum and a join that can be split.
    Nodes without links have no row.
    """
    links = store(edges.where("a <> b").select("a", "b"), f"{label}-e")
    if links.count() <= SETTLED:
        out = store(links.repartition(1).mapInArrow(_settled, "node long, component long"), f"{label}-e")
        drop(links)
        return out
    now = store(_oriented(links), f"{label}-e")
    drop(links)
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        after = store(_small_star(_large_star(now)), f"{label}-e")
        drop(now)
        now = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
