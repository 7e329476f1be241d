"""Connected components of link tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", small: int = 0) -> DataFrame:
    """node, component (the smallest node reachable) of every node of the undirected edges.

    Alternating star contraction: the large star links each greater neighbour of a node to the node's smallest neighbour, the
    small star each smaller neighbour and the node itself; a logarithmic number of rounds leaves stars around the smallest
    nodes. Components that are such stars are set aside before each round, so rounds only carry what is open. The minima are summed map-side and written before they are joined, so that both sides of the join come straight
    from tables and Spark can split a hub's edges. Each round is a table in the shared folder. Nothing is collected but the
    count of the open edges. Null ends and loops are left out.
    Up to ``small`` open edges (of whole numbers) are joined in one task instead of rounds."""
    now = materialize(edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter("u < v").distinct(), "edges")
    done = []
    while True:
        marked = _marked(now)
        done.append(marked.filter("settled").select("v", "u"))
        now = marked.filter("settled is null").select("v", "u")
        left = now.count()
        if left <= small:
            break
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))  # v: the centre
        least = materialize(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")), "stars")
        large = both.join(least, "v").filter("u > v and u > m").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = materialize(large, "edges")
        least = materialize(large.groupBy("v").agg(F.min("u").alias("m")), "stars")
        nearer = large.join(least, "v").filter("u > m").select(F.col("u").alias("v"), F.col("m").alias("u")).unionByName(least.select("v", F.col("m").alias("u")))
        now = materialize(nearer.distinct(), "edges")
    stars = reduce(DataFrame.unionByName, done)
    found = stars.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(stars.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
    return found.unionByName(now.coalesce(1).mapInArrow(_joined, found.schema)) if left else found


def _marked(edges: DataFrame) -> DataFrame:
    """v, u, settled: true if all that hangs together with the edge is a star around its smallest node, else null.

    Degrees tell: the centre is smaller than its neighbours and has as many of them as there are nodes that hang on it alone."""
    both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
    nodes = materialize(both.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n")), "nodes")
    leaves = nodes.filter("n = 1 and m < v").groupBy(F.col("m").alias("v")).agg(F.count("*").alias("leaves"))
    centres = nodes.filter("m > v").join(leaves, "v").filter("n = leaves").select(F.col("v").alias("u"), F.lit(True).alias("settled"))
    return materialize(edges.join(centres, "u", "left"), "marked")


def _joined(batches):
    edges = [batch for batch in batches if batch.num_rows]
    if not edges:
        return
    edges = pa.Table.from_batches(edges)
    v, u = (edges[c].to_numpy() for c in ("v", "u"))
    nodes, place = np.unique(np.concatenate([v, u]), return_inverse=True)
    yield pa.record_batch([pa.array(nodes), pa.array(least_labels(nodes, place[: len(v)], place[len(v) :]))], names=["node", "component"])


def least_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least label that each place reaches by links i - j."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            return new
        label = new
