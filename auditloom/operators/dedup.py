"""Similarity of findings and their clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.operators import similarity
from auditloom.operators.graph import connected_components
from auditloom.operators.linkage import agglomerative  # noqa: F401

#: Links of clusters up to so many are joined in one task.
SMALL = 10_000


def cosine_pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """i < j, sim >= threshold of all vectors (vec_id, embedding), exactly. Zero vectors are similar to nothing; null ones are left out."""
    return similarity.pairs(vectors, threshold)


def jaccard(a: Column, b: Column) -> Column:
    """Of distinct lower-cased words; two empty texts 1, one empty 0."""
    words = lambda t: F.array_distinct(F.filter(F.split(F.lower(t), r"\s+"), lambda w: w != ""))
    x, y = words(a), words(b)
    return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def dbscan(vectors: DataFrame, eps: float = 0.5) -> DataFrame:
    """vec_id, root: clusters of cosine distance up to eps with two members at least, which are the components of the links;
    root is the smallest member, null for noise."""
    found = connected_components(similarity.stars(vectors, 1 - eps), small=SMALL)
    return vectors.select("vec_id").join(found.select(F.col("node").alias("vec_id"), F.col("component").alias("root")), "vec_id", "left")


def cluster_sizes(labels: DataFrame) -> DataFrame:
    """Members a cluster, noise as root null."""
    return labels.groupBy("root").agg(F.count("*").alias("n"))


def merged(findings: DataFrame, labels: DataFrame) -> DataFrame:
    """findings (finding_id, confidence), labels (finding_id, root: null for noise) -> a row a member: merged_id (D- and the
    representative's id), cluster_id (the root, or noise- and the finding's id), size, finding_id, score (the member's
    confidence), representative. The first member stands for its cluster; noise is a cluster of one."""
    held = findings.join(labels, "finding_id").withColumn("cluster_id", F.coalesce(F.col("root").cast("string"), F.concat(F.lit("noise-"), F.col("finding_id").cast("string"))))
    sizes = held.groupBy("cluster_id").agg(F.count("*").alias("size"), F.min("finding_id").alias("first"))
    return held.join(sizes, "cluster_id").select(F.concat(F.lit("D-"), F.col("first").cast("string")).alias("merged_id"), "cluster_id", "size", "finding_id", F.col("confidence").alias("score"), (F.col("finding_id") == F.col("first")).alias("representative"))
