"""Local links of a block, and the splitting of hot buckets into cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize
from auditloom.operators.graph import connected_components  # noqa: F401

#: Hot buckets up to this many are broadcast; more are joined by key.
FEW = 10_000


def local_stars(nodes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links i - j (positions in nodes) as edges of each linked node to the smallest node of its local component."""
    label = nodes.copy()
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == label).all():
            break
        label = new
    out = np.flatnonzero(label != nodes)
    return nodes[out], label[out]


def in_cells(df: DataFrame, keys: list[str], member: Column, limit: int) -> DataFrame:
    """df with columns ci, cj, own: buckets (equal keys) of up to limit rows stay one cell (0, 0); a larger one is dealt into
    blocks of about limit rows by member, and each row goes to the cell of its block (own) and every other, so that any two
    rows of the bucket meet in exactly one cell. All rows stay. What is counted first is a row a bucket and task."""
    hot = materialize(df.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys, F.ceil(F.col("count") / limit).cast("int").alias("blocks")), "hot")
    n = hot.count()
    if n == 0:
        return df.select("*", F.lit(0).alias("ci"), F.lit(0).alias("cj"), F.lit(0).alias("own"))
    dealt = df.join(F.broadcast(hot) if n <= FEW else hot, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(*df.columns, F.least("own", "other").alias("ci"), F.greatest("own", "other").alias("cj"), "own")


EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])
