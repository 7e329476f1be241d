"""Average linkage of vectors in groups of any size."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize
from auditloom.operators.graph import connected_components

#: Groups of up to so many vectors are folded in one task; blocks in which vectors of larger ones meet.
LOCAL, BLOCK = 1000, 2000
#: Distances that agree in so many decimals are ties.
DECIMALS = 10


def agglomerative(vectors: DataFrame, group: str, threshold: float = 0.85) -> DataFrame:
    """group, vec_id, cluster: average linkage on cosine distance within each group down to max(1, int(n * (1 - threshold)))
    clusters, numbered by their least members. vec_id is unique. Zero vectors have distance 1 to all; rows without a group, id or vector are left out. Of pairs with one distance the
    one of least ids merges first.

    The mean distance of two clusters is 1 minus the product of their mean unit vectors, so a cluster is one vector and no matrix
    of distances is kept. Clusters that are each other's nearest merge, all at once a round: average linkage never brings a
    third one nearer by a merge, so these merges belong to the result whatever else is to come, and who has an unmerged nearest keeps it.
    Only new clusters and those whose nearest merged look for another, block by block. A group rests once its
    lowest merges cannot change: as many as it needs lie below all distances left. Small groups are folded by one task each."""
    sound = vectors.filter(f"{group} is not null and vec_id is not null and embedding is not null").select(group, "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sound = materialize(sound.withColumn("norm", norm).select(group, "vec_id", F.when(F.col("norm") > 0, F.transform("v", lambda x: x / F.col("norm"))).otherwise(F.col("v")).alias("m")), "units")
    sizes = materialize(sound.groupBy(group).agg(F.count("*").alias("size")), "sizes")
    sized = sound.join(sizes, group)
    kind = sound.schema[group].dataType.simpleString()
    small = sized.filter(F.col("size") <= LOCAL).select(group, "vec_id", "m").groupBy(group).applyInPandas(lambda pdf: _fold(pdf, group, threshold), f"{group} {kind}, vec_id long, cluster int")
    large = sized.filter(F.col("size") > LOCAL)
    if large.isEmpty():
        return small
    merges = _merges(large.select(F.col(group).alias("g"), F.col("vec_id").alias("id"), F.lit(1).cast("long").alias("n"), "m"), sizes.select(F.col(group).alias("g"), "size"), threshold)
    joined = connected_components(merges, "a", "b")
    labelled = large.select(group, "vec_id").join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left").withColumn("component", F.coalesce("component", "vec_id"))
    numbers = labelled.filter("component = vec_id").withColumn("cluster", F.row_number().over(Window.partitionBy(group).orderBy("component")) - 1)
    return small.unionByName(labelled.join(numbers.select("component", "cluster"), "component").select(group, "vec_id", "cluster"))


def _needed(size: int, threshold: float) -> int:
    return size - max(1, int(size * (1 - threshold)))


def _fold(pdf: pd.DataFrame, group: str, threshold: float) -> pd.DataFrame:
    """A small group by its matrix of distances."""
    pdf = pdf.sort_values("vec_id")
    x = np.stack(pdf["m"].to_numpy())
    d = np.round(1 - x @ x.T, DECIMALS)
    n = len(x)
    np.fill_diagonal(d, np.inf)
    size, label = np.ones(n), np.arange(n)
    for _ in range(_needed(n, threshold)):
        a, b = sorted(np.unravel_index(int(d.argmin()), d.shape))
        d[a] = d[:, a] = (d[a] * size[a] + d[b] * size[b]) / (size[a] + size[b])
        d[b] = d[:, b] = np.inf
        d[a, a] = np.inf
        size[a] += size[b]
        label[label == b] = a
    return pd.DataFrame({group: pdf[group], "vec_id": pdf["vec_id"], "cluster": np.unique(label, return_inverse=True)[1]})


NEAREST = pa.schema([("id", pa.int64()), ("d", pa.float64()), ("other", pa.int64())])


def _nearest(rows: pa.Table) -> pa.Table:
    """Of each asking cluster of a block, the nearest in another block; of equals the least id."""
    rows = rows.sort_by("id")
    asks = rows["asks"].to_numpy()
    ids, x = rows["id"].to_numpy(), rows["m"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(a) or not len(b):
        return NEAREST.empty_table()
    d = np.round(1 - x[a] @ x[b].T, DECIMALS)
    d[ids[a][:, None] == ids[b]] = np.inf
    at = d.argmin(axis=1)
    best = d[np.arange(len(a)), at]
    some = np.isfinite(best)
    return pa.table([ids[a][some], best[some], ids[b][at][some]], schema=NEAREST)


def _look(asking: DataFrame, active: DataFrame) -> DataFrame:
    """g, id, d, other: the nearest active cluster of the group for each asking one."""
    blocks = active.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("to"))
    parts = asking.groupBy("g").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("from"))
    cut = materialize(blocks.join(parts, "g"), "blocks")  # a row a group
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    one = asking.join(cut, "g").withColumn("p", mine("from")).withColumn("q", spread("to")).withColumn("asks", F.lit(True))
    two = active.join(cut, "g").withColumn("q", mine("to")).withColumn("p", spread("from")).withColumn("asks", F.lit(False))
    met = one.select("g", "p", "q", "asks", "id", "m").unionByName(two.select("g", "p", "q", "asks", "id", "m"))
    found = met.groupBy("g", "p", "q").applyInArrow(lambda key, rows: _keyed(key[0], _nearest(rows)), f"g {active.schema['g'].dataType.simpleString()}, id long, d double, other long")
    return found.groupBy("g", "id").agg(F.min(F.struct("d", "other")).alias("best")).select("g", "id", "best.d", "best.other")


def _keyed(key: pa.Scalar, rows: pa.Table) -> pa.Table:
    return rows.add_column(0, "g", pa.array([key.as_py()] * rows.num_rows, key.type))


def _merges(active: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """a, b: the merges that the groups need, the lowest ones of each."""
    need = sizes.withColumn("need", F.col("size") - F.greatest(F.lit(1), F.floor(F.col("size") * F.lit(1 - threshold)).cast("long"))).select("g", "need")
    active = materialize(active, "active")
    near = materialize(_look(active, active), "near")
    merged: DataFrame | None = None
    step = 0
    while True:
        other = near.select("g", F.col("id").alias("other"), F.col("other").alias("id"))
        pairs = near.join(other, ["g", "id", "other"]).filter("id < other")
        pairs = materialize(pairs.select("g", F.col("id").alias("a"), F.col("other").alias("b"), "d", F.lit(step).alias("step")), "pairs")
        if pairs.isEmpty():
            # Sums of products in another order may differ in the last decimal; the least pair of each group merges in any case.
            least = near.groupBy("g").agg(F.min(F.struct("d", F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))).alias("x"))
            pairs = materialize(least.select("g", "x.a", "x.b", "x.d", F.lit(step).alias("step")), "pairs")
            if pairs.isEmpty():
                break
        merged = pairs if merged is None else materialize(merged.unionByName(pairs), "merged")
        half = lambda c: active.withColumnRenamed("id", c).withColumnsRenamed({"n": f"n{c}", "m": f"m{c}"})
        made = pairs.join(half("a"), ["g", "a"]).join(half("b"), ["g", "b"])
        total = F.col("na") + F.col("nb")
        made = made.select("g", F.col("a").alias("id"), total.alias("n"), F.zip_with("ma", "mb", lambda x, y: (x * F.col("na") + y * F.col("nb")) / total).alias("m"))
        gone = pairs.select("g", F.explode(F.array("a", "b")).alias("id"))
        active = materialize(active.join(gone, ["g", "id"], "left_anti").unionByName(made), "active")
        left = near.join(gone, ["g", "id"], "left_anti").join(gone.withColumnRenamed("id", "other"), ["g", "other"], "left_anti").select("g", "id", "d", "other")
        near = materialize(left.unionByName(_look(active.join(left.select("g", "id"), ["g", "id"], "left_anti"), active)), "near")
        # A group rests when enough merges lie below whatever is left; merges never get lower than that.
        lowest = near.groupBy("g").agg(F.min("d").alias("low"))
        done = merged.join(lowest, "g").join(need, "g").groupBy("g").agg(F.count_if(F.col("d") <= F.col("low")).alias("sure"), F.first("need").alias("need")).filter("sure >= need").select("g")
        done = materialize(done, "done")
        if not done.isEmpty():
            active, near = materialize(active.join(done, "g", "left_anti"), "active"), materialize(near.join(done, "g", "left_anti"), "near")
        step += 1
    if merged is None:
        return active.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    ranked = merged.withColumn("at", F.row_number().over(Window.partitionBy("g").orderBy("d", "step", "a")))
    return ranked.join(need, "g").filter("at <= need").select("a", "b")
