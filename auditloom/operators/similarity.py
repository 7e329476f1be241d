"""Exact similarity joins of vectors by angle, with pivots and the triangle inequality."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize
from auditloom.operators.graph import least_labels

#: Pivots at most, inner vectors of a unit, outer ones sent to a unit, and vectors compared with them at a time, about.
PIVOTS, INNER, OUTER, STEP = 1024, 2000, 16_000, 4096
#: Added to bounds of angles, so that rounding loses no pair.
SLACK = 1e-7
UNIT = ["dim", "cell", "part", "share"]


def _units(flat: np.ndarray, n: int) -> np.ndarray:
    x = flat.reshape(n, -1).astype(np.float64)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, unit vectors) of a batch."""
    dims = batch.column("dim").to_numpy()
    starts = np.concatenate([[0], np.cumsum(dims)])
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        yield d, at, _units(flat[starts[at][:, None] + np.arange(d)], len(at))


def _own(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Each vector's cell (its nearest pivot, 0 where its dimension has none) and how far that is."""
    for batch in batches:
        cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
        for d, at, x in _by_dim(batch):
            if d in pivots:
                angle = _angles(x, pivots[d])
                cell[at] = angle.argmin(axis=1)
                far[at] = angle.min(axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "own", "far"])


def _sent(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], reach: dict[int, np.ndarray], theta: float) -> Iterator[pa.RecordBatch]:
    """The cells before its own (cells) that may hold a vector within theta: by the cell's greatest distance from its pivot, and
    by the plane half way between both pivots."""
    for batch in batches:
        own, far = batch.column("own").to_numpy(), batch.column("far").to_numpy()
        lists: list[list[int]] = [[] for _ in range(batch.num_rows)]
        for d, at, x in _by_dim(batch):
            if d not in pivots:
                continue
            angle = _angles(x, pivots[d])
            near = (angle <= reach[d] + theta + SLACK) & ((angle - far[at][:, None]) / 2 <= theta + SLACK) & (np.arange(len(reach[d])) < own[at][:, None])
            for i, row in zip(at.tolist(), near):
                lists[i] = np.flatnonzero(row).tolist()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])


def dealt(vectors: DataFrame, threshold: float) -> DataFrame:
    """vectors: vec_id, embedding -> vec_id, v, dim, cell, part, share, inner: any two vectors whose cosine may reach the threshold meet in
    exactly one unit (dim, cell, part, share), at least one of them being inner there.

    Pivots are vectors (those of least hash: up to the square root of their number, PIVOTS at most, the only vectors on the driver). A
    vector is inner in the cell of its nearest pivot and outer in those earlier cells that its angles to the pivots do not rule out. A
    large cell is cut: its inner vectors into parts of about INNER, of which the later ones also meet the earlier ones as
    outer, and what is outer to a cell into shares of about OUTER, each with the inner vectors of its own. Without structure in the data
    all cells stay in reach, and the work is that of all pairs, in bounded units. Null, empty and zero vectors, and those with null or
    non-finite components, are left out."""
    theta = math.acos(max(-1.0, min(1.0, threshold)))
    sound = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    sound = materialize(sound.filter("vec_id is not null and v is not null").filter(finite).withColumn("dim", F.size("v")), "vectors")
    k = min(PIVOTS, math.isqrt(sound.count()))
    found: dict[int, list] = {}
    for row in sound.orderBy(F.xxhash64("vec_id"), "vec_id").limit(k).collect():
        found.setdefault(row["dim"], []).append(row["v"])
    pivots = {d: _units(np.array(v), len(v)) for d, v in found.items()}
    owned = materialize(sound.mapInArrow(lambda it: _own(it, pivots), "vec_id long, v array<double>, dim int, own int, far double"), "owned")
    cells = {(r["dim"], r["own"]): (r["far"], r["n"]) for r in owned.filter(F.col("dim").isin(list(pivots))).groupBy("dim", "own").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    reach = {d: np.array([cells.get((d, c), (-np.inf, 0))[0] for c in range(len(p))]) for d, p in pivots.items()}
    sizes = owned.groupBy("dim", F.col("own").alias("cell")).agg(F.ceil(F.count("*") / INNER).cast("int").alias("parts"))
    placed = owned.mapInArrow(lambda it: _sent(it, pivots, reach, theta), "vec_id long, v array<double>, dim int, own int, far double, cells array<int>")
    placed = materialize(placed.select("vec_id", "v", "dim", "own", "cells"), "placed")
    outer = placed.select("dim", F.explode("cells").alias("cell")).groupBy("dim", "cell").agg(F.ceil(F.count("*") / OUTER).cast("int").alias("shares"))
    # A row a cell: pivots are at most PIVOTS, dimensions without one have a single cell.
    cut = materialize(sizes.join(outer, ["dim", "cell"], "left").select("dim", "cell", "parts", F.coalesce("shares", F.lit(1)).alias("shares")), "cells")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    share = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("shares")).cast("int")
    step = lambda a, b: F.sequence(a, b)
    mine = placed.withColumn("cell", F.col("own")).join(cut, ["dim", "cell"]).withColumn("at", part)
    inner = mine.withColumn("share", F.explode(step(F.lit(0), F.col("shares") - 1))).select("vec_id", "v", "dim", "cell", F.col("at").alias("part"), "share", F.lit(True).alias("inner"))
    later = mine.filter("at + 1 < parts").withColumn("part", F.explode(step(F.col("at") + 1, F.col("parts") - 1))).select("vec_id", "v", "dim", "cell", "part", share.alias("share"), F.lit(False).alias("inner"))
    others = placed.withColumn("cell", F.explode("cells")).join(cut, ["dim", "cell"]).withColumn("part", F.explode(step(F.lit(0), F.col("parts") - 1))).select("vec_id", "v", "dim", "cell", "part", share.alias("share"), F.lit(False).alias("inner"))
    return inner.unionByName(later).unionByName(others)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """(inner ids, inner vectors, ids, vectors) of the meetings of a partition sorted by unit, inner rows first: the inner rows are
    held, the others pass by. Inner vectors come with every share of their part and meet each other (None) in the first."""
    unit, ids, held = None, [], []
    inner: tuple | None = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in UNIT], axis=1)
        inside = batch.column("inner").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (inside[1:] != inside[:-1])) + 1
        for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if z == a:
                continue
            rows, key = batch.slice(a, z - a), tuple(keys[a].tolist())
            x, i = _units(rows.column("v").flatten().to_numpy(zero_copy_only=False), z - a), rows.column("vec_id").to_numpy()
            if key != unit:
                if held and inner is None and unit[-1] == 0:
                    yield np.concatenate(ids), np.concatenate(held), None, None
                unit, ids, held, inner = key, [], [], None
            if inside[a]:
                ids.append(i)
                held.append(x)
            elif held:
                if inner is None:
                    inner = np.concatenate(ids), np.concatenate(held)
                    if key[-1] == 0:
                        yield *inner, None, None
                yield *inner, i, x
    if held and inner is None and unit[-1] == 0:
        yield np.concatenate(ids), np.concatenate(held), None, None


def _reached(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(inner ids, other ids, places of the pairs that reach the threshold in both, their cosines), a step of others at a time;
    where the inner ones meet each other they are the others too."""
    for inner, x, ids, y in _meetings(batches):
        for s in range(0, len(inner if ids is None else ids), STEP):
            other = x if ids is None else y
            sims = x @ other[s : s + STEP].T
            p, q = np.nonzero(sims >= threshold)
            if ids is None:
                keep = p < q + s
                p, q = p[keep], q[keep]
            yield inner, inner[s : s + STEP] if ids is None else ids[s : s + STEP], p, q, sims[p, q]


def pairs(vectors: DataFrame, threshold: float) -> DataFrame:
    """i < j, sim of all pairs of vectors whose cosine reaches the threshold."""
    schema = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("sim", pa.float64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for inner, ids, p, q, sims in _reached(batches, threshold):
            a, b = inner[p], ids[q]
            yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sims)], schema=schema)

    return _in_units(dealt(vectors, threshold)).mapInArrow(found, "i long, j long, sim double")


def stars(vectors: DataFrame, threshold: float) -> DataFrame:
    """a, b: links with the same connected components as all pairs that reach the threshold, about one a vector and unit: in a
    unit, what links join is led to its least id, and pairs are not listed."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, label = None, np.zeros(0, np.int64)
        for inner, ids, p, q, _ in _reached(batches, threshold):
            if held is not inner:
                held, label = inner, inner.copy()
            # Labels are ids of the component; a label that falls is linked to the new one, so what had it stays linked.
            nodes = np.concatenate([label, ids])
            new = least_labels(nodes, p, q + len(inner))
            links = np.unique(np.stack([nodes, new], axis=1)[nodes != new], axis=0)
            label = new[: len(inner)]
            yield pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=schema)

    return _in_units(dealt(vectors, threshold)).mapInArrow(found, "a long, b long")


def _in_units(rows: DataFrame) -> DataFrame:
    return rows.repartition(*UNIT).sortWithinPartitions(*UNIT, F.desc("inner")).select("vec_id", "v", *UNIT, "inner")

