"""Near-duplicate embeddings: random-hyperplane sign hashing in several tables, exact cosine check, connected components.

A table's bucket is the signs of ``bits`` random projections (one fixed seed). A pair at the threshold angle shares a
bucket of a table with probability p = (1 - angle / pi) ** bits; with the number of tables at log(MISS) / log(1 - p) it is
missed by all with probability MISS at most. bits grows with the logarithm of the number of vectors without a bound, so
buckets of unrelated vectors stay small, and tables follow; the chance of a miss is the same at every size.

Vectors with equal label and equal components are one node with a weight, so copies are never paired. In a bucket the exact
cosine in double precision decides; a pair counts in the first table that brings it together (the signs of all tables go along, packed), so links are
counted without listing pairs. Rows alone in a bucket are not moved; the others go to it with their components, in single
precision where that holds them exactly. Large buckets are dealt into
cells; every two rows meet in one. Small ones are compared many at a time.

Links need equal, non-null labels and equal lengths. Vectors that are null, empty, zero or hold null or non-finite
components link with nothing, neither do rows without vec_id; they return with n_links 0 and themselves as component.
Repeated rows each return and count each other; rows of equal vec_id and other contents are told apart. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from auditloom.llm.common import groups, materialize, rows
from auditloom.llm.components import connected_components, in_cells, local_stars

COSINE = 0.98
MISS = 1e-6
SEED = 20240601
#: Rows of a cell.
CELL = 1024
#: Pairs checked at a time.
STEP = 1 << 15
#: Cells of up to so many rows are compared all at once, as many as have HELD rows.
SMALL, HELD = 24, 20_000


def plan(n: int, cosine: float) -> tuple[int, int]:
    """bits and tables for n vectors."""
    bits = max(10, math.ceil(math.log2(max(2, n))))
    p = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log1p(-p)) if p < 1 else 1


def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, bits]).standard_normal((dim, bits * tables))


def _signatures(batches: Iterator[pa.RecordBatch], bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    """Bucket numbers (sigs) and the signs themselves, packed (signs)."""
    weights = 1 << np.arange(bits, dtype=np.int64)
    normals: dict[int, np.ndarray] = {}
    for batch in batches:
        lengths = batch.column("dim").to_numpy()
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        signs = np.zeros((batch.num_rows, tables * bits), bool)
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            if d not in normals:
                normals[d] = planes(int(d), bits, tables)
            signs[at] = flat[starts[at][:, None] + np.arange(d)] @ normals[d] > 0
        out = signs.reshape(-1, tables, bits) @ weights
        sigs = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, tables), pa.int32()), pa.array(out.ravel()))
        packed = np.packbits(signs, axis=1)
        packed = pa.Array.from_buffers(pa.binary(), len(packed), [None, pa.py_buffer(np.arange(0, packed.size + 1, packed.shape[1], dtype=np.int32)), pa.py_buffer(packed)])
        yield pa.RecordBatch.from_arrays([*batch.columns, sigs, packed], names=[*batch.schema.names, "sigs", "signs"])


LINKS = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("to", pa.int64())])


class Rows:
    """Rows of one dimension in the order of their cells."""

    def __init__(self, table: pa.Table, cosine: float, bits: int, tables: int):
        self.t, self.ci, self.cj, self.own, self.node, self.weight = (table[c].to_numpy() for c in ("t", "ci", "cj", "own", "node", "weight"))
        v = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1).astype(np.float64)
        self.unit = v / np.sqrt((v * v).sum(axis=1))[:, None]
        self.signs = np.frombuffer(b"".join(table["signs"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        self.cosine, self.bits, self.tables = cosine, bits, tables
        self.n = np.zeros(table.num_rows, np.int64)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def met_before(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the rows of each pair share a bucket of a table before theirs."""
        used, place = np.unique(np.concatenate([p, q]), return_inverse=True)
        signs = np.unpackbits(self.signs[used], axis=1, count=self.tables * self.bits).reshape(len(used), self.tables, self.bits)
        same = (signs[place[: len(p)]] == signs[place[len(p) :]]).all(axis=2)
        return (same & (np.arange(self.tables) < self.t[p][:, None])).any(axis=1)

    def take(self, p: np.ndarray, q: np.ndarray) -> None:
        """Count the pairs that link and meet here first."""
        for x in range(0, len(p), STEP):
            i, j = p[x : x + STEP], q[x : x + STEP]
            near = (self.unit[i] * self.unit[j]).sum(axis=1) >= self.cosine
            i, j = i[near], j[near]
            new = ~self.met_before(i, j)
            i, j = i[new], j[new]
            np.add.at(self.n, i, self.weight[j])
            np.add.at(self.n, j, self.weight[i])
            v, u = local_stars(self.node, i, j)
            self.a.append(v)
            self.b.append(u)

    def small(self, bounds: np.ndarray, most: int) -> None:
        """Cells of up to most rows, all at once: each row with the next, the one after that, and so on in its cell."""
        size = np.diff(bounds)
        last = np.repeat(np.where(size <= most, bounds[1:], 0), size)
        i, j = self.own == self.ci, self.own == self.cj
        diagonal = self.ci == self.cj
        for d in range(1, most):
            at = np.flatnonzero(np.arange(len(last)) + d < last)
            if not len(at):
                return
            at = at[diagonal[at] | (i[at] & j[at + d]) | (j[at] & i[at + d])]
            self.take(at, at + d)

    def large(self, a: int, z: int) -> None:
        i, j = int(self.ci[a]), int(self.cj[a])
        one, two = a + np.flatnonzero(self.own[a:z] == i), a + np.flatnonzero(self.own[a:z] == j)
        for x in range(0, len(one), CELL):
            strip = one[x : x + CELL]
            p, q = np.nonzero(self.unit[strip] @ self.unit[two].T >= self.cosine - 1e-9)
            p, q = strip[p], two[q]
            if i == j:
                p, q = p[p < q], q[p < q]
            self.take(p, q)

    def found(self) -> Iterator[pa.RecordBatch]:
        v, u = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (self.a, self.b))
        yield rows(LINKS, node=v, n=np.zeros(len(v), np.int64), to=u)
        out = np.flatnonzero(self.n)
        yield rows(LINKS, node=self.node[out], n=self.n[out], to=self.node[out])


def _compare(batches: Iterator[pa.RecordBatch], cosine: float, bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for cell in groups(batches, ["t", "label", "dim", "sig", "ci", "cj"]):
        if held and (sum(map(len, held)) + len(cell) > HELD or held[0]["dim"][0] != cell["dim"][0]):
            yield from _compared(held, cosine, bits, tables)
            held = []
        if cell.num_rows > 1:
            held.append(cell)
    if held:
        yield from _compared(held, cosine, bits, tables)


def _compared(cells: list[pa.Table], cosine: float, bits: int, tables: int) -> Iterator[pa.RecordBatch]:
    bounds = np.cumsum([0, *map(len, cells)])
    r = Rows(pa.concat_tables(cells), cosine, bits, tables)
    r.small(bounds, SMALL)
    for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if z - a > SMALL:
            r.large(a, z)
    yield from r.found()


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row: vec_id, n_links (other rows linked directly), component_id, kept."""
    v = F.col("embedding").cast("array<double>")
    base = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    keyed = base.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.transform("v", lambda x: x + F.lit(0.0))))  # no -0.0
    keyed = keyed.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    nodes = keyed.filter("node is not null").groupBy("node", "label", "v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("weight"))
    single = isinstance(embeddings.schema["embedding"].dataType, ArrayType) and isinstance(embeddings.schema["embedding"].dataType.elementType, FloatType)
    kind = "array<float>" if single else "array<double>"
    nodes = materialize(nodes.withColumn("dim", F.size("v")).withColumn("v", F.col("v").cast(kind)), "vectors")
    bits, tables = plan(nodes.count(), cosine)
    signed = nodes.drop("first_id").mapInArrow(lambda it: _signatures(it, bits, tables), f"node long, label long, v {kind}, weight long, dim int, sigs array<long>, signs binary")
    signed = materialize(signed, "signatures")
    keys = ["t", "label", "dim", "sig"]
    shared = signed.select("label", "dim", F.posexplode("sigs").alias("t", "sig")).groupBy(*keys).count().filter("count > 1").select(*keys)
    # Who is alone in a bucket is not moved; the others go to their cells with their vectors.
    full = signed.select("node", "label", "v", "weight", "dim", "signs", F.posexplode("sigs").alias("t", "sig")).join(materialize(shared, "buckets"), keys, "left_semi")
    dealt = in_cells(full, keys, F.col("node"), CELL).repartition(*keys, "ci", "cj").sortWithinPartitions(*keys, "ci", "cj")
    found = materialize(dealt.mapInArrow(lambda it: _compare(it, cosine, bits, tables), "node long, n long, to long"), "links")
    joined = materialize(connected_components(found.select(F.col("node").alias("a"), F.col("to").alias("b"))), "components")
    placed = materialize(nodes.select("node", "first_id", "weight").join(joined, "node", "left").withColumn("c", F.coalesce("component", "node")), "placed")
    firsts = materialize(placed.groupBy("c").agg(F.min("first_id").alias("component_id")), "firsts")
    counts = materialize(found.groupBy("node").agg(F.sum("n").alias("n")), "counts")
    per_node = placed.join(firsts, "c").join(counts, "node", "left").select("node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), "component_id")
    out = keyed.select("vec_id", "node").join(materialize(per_node, "nodes"), "node", "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
