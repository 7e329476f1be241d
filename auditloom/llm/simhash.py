"""SimHash near-duplicates by anchor-point covering.

Anchors are the words of the perfect binary Golay code: every 23-bit word is within 3 of exactly one of the 4096 code words,
its home. The fingerprint's 64 bits are dealt into three segments of up to 22 bits (padded with zeros to 23). Of two
fingerprints that differ in at most 4 bits some segment differs in at most 1, so there the home of either is within 3 + 1 of
the other: every fingerprint is replicated, in each segment, to all code words within 4 (one to six), and per anchor those
at home are compared with all replicas, by the exact distance over 64 bits. No pair within 4 bits is missed.

With many fingerprints the anchors become finer: the 42 other bits are dealt into m blocks of which m - 4 at least agree,
and every choice of m - 4 blocks joins the anchor's key. That changes how many rows meet, never which pairs are found.

Null text: no words, fingerprint zero. Documents of equal fingerprints are one node, named by the smallest doc_id, so copies
are never paired. A row without doc_id gets its fingerprint, links nothing and has no component. Repeated rows each give a
row. Very long texts are read whole. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import chunks, groups, materialize, rows
from auditloom.llm.components import EDGE_SCHEMA, connected_components, in_cells, local_stars

SHINGLE = 4
SEED = 42
DISTANCE = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
#: Rows of a cell: 40 bytes each in memory, so a cell is small, and few anchors have more.
CELL = 16_384
#: Rows of a cell compared with the others at a time.
STRIP = 128
#: Replicas that cost as much as comparing one row with this many others: a replica is written, moved and sorted (microseconds),
#: a comparison is an exclusive or and a count of bits (a nanosecond).
REPLICA_COST = 2000


def fingerprint(words: list[bytes]) -> int:
    if not words:
        return 0
    if len(words) <= SHINGLE:
        shingles = [b" ".join(words)]
    else:
        text = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        shingles = map(text.__getitem__, map(slice, starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist()))
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(bits * 2 > len(h), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text column replaced by its fingerprint."""
    for batch in batches:
        for a, b in chunks(batch.column("text")):
            part = batch.slice(a, b - a)
            fp = [fingerprint((t or "").encode().lower().split()) for t in part.column("text").to_pylist()]
            yield part.set_column(part.schema.get_field_index("text"), "fp", pa.array(fp, pa.int64()))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def _remainders() -> np.ndarray:
    """x^i modulo the generator for i below 23."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= GENERATOR
    return np.array(out, np.int64)


def _patterns() -> np.ndarray:
    """For each of the 2048 syndromes the error patterns of up to 4 bits that have it: the home's first, then others or -1."""
    rest = _remainders()
    out = np.full((2048, 6), -1, np.int64)
    used = np.zeros(2048, int)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = int(np.bitwise_xor.reduce(rest[list(bits)])) if bits else 0
            out[s, used[s]] = sum(1 << b for b in bits)
            used[s] += 1
    return out


_TABLES: list[np.ndarray] = []


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits, and the patterns; made once a worker."""
    if not _TABLES:
        rest = _remainders()
        for base, n in ((0, 12), (12, 11)):
            t = np.zeros(1 << n, np.int64)
            for i in range(n):
                t[1 << i : 2 << i] = t[: 1 << i] ^ rest[base + i]
            _TABLES.append(t)
        _TABLES.append(_patterns())
    return tuple(_TABLES)  # type: ignore[return-value]


def anchors(words: np.ndarray) -> np.ndarray:
    """(n, 6) code words within 4 of each 23-bit word, the home first, -1 where there are fewer."""
    low, high, patterns = tables()
    p = patterns[low[words & 0xFFF] ^ high[words >> 12]]
    return np.where(p < 0, -1, words[:, None] ^ p)


def finer_blocks(n: int) -> int:
    """m for n fingerprints, 0 for the code words alone: whichever makes the sum of replicas and comparisons least. Both grow
    smoothly with n, and the code words alone are best up to about thirty million fingerprints."""

    def cost(m: int) -> float:
        choices, bits = (comb(m, DISTANCE), 42 * (m - DISTANCE) // m) if m else (1, 0)
        # Per fingerprint: 5.3 replicas a segment and choice, and one home that meets its bucket.
        return 3 * choices * (5.3 * REPLICA_COST + n * 5.3 / 4096 / 2**bits)

    return min((0, *range(5, 11)), key=cost)


REPLICAS = pa.schema([("t", pa.int32()), ("anchor", pa.int64()), ("exact", pa.int64()), ("home", pa.bool_()), ("node", pa.int64()), ("fp", pa.int64())])


def _replicate(batches: Iterator[pa.RecordBatch], m: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, fp = batch.column("node").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
        for s, (shift, width) in enumerate(SEGMENTS):
            near = anchors((fp >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64))
            i, k = np.nonzero(near >= 0)
            others = [b for b in range(64) if not shift <= b < shift + width]
            blocks = [sum(1 << b for b in others[len(others) * x // m : len(others) * (x + 1) // m]) for x in range(m)]
            for c, chosen in enumerate(combinations(blocks, m - DISTANCE) if m else [()]):
                exact = fp[i] & np.uint64(sum(chosen))
                yield rows(REPLICAS, t=np.full(len(i), s * 1000 + c, np.int32), anchor=near[i, k], exact=exact.view(np.int64), home=k == 0, node=node[i], fp=fp[i].view(np.int64))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cell in groups(batches, ["t", "anchor", "exact", "ci", "cj"]):
        home, own, node, fp = (cell[c].to_numpy() for c in ("home", "own", "node", "fp"))
        fp = fp.view(np.uint64)
        i, j = int(cell["ci"][0].as_py()), int(cell["cj"][0].as_py())
        for x, y in {(i, j), (j, i)}:
            one, all_ = np.flatnonzero(home & (own == x)), np.flatnonzero(own == y)
            # Blocks are about CELL rows; strips bound the distance matrix should one be larger.
            for a in range(0, len(one), STRIP):
                p, q = np.nonzero(np.bitwise_count(fp[one[a : a + STRIP], None] ^ fp[None, all_]) <= DISTANCE)
                v, u = local_stars(node, one[a + p], all_[q])
                yield rows(EDGE_SCHEMA, a=v, b=u)


def links(nodes: DataFrame, n: int) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within DISTANCE; nodes: node, fp, distinct."""
    m = finer_blocks(n)
    keys = ["t", "anchor", "exact"]
    replicas = nodes.mapInArrow(lambda it: _replicate(it, m), "t int, anchor long, exact long, home boolean, node long, fp long")
    cells = in_cells(replicas, keys, F.col("fp"), CELL)
    dealt = cells.repartition(*keys, "ci", "cj").sortWithinPartitions(*keys, "ci", "cj")
    return dealt.mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest doc_id reachable by links)."""
    prints = materialize(fingerprints(docs), "simhash")
    nodes = materialize(prints.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    joined = materialize(connected_components(links(nodes, nodes.count())), "components")
    reached = nodes.join(joined, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    of = materialize(reached, "reached")
    out = prints.join(of, "fp", "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def text_hash(text: Column) -> Column:
    """Tells the texts of one doc_id apart."""
    return F.xxhash64(text)


def representatives(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash: of the rows whose fingerprints link up, the one of the smallest doc_id and then text_hash. Here rows and
    not ids are linked: texts that share a doc_id and nothing else are apart. Rows without doc_id are left out."""
    rows_ = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("text_hash"), "text")
    prints = materialize(rows_.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long"), "simhash")
    firsts = materialize(prints.groupBy("fp").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")), "firsts")
    joined = materialize(connected_components(links(firsts.select(F.col("fp").alias("node"), "fp"), firsts.count())), "components")
    groups_ = firsts.join(joined.withColumnRenamed("node", "fp"), "fp", "left").groupBy(F.coalesce("component", "fp"))
    return groups_.agg(F.min("first").alias("first")).select("first.*").distinct()
