"""Documents in blocks of bounded size, and the exchange of what blocks hold for what all blocks together know of it.

A block's distinct 64-bit keys go out sorted and cut by their top bits into parts; a part meets the same key range of all
blocks, and its answers come back in the order sent, so keys never travel twice and no key is ever a row: a key that many
blocks share arrives once from each. Keys travel as differences with their bytes transposed, of which the shuffle's
compression drops the leading ones.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import materialize, shuffle_partitions

#: Bytes of text a block, and keys a part, that are aimed at.
BLOCK_BYTES = 6_000_000
PART_KEYS = 1_500_000
#: Ranges that come from quantiles; finer blocks divide these evenly.
RANGES = 1000
#: Stands for a null id where blocks are numbered.
NULL_ID = -(2**62)
FACTOR = 0x9E3779B97F4A7C15


def measured(docs: DataFrame, *keys: str) -> DataFrame:
    """doc_id, key (a hash of the columns that blocks go by) and bytes of each row, as a table: texts are read once for it."""
    return materialize(docs.select("doc_id", F.xxhash64(*keys).alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("bytes")), "sizes")


def extent(sizes: DataFrame) -> tuple[int, int]:
    """Numbers of blocks and of parts (a power of two), from the bytes of all rows."""
    size = sizes.agg(F.sum("bytes")).first()[0] or 0
    least = shuffle_partitions(sizes.sparkSession)
    blocks = max(least, math.ceil(size / BLOCK_BYTES))
    return blocks, 1 << math.ceil(math.log2(max(least, size / 6 / PART_KEYS, 2)))


def folded(docs: DataFrame, sizes: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame | None]:
    """docs with copies, and the rows among them whose key has more than two blocks of bytes (None if no key has). Of these
    equal rows are one row with their number, summed before they are moved; all others stay as they are with copies 1."""
    hot = materialize(sizes.groupBy("key").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") > 2 * BLOCK_BYTES).select(F.col("key").alias("__key"), F.lit(True).alias("__hot")), "hot")
    one = F.lit(1).cast("long").alias("copies")
    if hot.isEmpty():
        return docs.select("*", one), None
    marked = docs.withColumn("__key", F.xxhash64(*keys)).join(hot, "__key", "left")  # no text moves unless hot keys are too many to broadcast
    few = materialize(marked.filter("__hot").groupBy(*docs.columns).agg(F.count("*").alias("copies")), "folded")
    return marked.filter("__hot is null").select(*docs.columns, one).unionByName(few), few


def _prefix(text: Column) -> Column:
    """The first seven bytes as a number."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(-1))


def range_block(sizes: DataFrame, blocks: int, hot: DataFrame | None) -> Column:
    """Block number of a row (doc_id, text) by ascending doc_id: block i holds no id above those of block i + 1. Null ids stand
    first. Ranges have about equal bytes. An id of more than two blocks, null or not, has ranges of its own by text."""
    n = min(blocks, RANGES)
    mean = sizes.agg(F.avg("bytes")).first()[0] or 1
    # Longer rows count as often as their bytes are more than the mean: at most twice as many rows in all.
    spread = sizes.select("doc_id", F.explode(F.sequence(F.lit(1), F.ceil(F.col("bytes") / mean).cast("int"))))
    bounds = spread.agg(F.percentile_approx("doc_id", [i / n for i in range(n + 1)], 20 * RANGES)).first()[0] or []
    finer = math.ceil(blocks / max(1, n))
    inner: dict[int, np.ndarray] = {}
    if hot is not None:
        cuts = F.percentile_approx(_prefix(F.col("text")), [i / RANGES for i in range(1, RANGES)], 20 * RANGES)
        # A row for two blocks of bytes at least: no more than there are blocks.
        inner = {NULL_ID if r["doc_id"] is None else r["doc_id"]: np.unique(r["cuts"]) for r in hot.groupBy("doc_id").agg(cuts.alias("cuts")).collect()}
    edges = np.unique(np.array([*bounds, *inner, *(i + 1 for i in inner)], np.int64))

    @F.pandas_udf("long")
    def block(ids: pd.Series, prefix: pd.Series) -> pd.Series:
        x = ids.fillna(NULL_ID).to_numpy(np.int64) if ids.hasnans else ids.to_numpy(np.int64)
        at = np.searchsorted(edges, x, "right")
        out = at * finer
        if finer > 1 and len(edges) > 1:
            low = edges[np.clip(at - 1, 0, len(edges) - 1)]
            wide = np.maximum(1, edges[np.clip(at, 0, len(edges) - 1)] - low)
            inside = np.clip((x - low) * (finer / wide), 0, finer - 1).astype(np.int64)
            out += np.where((at == 0) | (at == len(edges)), 0, inside)
        out *= RANGES
        for i, cuts in inner.items():
            mine = x == i
            out[mine] += np.searchsorted(cuts, prefix.to_numpy(np.int64)[mine], "right")
        return pd.Series(out)

    return block("doc_id", _prefix(F.col("text")) if inner else F.lit(0).cast("long"))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def runs(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of n consecutive values, by doubling."""
    out, have, power, k = None, 0, h, 1
    total = len(h) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64)
    while n:
        if n & 1:
            tail = power[have:] if out is not None else power
            out = tail if out is None else out[: len(tail)] * np.uint64(pow(FACTOR, k, 2**64)) + tail[: len(out)]
            have += k
        n >>= 1
        if n:
            power = power[:-k] * np.uint64(pow(FACTOR, k, 2**64)) + power[k:]
            k *= 2
    return mixed(out[:total])


class Words:
    """The words of some documents: one list, ids of distinct words, their hashes, and where documents begin."""

    def __init__(self, docs: list[list[bytes]]):
        self.words = list(chain.from_iterable(docs))
        self.bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        self.ids = np.fromiter(map(vocabulary.__getitem__, self.words), np.int64, len(self.words))
        self.distinct = list(vocabulary)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.distinct), np.uint64, len(self.distinct))


def packed(keys: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype=np.uint64)


def planes(x: np.ndarray) -> bytes:
    """Bytes of unsigned 64-bit numbers, transposed: all first bytes, then all second ones."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def cut_parts(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """(part, range) of the ascending keys, by their top bits; empty parts are left out."""
    shift = np.uint64(64 - parts.bit_length() + 1)
    ends = np.searchsorted(keys, np.arange(1, parts, dtype=np.uint64) << shift)
    for p, (a, b) in enumerate(zip([0, *ends.tolist()], [*ends.tolist(), len(keys)])):
        if b > a:
            yield p, slice(a, b)
