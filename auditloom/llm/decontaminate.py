"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Texts are lower-cased and runs of white space become one blank. A document holds an item if some stretch of it is within k
edits (Levenshtein) of the whole item; k is EDITS of the item's characters, and for items of less than about 36 characters
as many as the lemma allows. An alignment with k edits stays within k + 1 neighbouring diagonals and keeps at least
m + 1 - Q - k * Q of the item's character q-grams. So the hits of a document's q-grams in the item are counted in bands of
2 (k + 1) diagonals that overlap by half, every band with that many distinct q-grams of the item is retained, and an
alignment confined to the band verifies it. Nothing within k edits is missed, and only verified items are reported.

Documents are scanned where they are read, without an exchange. The benchmark's distinct items are sent to the tasks in
portions of about PORTION characters, one scan of the documents each; a portion outgrows that only by a single longer item.

Items shorter than Q characters have no q-gram and allow no edit: an automaton of them finds them as they are. Items without
any character match nothing, nor do null texts. A row without doc_id is reported without one; repeated
rows are reported each; of items with equal item_id the nearest counts. Very long texts are scanned whole. An empty table of either kind gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.blocks import FACTOR, runs
from auditloom.llm.common import chunks, materialize, rows

Q = 8
EDITS = 0.1
#: Characters of items in a portion, and bytes of text scanned at a time.
PORTION = 6_000_000
SCAN_BYTES = 1_000_000
BUCKET_BITS = 20

Item = tuple[int | None, str]
MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int64()), ("item_chars", pa.int64())])


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def aligned(item: np.ndarray, band: np.ndarray) -> np.ndarray:
    """The least edits between the item and any stretch of text inside each band: row c holds the text from the band's first
    diagonal on, as many characters as the item plus the band's width less one."""
    m, width = len(item), band.shape[1] - len(item) + 1
    d, ramp = np.zeros((len(band), width), np.int32), np.arange(width, dtype=np.int32)
    for i in range(m):
        new = d + (band[:, i : i + width] != item[i])
        new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + 1)
        d = np.minimum.accumulate(new - ramp, axis=1) + ramp
    return d.min(axis=1)


class Index:
    """q-grams of a portion of items."""

    def __init__(self, items: list[Item], edits: float = EDITS):
        known = sorted(((i, t) for i, t in ((i, normal(t)) for i, t in items) if t), key=lambda x: len(x[1]) < Q)
        long = [t for _, t in known if len(t) >= Q]
        self.ids, self.texts = [i for i, _ in known], [t for _, t in known]
        self.codes = [codes(t) for t in self.texts]
        m = np.array([len(t) for t in long], np.int64)
        self.k = np.minimum(np.floor(edits * m).astype(np.int64), (m - Q) // Q)
        self.need = m + 1 - Q - self.k * Q
        self.longest = int(m.max()) if len(m) else 0
        grams = [runs(c.astype(np.uint64) + np.uint64(1), Q) for c in self.codes[: len(long)]]
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
        at = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams]) if grams else np.zeros(0, np.int32)
        order = np.argsort(flat, kind="stable")
        self.item, self.at = item[order], at[order]
        self.grams, start, times = np.unique(flat[order], return_index=True, return_counts=True)
        self.start, self.times = start.astype(np.int32), times.astype(np.int32)
        # One of sixteen places is taken, so few other q-grams of a text are looked up.
        self.shift = np.uint64(64 - max(16, len(self.grams).bit_length() + 3))
        self.seen = np.zeros(1 << 64 - int(self.shift), bool)
        self.seen[self.grams >> self.shift] = True
        self.short: ahocorasick.Automaton | None = None
        if len(long) < len(known):
            self.short = ahocorasick.Automaton()
            for i in range(len(long), len(known)):
                self.short.add_word(self.texts[i], [*self.short.get(self.texts[i], []), i])
            self.short.make_automaton()

    def find(self, texts: list[str]) -> list[tuple[int, int, int]]:
        """(text, item, edits) of all items that the texts (in normal form) hold."""
        out = self._find(texts) if len(self.grams) and texts else []
        if self.short is not None:
            out += [(d, i, 0) for d, t in enumerate(texts) for i in {i for _, held in self.short.iter(t) for i in held}]
        return out

    def _find(self, texts: list[str]) -> list[tuple[int, int, int]]:
        arrays = [codes(t) for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
        flat = np.concatenate(arrays)
        h = runs(flat.astype(np.uint64) + np.uint64(1), Q)
        pos = np.flatnonzero(self.seen[h >> self.shift])
        g = np.minimum(np.searchsorted(self.grams, h[pos]), len(self.grams) - 1)
        doc = np.searchsorted(bounds, pos, "right") - 1
        ok = (self.grams[g] == h[pos]) & (pos + Q <= bounds[doc + 1])
        pos, g, doc = pos[ok], g[ok], doc[ok]
        hit = np.repeat(np.arange(len(pos)), self.times[g])
        entry = self.start[g][hit] + np.arange(len(hit)) - np.repeat(np.cumsum(self.times[g]) - self.times[g], self.times[g])
        item, at = self.item[entry].astype(np.int64), self.at[entry].astype(np.int64)
        # Documents are set so far apart that no band reaches into two.
        gap = self.longest * 4 + 64
        diagonal = pos[hit] + doc[hit] * gap - at + gap
        band = diagonal // (self.k[item] + 1)
        wide = int(bounds[-1] + (len(texts) + 2) * gap)
        both = np.concatenate([band, band - 1]) + np.tile(item, 2) * wide
        slot = (both.astype(np.uint64) * np.uint64(FACTOR) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        need = np.tile(self.need[item], 2)
        left = np.flatnonzero(np.bincount(slot, minlength=1 << BUCKET_BITS)[slot] >= need)
        if not len(left):
            return []
        n = len(item)
        # Distinct q-grams of the item in each band, by their places in it.
        pairs = np.unique(np.stack([both[left], at[left % n]]), axis=1)
        key, size = np.unique(pairs[0], return_counts=True)
        which = key // wide
        keep = size >= self.need[which]
        key, which = key[keep], which[keep]
        order = np.argsort(both[left], kind="stable")
        first = left[order[np.searchsorted(both[left][order], key)]] % n
        return self._verify(which, (key % wide) * (self.k[which] + 1) - gap, doc[hit[first]], gap, bounds, flat, texts)

    def _verify(self, item: np.ndarray, low: np.ndarray, doc: np.ndarray, gap: int, bounds: np.ndarray, flat: np.ndarray, texts: list[str]) -> list[tuple[int, int, int]]:
        best: dict[tuple[int, int], int] = {}
        for i in np.unique(item).tolist():
            m, k = len(self.codes[i]), int(self.k[i])
            mine = np.flatnonzero(item == i)
            rest = []
            holds = {d: self.texts[i] in texts[d] for d in set(doc[mine].tolist())}
            for c in mine.tolist():
                d = int(doc[c])
                if holds[d]:
                    best[d, i] = 0
                else:
                    rest.append(c)
            for a in range(0, len(rest), 256):
                some = np.array(rest[a : a + 256])
                where = (low[some] - doc[some] * gap)[:, None] + np.arange(m + 2 * (k + 1) - 1)
                inside = (where >= bounds[doc[some]][:, None]) & (where < bounds[doc[some] + 1][:, None])
                # 0xFFFFFFFF stands for what lies outside of the document and equals no character.
                band = np.where(inside, flat[np.clip(where, 0, len(flat) - 1)], np.uint32(0xFFFFFFFF))
                distinct, which = np.unique(band, axis=0, return_inverse=True)
                for d, e in zip(doc[some].tolist(), aligned(self.codes[i], distinct)[which.ravel()].tolist()):
                    if e <= k:
                        best[d, i] = min(e, best.get((d, i), e))
        return [(d, i, e) for (d, i), e in best.items()]


_INDEX: dict[tuple, Index] = {}


def index_of(items: list[Item]) -> Index:
    """One a worker and portion."""
    key = tuple(items)
    if key not in _INDEX:
        _INDEX.clear()
        _INDEX[key] = Index(items)
    return _INDEX[key]


def _found(text: pa.Array, index: Index) -> list[tuple[int, int, int]]:
    out = []
    for a, b in chunks(text, SCAN_BYTES):
        out += [(a + d, i, e) for d, i, e in index.find([normal(t) for t in text.slice(a, b - a).to_pylist()])]
    return out


def _scan(batches: Iterator[pa.RecordBatch], items: list[Item]) -> Iterator[pa.RecordBatch]:
    index = index_of(items)
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        best: dict[tuple, tuple[int, int]] = {}
        for d, i, e in _found(batch.column("text"), index):
            key = (d, index.ids[i])
            best[key] = min((e, len(index.codes[i])), best.get(key, (e, len(index.codes[i]))))
        found = sorted(best.items(), key=lambda x: (x[0][0], x[0][1] is not None, x[0][1] or 0))
        yield rows(MATCHES, doc_id=[ids[d] for (d, _), _ in found], item_id=[i for (_, i), _ in found], edits=[e for _, (e, _) in found], item_chars=[m for _, (_, m) in found])


def _clean(batches: Iterator[pa.RecordBatch], items: list[Item]) -> Iterator[pa.RecordBatch]:
    index = index_of(items)
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        keep[[d for d, _, _ in _found(batch.column("text"), index)]] = False
        yield batch.filter(pa.array(keep))


def portions(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The distinct items of the benchmark in portions of about PORTION characters."""
    items = materialize(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").distinct(), "items")
    n = max(1, math.ceil((items.agg(F.sum(F.length("text"))).first()[0] or 0) / PORTION))
    # Texts of one item_id stay together unless they alone are more than a portion.
    crowded = items.groupBy(F.xxhash64("item_id").alias("key")).agg(F.sum(F.length("text")).alias("size")).filter(F.col("size") > PORTION).select("key", F.lit(True).alias("crowded"))
    dealt = items.withColumn("key", F.xxhash64("item_id")).join(crowded, "key", "left")
    dealt = dealt.withColumn("portion", F.pmod(F.xxhash64("key", F.when(F.col("crowded"), F.col("text"))), F.lit(n)))
    for p in range(n):
        yield [(r["item_id"], r["text"]) for r in dealt.filter(F.col("portion") == p).orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, item_chars: a row for each item that a document holds."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for items in portions(benchmark):
        part = texts.mapInArrow(lambda it, items=items: _scan(it, items), "doc_id long, item_id long, edits long, item_chars long")
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all columns) that hold no item."""
    for items in portions(benchmark):
        docs = docs.mapInArrow(lambda it, items=items: _clean(it, items), docs.schema)
    return docs
