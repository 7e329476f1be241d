"""Fingerprints of documents as homomorphic multiset hashes of their paragraphs.

A paragraph (a run without line ends) hashes to a wide vector, and a document's fingerprint is the sum of its paragraphs'
vectors, lane by lane, modulo powers of two. So the order of paragraphs does not matter, equal multisets of paragraphs have
equal fingerprints, and a paragraph is inserted or deleted by adding or subtracting its vector (``updated``), without the rest of the text.

* ``STRONG`` lanes modulo 2^64 are the paragraph's BLAKE2b digest: they tell different multisets apart.
* ``LANES`` lanes modulo 2^16 hold, for each run of three words of the paragraph (shorter paragraphs: all words), +1 or -1 in one
  lane, both by hash. Their cosine estimates the share of common phrases, with a standard deviation of about 1 / 16.

Likeness is 1 for equal fingerprints, else that cosine, at least 0; it is 0 if either has no words. A lane that passes 2^15 (a
line repeated more than 32,000 times) wraps: likeness is then off, equality never.

``report`` sets each document beside the next by ascending doc_id. Documents are dealt by ranges whose first keys exist in the
table; the first document of a range goes to the range before as well, so one exchange of texts serves and no text passes
the driver, which holds a key a range (as many as tasks). Ranges are streamed in order, so their size is no matter of memory.

Null text is empty: its fingerprint is zero. Null ids stand first (as the smallest long). Rows of one doc_id stand in the order of a hash of their texts;
equal rows are each other's next, and where they are more than two blocks of text they are counted and moved once. Very long texts are held whole in one task. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.blocks import Words, folded, measured, mixed, runs
from auditloom.llm.common import chunks, shuffle_partitions

STRONG, LANES, SHINGLE = 8, 256, 3
WIDTH = STRONG * 8 + LANES * 2
#: Bytes of text of a range, about.
RANGE_BYTES = 64_000_000
LEAST_ID = -(2**63)

OUT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
STATE = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.binary())])


def paragraphs(text: str | None) -> list[bytes]:
    return [p for p in text.encode().replace(b"\r", b"\n").split(b"\n") if p] if text else []


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of rows from each bound to the next, modulo 2^64."""
    total = np.concatenate([np.zeros((1, values.shape[1]), values.dtype), np.cumsum(values, axis=0, dtype=values.dtype)])
    return total[bounds[1:]] - total[bounds[:-1]]


def fingerprints(texts: list[list[bytes]]) -> np.ndarray:
    """A row of WIDTH bytes for each list of paragraphs."""
    every = [p for t in texts for p in t]
    bounds = np.cumsum([0, *map(len, texts)])
    digests = b"".join([hashlib.blake2b(p, digest_size=STRONG * 8).digest() for p in every])
    strong = _sums(np.frombuffer(digests, "<u8").reshape(-1, STRONG), bounds)
    w = Words([p.split() for p in every])
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))  # of a paragraph
    size = np.diff(w.bounds)
    h = w.hashes[w.ids]
    left = np.repeat(w.bounds[1:], size) - np.arange(len(h))  # words of the paragraph from here on
    at = np.flatnonzero(left >= SHINGLE)
    short = np.flatnonzero((size > 0) & (size < SHINGLE))
    start = w.bounds[short]
    pairs = h[start] + np.where(size[short] == 2, h[np.minimum(start + 1, max(0, len(h) - 1))] * np.uint64(3), np.uint64(0)) if len(short) else np.zeros(0, np.uint64)
    features = np.concatenate([runs(h, SHINGLE)[at], mixed(pairs)])
    of = np.concatenate([np.repeat(doc, size)[at], doc[short]])
    lane = (features >> np.uint64(56)).astype(np.int64) % LANES
    sign = 1 - 2 * (features & np.uint64(1)).astype(np.int64)
    lanes = np.bincount(of * LANES + lane, weights=sign, minlength=len(texts) * LANES).astype(np.int64).reshape(-1, LANES)
    return packed(strong, lanes)


def packed(strong: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    return np.concatenate([np.ascontiguousarray(strong.astype("<u8")).view(np.uint8), np.ascontiguousarray((lanes & 0xFFFF).astype("<u2")).view(np.uint8)], axis=1)


def unpacked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(strong, lanes) of fingerprints; lanes are signed."""
    rows = np.ascontiguousarray(rows)
    return np.ascontiguousarray(rows[:, : STRONG * 8]).view("<u8"), np.ascontiguousarray(rows[:, STRONG * 8 :]).view("<i2").astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = (unpacked(r)[1].astype(np.float64) for r in (a, b))
    norm = np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
    near = np.clip((x * y).sum(axis=1) / np.where(norm == 0, 1, norm), 0, 1)
    return np.where((a == b).all(axis=1), 1.0, near)


def _state(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for a, z in chunks(text):
            made = fingerprints([paragraphs(t) for t in text.slice(a, z - a).to_pylist()])
            yield pa.record_batch([batch.column("doc_id").slice(a, z - a), pa.array([r.tobytes() for r in made], pa.binary())], schema=STATE)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (binary), where texts are read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_state, "doc_id long, fingerprint binary")


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a document and batch: the sum of its changes."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        strong, lanes = unpacked(fingerprints([paragraphs(t) for t in batch.column("paragraph").to_pylist()]))
        times = batch.column("times").to_numpy(zero_copy_only=False).astype(np.int64)[:, None]
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1])) if len(ids) else np.zeros(0, np.int64)
        bounds = np.append(starts, len(ids))
        made = packed(_sums((strong * times.astype(np.uint64))[order], bounds), _sums((lanes * times)[order], bounds))
        yield pa.record_batch([pa.array(ids[order][starts], pa.int64()), pa.array([r.tobytes() for r in made], pa.binary())], schema=STATE)


def _added(rows: pa.Table) -> pa.Table:
    strong, lanes = unpacked(np.frombuffer(b"".join(rows["fingerprint"].to_pylist()), np.uint8).reshape(-1, WIDTH))
    made = packed(strong.sum(axis=0, dtype=np.uint64, keepdims=True), lanes.sum(axis=0, keepdims=True))
    return pa.table([rows["doc_id"][:1].combine_chunks(), pa.array([made.tobytes()], pa.binary())], schema=STATE)


def updated(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Fingerprints after changes (doc_id, paragraph, times: how often it is inserted, negative where it is deleted). Documents
    that state does not have are new. Rows without doc_id, paragraph or times change nothing. Batches send one sum a document."""
    sound = changes.select(F.col("doc_id").cast("long").alias("doc_id"), "paragraph", F.col("times").cast("long").alias("times")).dropna()
    sums = sound.mapInArrow(_changes, "doc_id long, fingerprint binary")
    return state.select("doc_id", "fingerprint").unionByName(sums).groupBy("doc_id").applyInArrow(_added, "doc_id long, fingerprint binary")


def _ranges(sizes: DataFrame) -> list[tuple[int, int]]:
    """The first keys (id, key) of ranges of about equal numbers of distinct keys, ascending; they begin with the least of all."""
    n = max(2 * shuffle_partitions(sizes.sparkSession), math.ceil((sizes.agg(F.sum("bytes")).first()[0] or 0) / RANGE_BYTES))
    keys = sizes.select(F.coalesce("doc_id", F.lit(LEAST_ID)).alias("id"), "key").distinct().repartitionByRange(n, "id", "key")
    firsts = keys.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.min(F.struct("id", "key")).alias("first"))
    return sorted(tuple(r["first"]) for r in firsts.collect())


def _targets(firsts: list[tuple[int, int]]) -> Column:
    """Where a row goes: its range (role 0) and, for a range's first, the one before (role 1), the first of all to the last."""
    ids = np.array([i for i, _ in firsts], np.int64)
    position = {f: k for k, f in enumerate(firsts)}

    @F.pandas_udf("array<long>")
    def target(id_: pd.Series, key: pd.Series) -> pd.Series:
        at = np.searchsorted(ids, id_.to_numpy(np.int64), "right") - 1
        out = [[2 * a] for a in at.tolist()]
        for i in np.flatnonzero(ids[at] == id_.to_numpy(np.int64)).tolist():
            row = (int(id_[i]), int(key[i]))
            out[i] = [2 * ((bisect_right(firsts, row) - 1) % len(firsts))]
            if row in position:
                out[i].append(2 * ((position[row] - 1) % len(firsts)) + 1)
        return pd.Series(out)

    return target("id", "key")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; what comes after a row (and its fingerprint) is known once the next is there."""
    last: tuple | None = None
    for batch in batches:
        to, ids, copies = (batch.column(c).to_pylist() for c in ("to", "doc_id", "copies"))
        text = batch.column("text")
        for a, z in chunks(text):
            texts = [t or "" for t in text.slice(a, z - a).to_pylist()]
            made = fingerprints([paragraphs(t) for t in texts])
            rows = ([last] if last else []) + [(to[i], ids[i], copies[i], t, f) for i, t, f in zip(range(a, z), texts, made)]
            last = rows[-1]
            yield _edited(rows)


def _edited(rows: list[tuple]) -> pa.RecordBatch:
    own, after = [], []
    for row, following in zip(rows[:-1], rows[1:]):
        if row[0] & 1:
            continue  # the next range's first
        if row[0] >> 1 != following[0] >> 1:
            raise ValueError("a range has lost the row that follows it")
        own += [row] * row[2]
        after += [row] * (row[2] - 1) + [following]
    if not own:
        return pa.record_batch([pa.array([], f.type) for f in OUT], schema=OUT)
    edited = [r[3][: len(r[3]) - len(r[3]) // 2] + n[3][: len(r[3]) // 2] for r, n in zip(own, after)]
    mine, theirs, changed = np.stack([r[4] for r in own]), np.stack([r[4] for r in after]), fingerprints([paragraphs(t) for t in edited])
    return pa.record_batch([
        pa.array([r[1] for r in own], pa.int64()), pa.array([len(r[3]) for r in own], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        pa.array([r.tobytes().hex() for r in mine]), pa.array([r.tobytes().hex() for r in changed]), pa.array(likeness(mine, changed)), pa.array(likeness(mine, theirs)),
    ], schema=OUT)


def report(docs: DataFrame) -> DataFrame:
    """Per document: n_chars, the digest of its edited text (the last half replaced by the beginning of the next document), both
    fingerprints in hexadecimal, and the likeness of its own to the edited one's and to the next document's."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = measured(docs, "doc_id", "text")
    firsts = _ranges(sizes)
    docs, _ = folded(docs, sizes, "doc_id", "text")
    keyed = docs.withColumn("id", F.coalesce("doc_id", F.lit(LEAST_ID))).withColumn("key", F.xxhash64("doc_id", "text"))
    sent = keyed.withColumn("to", F.explode(_targets(firsts))).withColumn("range", F.shiftright("to", 1))
    dealt = sent.repartition("range").sortWithinPartitions("range", "to", "id", "key").select("to", "doc_id", "copies", "text")
    return dealt.mapInArrow(_pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
