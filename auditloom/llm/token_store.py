"""Token ids in a keyed binary format: shards of raw id payloads, each with a minimal perfect hash index.

Format: a Parquet table (any store that Spark writes will do), uncompressed, one row a shard of about ``SHARD_BYTES``:
part and first_token (where the shard stands: ids of the part before it), n_tokens, width (bytes an id), first_key and
last_key, keys (int64, a row a document), nulls (row numbers of null keys), offsets (int64, in ids, one more than
documents), payload (the ids, little-endian, documents in ascending key order), levels, bits, ranks, spill and
fingerprints (the index). ``parts`` beside it has the ids of each part.

The index maps a key to the row of its first document: keys hash into a bit array of their number; positions that exactly
one key takes are set and the others go on to the next, smaller array. A key's slot is the rank of its bit over all arrays,
so n distinct keys fill n slots. A slot holds 32 other bits of the key's hash, so foreign keys are told apart but for a
chance of 2**-32, and the stored key settles that. A lookup reads a few words, whatever the number of keys.

Null text: no ids but the end id. Null keys stand first and are read by ``get(None)``. Rows of equal keys (ordered by text)
follow each other and are all returned. Other columns are not read. An empty table makes no shard. Very long texts are encoded in pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditloom.llm.common import chunks, rows
from auditloom.llm.tokenization import encoder

SHARD_BYTES = 8 << 20
LEVELS = 24
#: Characters of the text by which rows of one id are dealt into ranges.
PREFIX = 64
#: Texts are encoded in groups of about so many bytes: the more, the fewer distinct pieces in all.
ENCODE_BYTES = 10_000_000

SHARD_SCHEMA = pa.schema([
    ("part", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()),
    ("first_key", pa.int64()), ("last_key", pa.int64()), ("keys", pa.binary()), ("nulls", pa.int64()), ("offsets", pa.binary()),
    ("payload", pa.binary()), ("levels", pa.binary()), ("bits", pa.binary()), ("ranks", pa.binary()), ("slots", pa.binary()),
    ("spill", pa.binary()), ("fingerprints", pa.binary()),
])
SHARD_DDL = (
    "part int, first_token long, n_tokens long, width int, first_key long, last_key long, keys binary, nulls long, offsets binary, "
    "payload binary, levels binary, bits binary, ranks binary, slots binary, spill binary, fingerprints binary"
)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) of int64 keys."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class PerfectIndex:
    """A minimal perfect hash of distinct int64 keys with a fingerprint and a value a slot."""

    def __init__(self, levels: np.ndarray, bits: np.ndarray, ranks: np.ndarray, slots: np.ndarray, spill: np.ndarray, fingerprints: np.ndarray):
        self.levels, self.bits, self.ranks, self.slots, self.spill, self.fingerprints = levels, bits, ranks, slots, spill, fingerprints

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> PerfectIndex:
        sizes, sets, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-len(left) // 64) * 64)
            at = (mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            sets.append(alone)
            left = left[~alone[at]]
        flat = np.concatenate(sets) if sets else np.zeros(0, bool)
        bits = np.packbits(flat, bitorder="little").view("<u8") if len(flat) else np.zeros(0, "<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype("<i8")
        out = cls(np.array(sizes, "<i8"), bits, ranks, np.zeros(len(keys), "<i8"), np.sort(left).astype("<i8"), np.zeros(len(keys), "<u4"))
        at = out.slot(keys)
        assert len(np.unique(at)) == len(keys)
        out.slots[at] = values
        out.fingerprints[at] = out.fingerprint(keys)
        return out

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """-1 where no array has the key's bit."""
        out, base = np.full(len(keys), -1, np.int64), 0
        for level, size in enumerate(self.levels.tolist()):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                return out
            at = (mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[open_[hit]] = (self.ranks[at >> 6] + below)[hit]
            base += size
        if len(self.spill):
            open_ = np.flatnonzero(out < 0)
            i = np.minimum(np.searchsorted(self.spill, keys[open_]), len(self.spill) - 1)
            hit = self.spill[i] == keys[open_]
            out[open_[hit]] = self.ranks[-1] + i[hit]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for keys whose fingerprint differs."""
        at = self.slot(keys)
        ok = at >= 0
        ok[ok] = self.fingerprints[at[ok]] == self.fingerprint(keys[ok])
        out = np.full(len(keys), -1, np.int64)
        out[ok] = self.slots[at[ok]]
        return out


class Shard:
    """Keyed access to one row of the shard table."""

    def __init__(self, row: dict):
        self.keys = np.frombuffer(row["keys"], "<i8")
        self.nulls = row["nulls"]
        self.offsets = np.frombuffer(row["offsets"], "<i8")
        self.width = row["width"]
        self.payload = memoryview(row["payload"])
        kinds = {"levels": "<i8", "bits": "<u8", "ranks": "<i8", "slots": "<i8", "spill": "<i8", "fingerprints": "<u4"}
        self.index = PerfectIndex(**{k: np.frombuffer(row[k], v) for k, v in kinds.items()})

    def row_of(self, keys: np.ndarray) -> np.ndarray:
        """The first row of each key, or -1."""
        at = self.index.find(keys)
        ok = at >= 0
        ok[ok] = self.keys[at[ok]] == keys[ok]
        return np.where(ok, at, -1)

    def ids(self, row: int) -> np.ndarray:
        a, b = int(self.offsets[row]) * self.width, int(self.offsets[row + 1]) * self.width
        return np.frombuffer(self.payload[a:b], f"<u{self.width}")

    def get(self, key: int | None) -> list[np.ndarray]:
        """The ids of every document of the key."""
        if key is None:
            return [self.ids(i) for i in range(self.nulls)]
        at, out = int(self.row_of(np.array([key], np.int64))[0]), []
        while 0 <= at < len(self.keys) and self.keys[at] == key:
            out.append(self.ids(at))
            at += 1
        return out


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    if end_id >= 1 << 8 * enc.dtype.itemsize:
        raise ValueError("the end id does not fit the id width")
    end, width, part = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize, TaskContext.get().partitionId()
    keys: list[int | None] = []
    ids: list[bytes] = []
    size = before = 0

    def flush() -> pa.RecordBatch:
        nonlocal size, before
        nulls = sum(k is None for k in keys)
        ks = np.array([0 if k is None else k for k in keys], "<i8")
        offsets = np.concatenate([[0], np.cumsum([len(x) // width for x in ids])]).astype("<i8")
        distinct, first = np.unique(ks[nulls:], return_index=True)
        index = PerfectIndex.build(distinct, first + nulls)
        known = ks[nulls:]
        values = {"part": part, "first_token": before, "n_tokens": int(offsets[-1]), "width": width, "first_key": int(known[0]) if len(known) else None,
                  "last_key": int(known[-1]) if len(known) else None, "keys": ks.tobytes(), "nulls": nulls, "offsets": offsets.tobytes(), "payload": b"".join(ids)}
        values |= {k: getattr(index, k).tobytes() for k in ("levels", "bits", "ranks", "slots", "spill", "fingerprints")}
        before += int(offsets[-1])
        keys.clear()
        ids.clear()
        size = 0
        return rows(SHARD_SCHEMA, **{k: [v] for k, v in values.items()})

    for batch in batches:
        for a, b in chunks(batch.column("text"), ENCODE_BYTES):
            data, at = enc.column(batch.column("text").slice(a, b - a))
            for k, p, q in zip(batch.column("doc_id").slice(a, b - a).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                keys.append(k)
                ids.append(bytes(data[p:q]) + end)
                size += len(ids[-1])
                if size >= SHARD_BYTES:
                    yield flush()
    if keys:
        yield flush()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode whole texts and write the shard table at path, documents in ascending doc_id order over parts and shards.

    One range exchange of the texts; each task encodes and writes its own range, shard by shard. Ranges go by id and the first
    characters of the text, so that an id of many rows, null among them, is spread; rows are streamed, never held."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranged = texts.repartitionByRange("doc_id", F.substring("text", 1, PREFIX)).sortWithinPartitions("doc_id", "text")
    shards = ranged.mapInArrow(lambda it: _encode(it, tokenizer, end_id), SHARD_DDL)
    shards.write.option("compression", "none").option("parquet.enable.dictionary", "false").parquet(f"{path}/shards")
    spark = docs.sparkSession
    parts = spark.read.parquet(f"{path}/shards").groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    # A row a part: as many as tasks wrote, never as documents.
    parts.select("part", (F.sum("part_tokens").over(Window.orderBy("part")) - F.col("part_tokens")).alias("part_start")).write.parquet(f"{path}/parts")


DIGEST_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            known = shard.keys[shard.nulls :]
            first = shard.row_of(known)  # each key through the index; equal keys follow their first row
            again = np.arange(len(known)) - np.searchsorted(known, known, "left")
            order = [*range(shard.nulls), *(first + again).tolist()]
            crc = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in order]
            at = shard.offsets[order] if order else np.zeros(0, np.int64)
            yield rows(DIGEST_SCHEMA, doc_id=[None] * shard.nulls + known.tolist(), part=[row["part"]] * len(order), at=at + row["first_token"], n_tokens=shard.offsets[np.array(order, int) + 1] - at, ids_crc32=crc)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read through the index: doc_id, start, n_tokens, ids_crc32."""
    found = spark.read.parquet(f"{path}/shards").mapInArrow(_digest, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return found.join(spark.read.parquet(f"{path}/parts"), "part").select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def documents_of(spark: SparkSession, path: str, key: int) -> DataFrame:
    """part, first_token, row, ids: the documents of one key in order; Parquet statistics leave the shards whose range holds it."""
    found = spark.read.parquet(f"{path}/shards").filter(F.col("first_key").isNotNull() & (F.col("first_key") <= key) & (F.col("last_key") >= key))

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for k, ids in enumerate(Shard(row).get(key)):
                    yield pa.record_batch([pa.array([row["part"]], pa.int32()), pa.array([row["first_token"]], pa.int64()), pa.array([k], pa.int64()), pa.array([ids.tolist()], pa.list_(pa.int64()))], names=["part", "first_token", "row", "ids"])

    return found.mapInArrow(get, "part int, first_token long, row long, ids array<long>").orderBy("part", "first_token", "row")


def lookup(spark: SparkSession, path: str, key: int) -> list[list[int]]:
    """The ids of each document of a key of few rows; documents_of has those of any key as a table."""
    return [r["ids"] for r in documents_of(spark, path, key).collect()]
