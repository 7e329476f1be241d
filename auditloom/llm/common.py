"""Shared helpers: materialisation in the cluster's shared folder, table reads, word rules, streams of sorted groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize, shared_dir  # noqa: F401

#: Texts are worked on in groups of about so many bytes.
CHUNK_BYTES = 4_000_000
#: Words are maximal runs of other characters than blank and U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def words_of(text: str | None) -> list[bytes]:
    """bytes.split() splits at exactly blank and U+0009 to U+000D."""
    return text.encode().split() if text else []


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the consecutive rows with equal keys (integers) in a partition sorted by them; a group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ks = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = [0, *(np.flatnonzero((ks[:, 1:] != ks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            key = tuple(ks[:, a].tolist())
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else columns[f.name] for f in schema], schema=schema)


def chunks(text: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes of text each; a longer text has a range of its own."""
    lengths = np.nan_to_num(pc.binary_length(text).to_numpy(zero_copy_only=False).astype(float))
    total = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        base = total[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + most, "right")))
        yield a, b
        a = b
