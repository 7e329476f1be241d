r"""Chat formatting by columnar byte assembly, and reading back.

A turn is ``<s>[INST]role[/INST]text</s>``; a conversation is its turns joined. Inside roles and texts every control string
(``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), with any number of backslashes after its first character, gets one more there;
reading removes one. So control strings never occur inside texts, and texts come back as they were.

The turns of a conversation come together in order of turn (then role, text). Per batch of turns the lengths of all
segments are summed into offsets, and constants, roles and texts are scattered from their Arrow buffers to their places in
one preallocated buffer, which is the output column. The loss mask is the spans of the assistants' texts, in code points of
the formatted text, as starts and ends in turn.

Null text or role: empty. Null conv_id: one conversation of its own. Repeated rows are turns of their own; other columns are
not read. A conversation is a value of the result, so one task holds the longest one and no more than a batch besides;
one beyond 2 GiB is an error. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import rows

OPEN, MIDDLE, CLOSE = b"<s>[INST]", b"[/INST]", b"</s>"
ASSISTANT = "assistant"
#: What the offsets of one batch reach.
MOST_BYTES = 2**31 - 1
ESCAPE = (r"([<\[])(\\*)(/?s>|/?INST\])", r"\1\\\2\3")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)

FORMATTED = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.int64()))])
FORMATTED_DDL = "conv_id long, formatted string, loss_spans array<long>"


def escaped(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(column, ""), ESCAPE[0], ESCAPE[1])


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text) if "\\" in text else text


def scatter(buffer: np.ndarray, at: np.ndarray, column: pa.Array) -> None:
    """Copy each value's bytes to its place."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return
    source = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    shift = np.repeat(at - (offsets[:-1] - offsets[0]), np.diff(offsets))
    buffer[shift + np.arange(len(source))] = source


def assemble(turns: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    """turns in order; begins: the first row of each conversation. As many batches as offsets of 32 bits need; a single
    conversation beyond them is an error."""
    role = escaped(turns["role"].combine_chunks()).cast(pa.large_string())
    text = escaped(turns["text"].combine_chunks()).cast(pa.large_string())
    n = turns.num_rows
    sizes = np.empty((n, 5), np.int64)
    sizes[:, 0], sizes[:, 2], sizes[:, 4] = len(OPEN), len(MIDDLE), len(CLOSE)
    sizes[:, 1], sizes[:, 3] = pc.binary_length(role).to_numpy(), pc.binary_length(text).to_numpy()
    ends = np.cumsum(sizes.ravel()).reshape(n, 5)
    starts = ends - sizes
    if ends[-1, 4] > MOST_BYTES:
        if len(begins) == 1:
            raise ValueError("a formatted conversation of more than 2 GiB does not fit a string")
        half = len(begins) // 2
        yield from assemble(turns.slice(0, int(begins[half])), begins[:half])
        yield from assemble(turns.slice(int(begins[half])), begins[half:] - begins[half])
        return
    buffer = np.empty(int(ends[-1, 4]), np.uint8)
    for k, constant in ((0, OPEN), (2, MIDDLE), (4, CLOSE)):
        buffer[starts[:, k][:, None] + np.arange(len(constant))] = np.frombuffer(constant, np.uint8)
    scatter(buffer, starts[:, 1], role)
    scatter(buffer, starts[:, 3], text)
    offsets = np.append(starts[begins, 0], ends[-1, 4]).astype(np.int32)
    formatted = pa.Array.from_buffers(pa.string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(buffer)])
    chars = sizes.copy()
    chars[:, 1], chars[:, 3] = pc.utf8_length(role).to_numpy(), pc.utf8_length(text).to_numpy()
    stops = np.cumsum(chars.ravel()).reshape(n, 5)
    base = np.repeat((stops - chars)[begins, 0], np.diff(np.append(begins, n)))
    spans = np.stack([stops[:, 3] - chars[:, 3] - base, stops[:, 3] - base], axis=1)
    loss = pc.fill_null(pc.equal(turns["role"].combine_chunks(), ASSISTANT), False).to_numpy(zero_copy_only=False)
    per = np.add.reduceat(loss.astype(np.int64), begins) * 2
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(spans[loss].ravel()))
    yield rows(FORMATTED, conv_id=turns["conv_id"].combine_chunks().take(pa.array(begins)), formatted=formatted, loss_spans=lists)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    last = object()
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id")
        first, final = ids[0].as_py(), ids[-1].as_py()
        if first == final == last:
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        begins = _begins(table)
        if len(begins) > 1:
            yield from assemble(table.slice(0, int(begins[-1])).combine_chunks(), begins[:-1])
        held, last = table.slice(int(begins[-1])).to_batches(), final
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from assemble(table, _begins(table))


def _begins(table: pa.Table) -> np.ndarray:
    ids = table["conv_id"].combine_chunks()
    v, null = pc.fill_null(ids, 0).to_numpy(), pc.is_null(ids).to_numpy(zero_copy_only=False)
    return np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (null[1:] != null[:-1])]))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans: one row a conversation."""
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED_DDL)


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def parse(formatted: str) -> list[tuple[str, str]]:
    """role, text of each turn."""
    return [(unescaped(r), unescaped(t)) for r, t in _TURN.findall(formatted)]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for batch in batches:
        out = []
        for conv, text, spans in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
            turns = parse(text)
            loss = "".join(unescaped(text[a:b]) for a, b in zip(spans[::2], spans[1::2]))
            out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(text)))
        yield pa.record_batch([pa.array([r[i] for r in out], f.type) for i, f in enumerate(DIGEST)], schema=DIGEST)


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back."""
    return formatted.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: DuckDB's way to the same rows; the two turns of conversation -1 are added as in the query.
SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS r,
    regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS x
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + length(r) + length(x)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
