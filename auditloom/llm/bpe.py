"""BPE encoding and decoding of whole texts, with tree concatenation of long text that the pre-tokenizer does not split.

Byte-pair merging is local: a sequence of tokens is the encoding of its text exactly if every two neighbours are the
encoding of their joined text. Two encodings that share a token at the same place can therefore be spliced there. An
unsplit pre-token of more than ``LEAF`` bytes is halved until its leaves are shorter; leaves are encoded in parallel, as
rows of their own; then neighbours are joined up the tree: a window of a few tokens left and right of the join is encoded
anew and grown until its first token stands in the left side's encoding and its last one in the right side's, at the same
places. Everything between these two is taken from the window.

Null text counts as empty. Every row gives a row; repeated rows and null ids are kept. Strings of added tokens in a text
become their ids, as in the library. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import chunks, materialize, rows
from auditloom.llm.tokenization import byte_alphabet, encoder

#: Bytes of unsplit text above which it is halved.
LEAF = 4096
#: The public pre-token rule of this vocabulary.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PRETOKEN = regex.compile(PRETOKEN)
_LETTERS = {b: c for c, b in byte_alphabet().items()}


def halves(size: int, leaf: int) -> list[tuple[int, int]]:
    """Leaf ranges of a range of bytes halved until no half is longer than leaf, in order."""
    parts = [(0, size)]
    while any(b - a > leaf for a, b in parts):
        parts = [p for a, b in parts for p in ([(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > leaf else [(a, b)])]
    return parts


class UnsplitEncoder:
    """Merges over bytes, without pre-tokenization, and their concatenation."""

    def __init__(self, path: str):
        self.enc = encoder(path)

    def leaf(self, data: bytes) -> list[int]:
        return [t.id for t in self.enc.tok.model.tokenize("".join(map(_LETTERS.__getitem__, data)))]

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.enc.token_bytes.__getitem__, ids))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of both sides' text."""
        if not left or not right:
            return left + right
        k = 4
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            window = self.leaf(self.text(left[-a:] + right[:b]))
            # A side that is in the window as a whole needs no common token there.
            ok_left = a == len(left) or window[0] == left[-a]
            ok_right = b == len(right) or window[-1] == right[b - 1]
            if ok_left and ok_right and (len(window) > 1 or a == len(left) or b == len(right)):
                return left[: len(left) - a] + window + right[b:]
            k *= 2

    def tree(self, leaves: list[list[int]]) -> list[int]:
        while len(leaves) > 1:
            leaves = [self.join(*leaves[i : i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
        return leaves[0] if leaves else []


PART = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int64()), ("leaf", pa.int64()), ("data", pa.binary()), ("ids", pa.binary()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
PART_DDL = "row long, doc_id long, piece long, leaf long, data binary, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(enc, raw: bytes) -> tuple[int, str, str]:
    """Number of ids, sha256 of the decimal ids joined by commas, sha256 of the decoded text."""
    ids = np.frombuffer(raw, enc.dtype).tolist()
    return len(ids), hashlib.sha256(b",".join(map(enc.decimal.__getitem__, ids))).hexdigest(), hashlib.sha256(enc.decode(ids).encode()).hexdigest()


def cut(text: str, added: list[str], leaf: int = LEAF) -> list[str | bytes] | None:
    """The text as strings to encode as they are and, as bytes, unsplit pre-tokens above leaf; None if it has none of those."""
    if len(text) * 4 <= leaf:
        return None
    out: list[str | bytes] = []
    spans = regex.split("(" + "|".join(map(regex.escape, added)) + ")", text) if added else [text]
    for i, span in enumerate(spans):
        if i % 2:
            out.append(span)
            continue
        at = last = 0
        for m in _PRETOKEN.finditer(span):
            if m.end() - m.start() > leaf // 4 and len(data := m[0].encode()) > leaf:
                # White space before it stays a pre-token of its own only if the text goes on after it, so it is cut off.
                cuts = [at, max(at, last), m.start()] if span[last : m.start()].isspace() else [at, m.start()]
                out += [span[p:q] for p, q in zip(cuts, cuts[1:]) if q > p]
                out.append(data)
                at = m.end()
            last = m.start()
        if at < len(span):
            out.append(span[at:])
    return out if any(isinstance(x, bytes) for x in out) else None


def has_long_run(text: str, chars: int) -> bool:
    """Whether so many characters may stand without white space, or of white space, in a row."""
    words = text.split()
    return max(map(len, words), default=0) >= chars or len(text) - sum(map(len, words)) - len(words) >= chars


def _first_pass(batches: Iterator[pa.RecordBatch], path: str, leaf: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        for a, b in chunks(batch.column("text")):
            texts = [t or "" for t in batch.column("text").slice(a, b - a).to_pylist()]
            ids = batch.column("doc_id").slice(a, b - a).to_pylist()
            nos = batch.column("row").slice(a, b - a).to_pylist()
            cuts = [cut(t, enc.added, leaf) if has_long_run(t, leaf // 4) else None for t in texts]
            plain = [i for i, c in enumerate(cuts) if c is None]
            found = [digests(enc, raw) for raw in enc.encode([texts[i] for i in plain])]
            n = len(plain)
            yield rows(PART, row=[nos[i] for i in plain], doc_id=[ids[i] for i in plain], piece=[None] * n, leaf=[None] * n, data=[None] * n, ids=[None] * n, n_tokens=[x[0] for x in found], ids_sha256=[x[1] for x in found], decoded_sha256=[x[2] for x in found])
            for i, c in enumerate(cuts):
                for piece, x in enumerate(c or ()):
                    parts = [(None, x.encode())] if isinstance(x, str) else [(k, x[p:q]) for k, (p, q) in enumerate(halves(len(x), leaf))]
                    m = len(parts)
                    yield rows(PART, row=[nos[i]] * m, doc_id=[ids[i]] * m, piece=[piece] * m, leaf=[k for k, _ in parts], data=[d for _, d in parts], ids=[None] * m, n_tokens=[None] * m, ids_sha256=[None] * m, decoded_sha256=[None] * m)


def _encode_leaves(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    enc, unsplit = encoder(path), UnsplitEncoder(path)
    for batch in batches:
        data, leaf = batch.column("data").to_pylist(), batch.column("leaf").to_pylist()
        ids = [enc.encode([d.decode()])[0] if k is None else np.asarray(unsplit.leaf(d), enc.dtype).tobytes() for d, k in zip(data, leaf)]
        yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary())).set_column(batch.schema.get_field_index("data"), "data", pa.nulls(len(ids), pa.binary()))


def _join_group(group: pa.Table, path: str) -> pa.Table:
    enc, unsplit = encoder(path), UnsplitEncoder(path)
    by_piece: dict[int, list] = {}
    for piece, leaf, raw in zip(group["piece"].to_pylist(), group["leaf"].to_pylist(), group["ids"].to_pylist()):
        by_piece.setdefault(piece, []).append((-1 if leaf is None else leaf, np.frombuffer(raw, enc.dtype).tolist()))
    ids = [x for piece in sorted(by_piece) for x in unsplit.tree([ids for _, ids in sorted(by_piece[piece], key=lambda p: p[0])])]
    n, ids_sha, text_sha = digests(enc, np.asarray(ids, enc.dtype).tobytes())
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return pa.table([pa.array([group["doc_id"][0].as_py()], pa.int64()), pa.array([n], pa.int64()), [ids_sha], [text_sha]], schema=schema)


def encode_decode(docs: DataFrame, tokenizer: str, leaf: int = LEAF) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Texts are encoded where they are read, without an exchange. Only those with unsplit text above leaf bytes go on as rows
    of leaves, dealt over all tasks, encoded, and joined one document at a time (its own ids are all a task holds)."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    first = materialize(numbered.mapInArrow(lambda it: _first_pass(it, tokenizer, leaf), PART_DDL), "bpe")
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    leaves = first.filter(F.col("piece").isNotNull()).repartition("row", "piece", "leaf").mapInArrow(lambda it: _encode_leaves(it, tokenizer), PART_DDL)
    joined = leaves.groupBy("row").applyInArrow(lambda t: _join_group(t, tokenizer), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return first.filter(F.col("piece").isNull()).select(*columns).unionByName(joined.select(*columns))
