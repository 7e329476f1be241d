"""Removal of passages that occur earlier, by repeated-phrase automata.

A window is WINDOW consecutive words of one document. Documents are dealt into blocks by ranges of doc_id, so that earlier
blocks hold earlier documents.

1. Confirm: each block sends the keys of its distinct windows (a 64-bit hash of the word sequence) once to the parts of the
   key space, which answer for each whether it recurs anywhere and, if so, whether this block is the first to have it.
2. Compile: each block, the shard here, picks from every recurring passage of its own phrases of PHRASE words (of each window
   the one with the least hash) and compiles them into an Aho-Corasick automaton over word numbers.
3. Stream: all of the block's documents run through its automaton. Around each hit the windows that hold the phrase are looked
   up among the recurring ones and compared with them word by word, which within a block settles what hashes leave open: one of a
   window that an earlier block has is a repeat, and so are all but the first of a window that no earlier block has. That a
   window recurs in another block rests on its 64-bit hash; the automaton finds the places of it, it rules none of them out.

A shard's automaton has what its own documents can meet, so each document is streamed once and memory is bounded by the
block, whatever the corpus. Windows are judged on the input. Null text has no words; fewer than WINDOW words are kept as
they are. Null ids count as smaller than all. Rows of equal doc_id stand in the order of their texts; of repeated rows the
first is the earlier one. An id of more than two blocks of text is dealt into blocks by text, its repeated rows counted and
moved once. Very long texts are whole in one block, which then is larger. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.blocks import Words, cut_parts, extent, folded, measured, packed, range_block, runs, unpacked
from auditloom.llm.common import materialize, words_of

WINDOW = 20
PHRASE = 8

#: A window's answer: it occurs once; it recurs and is first in this block; it recurs and an earlier block has it.
ONCE, FIRST_HERE, EARLIER = 0, 1, 2

SENT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("again", pa.binary())])
ANSWER = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("flags", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    k = 1
    size = len(x) - n + 1
    while k * 2 <= n:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:size], x[n - k : n - k + size])


class Block:
    """The documents of a block in order, and the keys of their windows."""

    def __init__(self, docs: pa.Table):
        docs = docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        null = pc.is_null(docs["doc_id"])
        docs = pa.concat_tables([docs.filter(null), docs.filter(pc.invert(null))])
        self.doc_ids = docs["doc_id"].combine_chunks()
        self.copies = docs["copies"].to_numpy()
        self.words = Words([words_of(t) for t in docs["text"].to_pylist()])
        self.h = self.words.hashes[self.words.ids]
        self.window = runs(self.h, WINDOW)
        ends = np.repeat(self.words.bounds[1:], np.diff(self.words.bounds))
        self.inside = np.arange(len(self.window)) + WINDOW <= ends[: len(self.window)]  # windows of one document
        at = np.flatnonzero(self.inside)
        self.keys, first = np.unique(self.window[at], return_index=True)
        self.first = at[first]  # where each distinct window first stands

    def again(self) -> np.ndarray:
        """Which of the distinct windows this block has more than once."""
        times = np.repeat(np.minimum(self.copies, 2), np.diff(self.words.bounds))
        at = np.flatnonzero(self.inside)
        place = np.searchsorted(self.keys, self.window[at])
        return np.bincount(place, weights=times[at], minlength=len(self.keys)) > 1


def _send(docs: pa.Table, parts: int) -> pa.Table:
    b = Block(docs)
    block = docs["block"][0].as_py()
    again = b.again()
    sent = [(p, block, packed(b.keys[s]), again[s].tobytes()) for p, s in cut_parts(b.keys, parts)]
    return pa.table([pa.array([r[i] for r in sent], f.type) for i, f in enumerate(SENT)], schema=SENT)


def _confirm(sent: pa.Table) -> pa.Table:
    sent = sent.sort_by("block")
    keys = [unpacked(x) for x in sent["keys"].to_pylist()]
    sizes = [len(k) for k in keys]
    everything = np.concatenate(keys)
    again = np.concatenate([np.frombuffer(x, bool) for x in sent["again"].to_pylist()])
    order = np.argsort(everything, kind="stable")  # of equal keys the earliest block stands first
    ranked = everything[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ranked))))
    recurs = (np.diff(np.append(starts, len(ranked))) > 1) | np.logical_or.reduceat(again[order], starts)
    flag = np.where(recurs[group], EARLIER, ONCE).astype(np.uint8)
    flag[starts[recurs]] = FIRST_HERE
    out = np.empty(len(flag), np.uint8)
    out[order] = flag
    cuts = np.cumsum([0, *sizes])
    return pa.table([sent["block"].combine_chunks(), sent["part"].combine_chunks(), pa.array([out[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())], schema=ANSWER)


def spelled(ids: np.ndarray, digits: int) -> str:
    """Word numbers as digits of base 64, each a character: an automaton's nodes then have few branches."""
    places = 64 ** np.arange(digits - 1, -1, -1)
    return (ids[:, None] // places % 64 + 0x100).astype("<u4").tobytes().decode("utf-32-le")


def phrases(b: Block, recurring: np.ndarray) -> np.ndarray:
    """Where a phrase of each of the recurring windows (positions of their first words) stands, every phrase once."""
    if not len(recurring):
        return recurring
    h = runs(b.h, PHRASE)
    least = sliding_min(h, WINDOW - PHRASE + 1)
    wanted, window = np.unique(least[recurring], return_index=True)
    at = recurring[window]
    inside = np.stack([h[at + k] == wanted for k in range(WINDOW - PHRASE + 1)])
    return at + inside.argmax(axis=0)


def hits(b: Block, at: np.ndarray) -> np.ndarray:
    """Where the phrases that stand at these places occur in the documents, by an automaton of them."""
    if not len(at):
        return np.zeros(0, np.int64)
    digits = max(1, math.ceil(math.log(max(2, len(b.words.distinct)), 64)))
    found = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    text, size = spelled(b.words.ids[at[:, None] + np.arange(PHRASE)].ravel(), digits), PHRASE * digits
    for a in range(0, len(text), size):
        found.add_word(text[a : a + size])
    found.make_automaton()
    text, bounds = spelled(b.words.ids, digits), b.words.bounds.tolist()
    ends = [np.array([end for end, _ in found.iter(text[a * digits : z * digits])], np.int64) + a * digits + 1 for a, z in zip(bounds[:-1], bounds[1:]) if z - a >= WINDOW]
    ends = np.concatenate(ends)
    return ends[ends % digits == 0] // digits - PHRASE  # whole words only


def occurrences(b: Block, recurring: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, number) of every occurrence of the recurring windows (numbers among the block's distinct ones)."""
    near = np.zeros(len(b.words.ids) + 1, np.int64)
    at = hits(b, phrases(b, b.first[recurring]))
    np.add.at(near, np.maximum(at - (WINDOW - PHRASE), 0), 1)
    np.add.at(near, at + 1, -1)
    at = np.flatnonzero((np.cumsum(near)[: len(b.window)] > 0) & b.inside)
    keys = b.keys[recurring]
    which = np.minimum(np.searchsorted(keys, b.window[at]), max(0, len(keys) - 1))
    same = keys[which] == b.window[at] if len(keys) else np.zeros(len(at), bool)
    at, which = at[same], recurring[which[same]]
    same = np.ones(len(at), bool)
    for k in range(WINDOW):
        same &= b.words.ids[at + k] == b.words.ids[b.first[which] + k]
    return at[same], which[same]


def _remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
    if not docs.num_rows:
        return OUT.empty_table()
    b = Block(docs)
    flags = np.frombuffer(b"".join(answers.sort_by("part")["flags"].to_pylist()), np.uint8)
    if len(flags) != len(b.keys):
        raise ValueError("a block's documents changed between two passes")
    count = len(b.words.ids)
    at, which = occurrences(b, np.flatnonzero(flags != ONCE))
    earliest = np.full(len(flags), count)
    np.minimum.at(earliest, which, at)
    starts = at[(flags[which] == EARLIER) | (at > earliest[which])]
    cover = np.zeros(count + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    keep = np.cumsum(cover)[:count] == 0
    kept, bounds = keep.tolist(), b.words.bounds.tolist()
    digests = [hashlib.sha256(b" ".join(compress(b.words.words[a:z], kept[a:z]))).hexdigest() for a, z in zip(bounds[:-1], bounds[1:])]
    left = np.concatenate([[0], np.cumsum(keep)])[b.words.bounds]
    n = np.diff(b.words.bounds)
    out = pa.table([b.doc_ids, pa.array(n), pa.array(n - np.diff(left)), pa.array(digests)], schema=OUT)
    if (b.copies == 1).all():
        return out
    # The second and later ones of repeated rows: every window of theirs stands in the first.
    more = pa.array(np.repeat(np.arange(len(n)), b.copies - 1))
    gone = np.where(n >= WINDOW, n, 0)
    whole = [hashlib.sha256(b"").hexdigest() if g else d for g, d in zip(gone.tolist(), digests)]
    return pa.concat_tables([out, pa.table([b.doc_ids, pa.array(n), pa.array(gone), pa.array(whole)], schema=OUT).take(more)])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256.

    Texts are exchanged twice, by block; window keys once, at about six bytes each."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = measured(docs, "doc_id")
    blocks, parts = extent(sizes)
    docs, hot = folded(docs, sizes, "doc_id")
    dealt = docs.withColumn("block", range_block(sizes, blocks, hot))
    sent = dealt.groupBy("block").applyInArrow(lambda t: _send(t, parts), "part int, block long, keys binary, again binary")
    answers = materialize(sent.groupBy("part").applyInArrow(_confirm, "block long, part int, flags binary"), "repeats")
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_sha256 string")
