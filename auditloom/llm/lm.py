"""Language-model scores by a weighted backoff automaton over words.

The model is a bigram model with absolute discounting over add-ADD unigrams, learned from all training documents:

    p0(w) = (c(w) + ADD) / (N + ADD * (V + 1))
    p(w | u) = max(c(u w) - D, 0) / c(u) + D * follow(u) / c(u) * p0(w)

with c counts in training tokens, N all of them, V the distinct ones and follow(u) the distinct successors of u. A document
begins after an end token. As an automaton: the root has an arc for each word, weighted p0; each word u seen in training is
a state with an arc for each seen successor, weighted p(w | u), and a failure arc to the root, weighted D * follow(u) / c(u);
every arc for w leads to w's state, or to the root if w has none. A text is one path: at each token the state's own arc is
taken, or else its failure arc and the root's arc; their log10 weights add up.

The counts never meet in one place. Blocks of documents send their distinct words and bigrams (64-bit keys) with training
counts to parts of the key space, which sum them and answer; a part also tells how many successors of which words it holds,
and those sums go back the same way. So each block scores its documents with exactly the states and arcs they can reach.

Words are lower-cased (A-Z). Null text is one end token. Rows without doc_id count as training rows, held_out false.
Repeated rows count and return each. Very long texts are whole in one block, which then is larger. An empty table gives no rows. An empty training set leaves N = V = 0 and every token at log10(1). Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.llm.blocks import Words, cut_parts, extent, folded, from_planes, measured, mixed, packed, planes, unpacked
from auditloom.llm.common import id_crc, materialize

ADD = 0.1
D = 0.75
END = b"\n"  # no word holds it

#: A bigram's key: 40 bits of both words, then the upper 24 bits of the head's key; the head's next 16 bits go along.
LOW = np.uint64(0xFFFFFF)
HEAD = np.uint64(24)

#: From a block to a part: words with counts, bigrams with counts.
SENT = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("words", pa.binary()), ("word_counts", pa.binary()), ("pairs", pa.binary()), ("heads", pa.binary()), ("pair_counts", pa.binary())])
#: kind 0: a part's answer to a block; 1: which of the part's words a block has; 5: the part's words; 2: heads of the part's bigrams (upper 40 bits of word keys) and how many successors; n, v: the part's tokens and distinct words.
SUMS = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("pair_counts", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])
SUMS_DDL = "kind int, part int, block long, keys binary, counts binary, pair_counts binary, n long, v long"
FOLLOW = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("counts", pa.binary())])
OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
OUT_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Block:
    """Tokens of a block's documents, the keys of its words and bigrams, and which tokens are for training."""

    def __init__(self, docs: pa.Table):
        texts = docs["text"].to_pylist()
        self.doc_ids, self.held, self.copies = docs["doc_id"].combine_chunks(), docs["held_out"].combine_chunks(), docs["copies"].to_numpy()
        w = Words([[*(t.encode().lower().split() if t else ()), END] for t in texts])
        self.bounds, self.ids = w.bounds, w.ids
        # Words in the order of their keys, so that what the parts answer stands at the words' numbers.
        self.word_keys, rank = np.unique(w.hashes, return_inverse=True)
        self.ids = rank[w.ids]
        end = rank[w.distinct.index(END)]
        self.before = np.concatenate([[end], self.ids[:-1]])
        self.before[self.bounds[:-1]] = end
        u, v = self.word_keys[self.before], self.word_keys[self.ids]
        # The upper bits spread the bigrams evenly, the lower ones are the head's: its successors can be counted anywhere.
        keys = (mixed(u * np.uint64(3) + v) & ~LOW) | (u >> np.uint64(40))
        self.pair_keys, at, self.pairs = np.unique(keys, return_index=True, return_inverse=True)
        self.heads = (u[at] >> HEAD).astype("<u2")
        #: How often each token counts in training.
        self.times = np.repeat(np.where(self.held.to_numpy(zero_copy_only=False), 0, self.copies), np.diff(self.bounds))

    def counts(self, which: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(which, weights=self.times, minlength=n).astype(np.uint64)


def _send(docs: pa.Table, parts: int) -> pa.Table:
    b, block = Block(docs), docs["block"][0].as_py()
    words, pairs = b.counts(b.ids, len(b.word_keys)), b.counts(b.pairs, len(b.pair_keys))
    cut = {p: [s, slice(0, 0)] for p, s in cut_parts(b.word_keys, parts)}
    for p, s in cut_parts(b.pair_keys, parts):
        cut.setdefault(p, [slice(0, 0), None])[1] = s
    sent = [(p, block, packed(b.word_keys[s]), planes(words[s]), packed(b.pair_keys[t]), b.heads[t].tobytes(), planes(pairs[t])) for p, (s, t) in cut.items()]
    return pa.table([pa.array([r[i] for r in sent], f.type) for i, f in enumerate(SENT)], schema=SENT)


def _total(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct keys, their sums, the place among them of each sender's keys, and where each key first stands."""
    distinct, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts).astype(np.float64), minlength=len(distinct)).astype(np.uint64)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    return distinct, total, np.split(which, cuts), first


def _sum(sent: pa.Table, parts: int) -> pa.Table:
    part = sent["part"][0].as_py()
    blocks = sent["block"].to_pylist()
    word_keys, word_total, words, _ = _total([unpacked(x) for x in sent["words"].to_pylist()], [from_planes(x) for x in sent["word_counts"].to_pylist()])
    pair_keys, pair_total, pairs, first = _total([unpacked(x) for x in sent["pairs"].to_pylist()], [from_planes(x) for x in sent["pair_counts"].to_pylist()])
    out = [(0, part, k, None, planes(word_total[w]), planes(pair_total[p]), None, None) for k, w, p in zip(blocks, words, pairs)]
    out += [(1, part, k, packed(w.astype(np.uint64)), None, None, None, None) for k, w in zip(blocks, words) if len(w)]
    out.append((5, part, None, packed(word_keys), None, None, None, None))
    low = np.concatenate([np.frombuffer(x, "<u2") for x in sent["heads"].to_pylist()])[first].astype(np.uint64)
    heads, follow = np.unique(((pair_keys & LOW) << np.uint64(16) | low)[pair_total > 0], return_counts=True)
    for p, s in cut_parts(heads << HEAD, parts):
        out.append((2, p, None, packed(heads[s]), planes(follow[s].astype(np.uint64)), None, None, None))
    out.append((3, part, None, None, None, None, int(word_total.sum()), int((word_total > 0).sum())))
    return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(SUMS)], schema=SUMS)


def _follow(rows: pa.Table) -> pa.Table:
    """Successors of each block's words; words that share the upper 40 bits of their keys share the sum."""
    kinds, keys, counts = rows["kind"].to_pylist(), rows["keys"].to_pylist(), rows["counts"].to_pylist()
    heads = [unpacked(k) for k, kind in zip(keys, kinds) if kind == 2]
    sums = [from_planes(c) for c, kind in zip(counts, kinds) if kind == 2]
    distinct, total, _, _ = _total(heads or [np.zeros(0, np.uint64)], sums or [np.zeros(0, np.uint64)])
    words = np.concatenate([unpacked(k) >> HEAD for k, kind in zip(keys, kinds) if kind == 5] or [np.zeros(0, np.uint64)])
    at = np.minimum(np.searchsorted(distinct, words), max(0, len(distinct) - 1))
    follow = np.where(distinct[at] == words, total[at], np.uint64(0)) if len(distinct) else np.zeros(len(words), np.uint64)
    out = [(4, part, block, planes(follow[unpacked(k).astype(np.int64)])) for kind, block, part, k in zip(kinds, rows["block"].to_pylist(), rows["part"].to_pylist(), keys) if kind == 1]
    return pa.table([pa.array([r[i] for r in out], f.type) for i, f in enumerate(FOLLOW)], schema=FOLLOW)


class BackoffAutomaton:
    """States are word numbers; arcs are the numbers of distinct bigrams of a block."""

    def __init__(self, words: np.ndarray, follow: np.ndarray, pairs: np.ndarray, heads: np.ndarray, tails: np.ndarray, n: int, v: int):
        c = words.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            root = (c + ADD) / (n + ADD * (v + 1))
            back = D * follow / c
            arc = np.maximum(pairs - D, 0) / c[heads] + back[heads] * root[tails]
            self.root = np.log10(root)
            #: A word without a count has no state: the path is at the root already.
            self.failure = np.where(c > 0, np.log10(back), 0.0)
            self.arc = np.log10(arc)
        self.has_arc = pairs > 0

    def weights(self, before: np.ndarray, token: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """The weight of each step of a path that reads token in the state of the token before."""
        return np.where(self.has_arc[pair], self.arc[pair], self.failure[before] + self.root[token])


def _score(docs: pa.Table, answers: pa.Table, n: int, v: int) -> pa.Table:
    if not docs.num_rows:
        return OUT.empty_table()
    b, answers = Block(docs), answers.sort_by("part")
    own, follow = answers.filter(pc.equal(answers["kind"], 0)), answers.filter(pc.equal(answers["kind"], 4))
    gather = lambda t, c: np.concatenate([from_planes(x) for x in t[c].to_pylist()] or [np.zeros(0, np.uint64)])
    words, pairs, follow = gather(own, "counts"), gather(own, "pair_counts"), gather(follow, "counts")
    if (len(words), len(pairs), len(follow)) != (len(b.word_keys), len(b.pair_keys), len(b.word_keys)):
        raise ValueError("a block's documents changed between two passes")
    first = np.full(len(pairs), -1)
    first[b.pairs[::-1]] = np.arange(len(b.pairs))[::-1]
    model = BackoffAutomaton(words, follow.astype(np.float64), pairs.astype(np.float64), b.before[first], b.ids[first], n, v)
    sums = lambda x: np.add.reduceat(x, b.bounds[:-1])  # noqa: E731  every document has its end token
    score, base, known = sums(model.weights(b.before, b.ids, b.pairs)), sums(model.root[b.ids]), sums((words[b.ids] > 0).astype(np.int64))
    out = pa.table([b.doc_ids, b.held, pa.array(np.diff(b.bounds)), pa.array(known), pa.array(np.full(len(known), n)), pa.array(base), pa.array(score)], schema=OUT)
    return out if (b.copies == 1).all() else out.take(pa.array(np.repeat(np.arange(len(known)), b.copies)))


def score(docs: DataFrame, held_out_of: int = 10) -> DataFrame:
    """Per document: doc_id, held_out (crc32 of the id as text modulo held_out_of is 0), n_tokens, n_known, train_tokens,
    base_score (unigrams) and score (log10 probability of the text). Texts are exchanged twice, by block."""
    held = F.coalesce(id_crc(F.col("doc_id")) % held_out_of == 0, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", held)
    sizes = measured(docs, "doc_id", "text")
    blocks, parts = extent(sizes)
    docs, _ = folded(docs, sizes, "doc_id", "text")  # repeated rows would all go to one block
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    sent = dealt.groupBy("block").applyInArrow(lambda t: _send(t, parts), "part int, block long, words binary, word_counts binary, pairs binary, heads binary, pair_counts binary")
    sums = materialize(sent.groupBy("part").applyInArrow(lambda t: _sum(t, parts), SUMS_DDL), "lm-sums")
    total = sums.filter("kind = 3").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    follow = sums.filter("kind in (1, 2, 5)").select("kind", "part", "block", "keys", "counts").groupBy("part").applyInArrow(_follow, "kind int, part int, block long, counts binary")
    answers = sums.filter("kind = 0").select("kind", "part", "block", "counts", "pair_counts").unionByName(follow.withColumn("pair_counts", F.lit(None).cast("binary")))
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda d, a: _score(d, a, n, v), OUT_DDL)
