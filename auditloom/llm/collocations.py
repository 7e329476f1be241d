"""Phrases of two to five words whose words belong together, by Toivonen's sampling method.

Texts are lower-cased in A-Z, split at ``[.,;:!?]`` and line ends into pieces and these at blanks into words. All is per lang.

1. Propose: of the pieces of all documents one in ``SAMPLE`` is drawn (by hash of id, text and place, so copies and repeated lines are
   drawn apart); phrases of one to five words that reach a threshold lowered by 3.5 standard deviations there are the proposal S:
   words and pairs in one pass, longer phrases over frequent pairs in a second.
2. Count: one pass over all documents counts S and its negative border exactly: a phrase counts if both its parts without the
   last and without the first word are in S (every word counts). The border is never listed; what does not occur needs no count.
3. Expand: border phrases that reach the threshold (failures) join S, and another full pass counts what that adds to the
   border. What it counts anew stands for part of S at once, so longer phrases over it are counted in the same pass, and the
   set is closed after it: the parts of a frequent phrase are frequent, so by induction on its length each is in S, a failure
   or counted anew, and the phrase itself is counted. No failure, no such pass.
4. Confirm: counts so far are of 61-bit hashes, which can only be too high. A last pass counts the words themselves of what reached the
   threshold, dealt into the same parts, so results are exact whatever collides and whatever the sample held.
5. Cuts, scores and containment are joins of the counted phrases.

A task sends the distinct keys of about ``FLUSH`` words, sorted and cut by their top bits into parts, packed (see blocks.py);
hot words and phrases travel once a task. S is a Bloom filter of at most ``SLICES`` x 128 KB in every task, which bounds driver
and broadcasts; beyond some 16 million phrases it lets more phrases through to be counted, never fewer.

Null lang is ``und``, null text is empty. Repeated rows count each. Very long texts are handled whole; a task holds the words of
one text and numbers for FLUSH more. Ties go by fewer first words (cuts) and by a, then phrase in UTF-8 order (rank). An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditloom.llm.blocks import FACTOR, cut_parts, extent, from_planes, measured, mixed, packed, planes, unpacked
from auditloom.llm.common import chunks, materialize

LEAST = 100
LONGEST = 5
TOP = 2000
SAMPLE = 4
#: Words that a task numbers before it sends their keys.
FLUSH = 1_200_000
#: The filter: slices of 2^20 bits, 16 bits a phrase, PROBES of them set.
SLICES, SLICE_BITS, PROBES = 256, 20, 4
FEW = 10_000

#: Marks the end of a piece: no byte of UTF-8.
END = b"\xff"
LOWER = bytes(255 if c in b".,;:!?\n\x0b\x0c\r" else c | 0x20 if 65 <= c <= 90 else c for c in range(256))
SENT = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
MERGED = pa.schema([("key", pa.int64()), ("n", pa.int64())])
COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())])
SPELLED = pa.schema([("part", pa.int32()), *((f.name, pa.list_(f.type)) for f in COUNTED)])
#: Tosses of the sample, taken from a place that a document's hash gives.
TOSSES = np.random.default_rng(20240701).random(65_521)


class Grams:
    """Words of some documents as numbers, and the keys of the phrases that begin at them."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = defaultdict(count().__next__)
        self.langs: dict[str, int] = defaultdict(count().__next__)
        self.vocabulary[END]  # number 0
        self.ids: list[np.ndarray] = []
        self.of: list[tuple[int, int]] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        words = text.replace(END, b" \xff ").split()
        words.append(END)
        self.ids.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
        self.of.append((self.langs[lang], len(words)))
        self.size += len(words)

    def close(self) -> "Grams":
        ids = np.concatenate(self.ids)
        lang = np.repeat(*np.array(self.of, np.int32).T)
        ends = np.flatnonzero(ids == 0).astype(np.int32)
        left = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(len(ids), dtype=np.int32)  # words of the piece from here on
        at = left > 0
        self.id, self.lang, self.left = ids[at], lang[at], left[at]
        salt = np.array([xxhash.xxh64_intdigest(x.encode(), 1) for x in self.langs], np.uint64)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary], np.uint64)
        self.h = mixed(hashes[self.id] + salt[self.lang])
        # Words of a language are numbered, so that what concerns single words is worked out once a word.
        self.word = self.lang * np.int32(len(hashes)) + self.id
        self.word_keys = tagged(mixed(mixed((hashes[None, :] + salt[:, None]).ravel())), 1)
        return self

    def key(self, k: int, at: np.ndarray) -> np.ndarray:
        """Keys of the k-word phrases that begin at these places, their low bits k."""
        if k == 1:
            return self.word_keys[self.word[at]]
        out = self.h[at]
        for j in range(1, k):
            out = out * np.uint64(FACTOR) + self.h[at + j]
        return tagged(mixed(out), k)

    def counted(self, known: "Known | None") -> Iterator[tuple[int, np.ndarray]]:
        """k and the places of the k-word phrases that are in S or its border, level by level; without S, words and pairs."""
        yield 1, np.arange(len(self.h))
        if known is None:
            yield 2, np.flatnonzero(self.left >= 2)
            return
        inside = known.has(self.word_keys)[self.word]
        for k in range(2, LONGEST + 1):
            at = np.flatnonzero((self.left >= k) & inside & np.append(inside[1:], False))
            yield k, at
            inside = np.zeros(len(self.h), bool)
            inside[at] = known.has(self.key(k, at))

    def added(self, known: "Known", before: "Known") -> Iterator[tuple[int, np.ndarray]]:
        """k and the places of the k-word phrases that a larger S adds to what has been counted, those over added ones too."""
        was, inside = before.has(self.word_keys)[self.word], known.has(self.word_keys)[self.word]
        for k in range(2, LONGEST + 1):
            fits = self.left >= k
            old, at = fits & was & np.append(was[1:], False), np.flatnonzero(fits & inside & np.append(inside[1:], False))
            new = ~old[at]
            yield k, at[new]
            key = self.key(k, at)
            was, inside = np.zeros(len(self.h), bool), np.zeros(len(self.h), bool)
            was[at] = before.has(key) & ~new
            inside[at] = known.has(key) | new


def tagged(x: np.ndarray, k: int) -> np.ndarray:
    return x & np.uint64(2**64 - 8) | np.uint64(k)


class Known:
    """A set of keys, by a filter: has() is true for all of them and for few others."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, np.uint8)
        self.slices = len(bits) >> (SLICE_BITS - 3)

    @staticmethod
    def places(keys: np.ndarray) -> Iterator[np.ndarray]:
        """Bits of a key within its slice."""
        x = mixed(keys)
        for _ in range(PROBES):
            yield (x >> np.uint64(64 - SLICE_BITS)).astype(np.int64)
            x = x << np.uint64(11) | x >> np.uint64(53)

    def has(self, keys: np.ndarray) -> np.ndarray:
        base = slice_of(keys, self.slices) << SLICE_BITS
        left = np.arange(len(keys))
        for place in self.places(keys):  # the first bit rules most keys out
            place = place[left] + base[left]
            left = left[(self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)]
        out = np.zeros(len(keys), bool)
        out[left] = True
        return out


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return (keys >> np.uint64(40)).astype(np.int64) & (slices - 1)


def _slice(keys: pa.Table) -> pa.Table:
    bits = np.zeros(1 << SLICE_BITS, bool)
    for place in Known.places(keys["key"].to_numpy().astype(np.int64).view(np.uint64)):
        bits[place] = True
    return pa.table({"slice": keys["slice"][:1].cast(pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def known(keys: DataFrame):
    """The filter of a table of keys, broadcast; at most SLICES slices reach the driver."""
    n, slices = keys.count(), 1
    while slices < SLICES and slices << SLICE_BITS < 16 * n:
        slices *= 2
    place = F.shiftrightunsigned("key", 40).bitwiseAND(slices - 1).cast("int")
    made = keys.select("key", place.alias("slice")).groupBy("slice").applyInArrow(_slice, "slice int, bits binary").collect()
    size = 1 << (SLICE_BITS - 3)
    bits = bytearray(slices * size)
    for row in made:
        bits[row["slice"] * size : (row["slice"] + 1) * size] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(bits))


def drawn(text: bytes, doc_id: int | None, one_in: int) -> bytes:
    """The pieces of a text that the sample has."""
    pieces = text.split(END)
    at = xxhash.xxh64_intdigest(text, (doc_id or 0) & 0xFFFFFFFF) % len(TOSSES)
    heads = TOSSES[(at + np.arange(len(pieces))) % len(TOSSES)] < 1 / one_in
    return END.join(compress(pieces, heads.tolist()))


def _grams(batches: Iterator[pa.RecordBatch], one_in: int = 1) -> Iterator[Grams]:
    held = Grams()
    for batch in batches:
        ids, langs, text = batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("text")
        for a, z in chunks(text):
            for i, t in enumerate(text.slice(a, z - a).to_pylist(), a):
                t = t.encode().translate(LOWER)
                t = t if one_in == 1 else drawn(t, ids[i], one_in)
                if t:
                    held.add(langs[i], t)
                if held.size >= FLUSH:
                    yield held.close()
                    held = Grams()
    if held.size:
        yield held.close()


def _send(batches: Iterator[pa.RecordBatch], choose: Callable[[Grams], list[np.ndarray]], parts: int, one_in: int) -> Iterator[pa.RecordBatch]:
    for g in _grams(batches, one_in):
        keys, n = np.unique(np.concatenate(choose(g)), return_counts=True)
        sent = [(p, packed(keys[s]), planes(n[s])) for p, s in cut_parts(keys, parts)]
        yield pa.record_batch([pa.array([r[i] for r in sent], f.type) for i, f in enumerate(SENT)], schema=SENT)


def _merge(sent: pa.Table, least: int) -> pa.Table:
    keys = np.concatenate([unpacked(x) for x in sent["keys"].to_pylist()])
    n = np.concatenate([from_planes(x) for x in sent["counts"].to_pylist()]).astype(np.int64)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    n = np.add.reduceat(n, starts)
    many = n >= least
    return pa.table([keys[starts[many]].view(np.int64), n[many]], schema=MERGED)


def _tally(docs: DataFrame, choose: Callable[[Grams], list[np.ndarray]], parts: int, least: int, name: str, one_in: int = 1) -> DataFrame:
    """Keys that reach a count over all documents, or over a sample of their pieces."""
    sent = docs.mapInArrow(lambda it: _send(it, choose, parts, one_in), "part int, keys binary, counts binary")
    return materialize(sent.groupBy("part").applyInArrow(lambda t: _merge(t, least), "key long, n long"), name)


def proposed(docs: DataFrame, parts: int, least: int, one_in: int) -> DataFrame:
    """Keys of the phrases that are frequent in the sample."""
    short = _tally(docs, lambda g: [g.key(k, at) for k, at in g.counted(None)], parts, least, "proposed", one_in)
    filter_ = known(short)

    def longer(g: Grams) -> list[np.ndarray]:
        inside = Known(filter_.value)
        pair, some = np.zeros(len(g.h), bool), np.flatnonzero(g.left >= 2)
        pair[some] = inside.has(g.key(2, some))
        out, run = [np.zeros(0, np.uint64)], pair
        for k in range(3, LONGEST + 1):
            run = run & np.append(pair[k - 2 :], np.zeros(min(k - 2, len(pair)), bool))
            out.append(g.key(k, np.flatnonzero(run)))
        return out

    return short.select("key").unionByName(_tally(docs, longer, parts, least, "proposed", one_in).select("key"))


def frequent(docs: DataFrame, parts: int, least: int, sample: int) -> DataFrame:
    """Keys of all phrases that occur often enough (and of what shares a key with others and so seems to)."""
    mean = least / sample
    s = proposed(docs, parts, max(1, math.floor(mean - 3.5 * math.sqrt(mean))), sample)
    first = known(s)
    found = _tally(docs, lambda g: [g.key(k, at) for k, at in g.counted(Known(first.value))], parts, least, "frequent")
    failed = materialize(found.filter(F.col("key").bitwiseAND(7) < LONGEST).join(s, "key", "left_anti").select("key"), "failed")
    if failed.isEmpty():
        return found
    second = known(s.unionByName(failed))
    return found.unionByName(_tally(docs, lambda g: [g.key(k, at) for k, at in g.added(Known(second.value), Known(first.value))], parts, least, "frequent"))


def _spell(batches: Iterator[pa.RecordBatch], keys, parts: int) -> Iterator[pa.RecordBatch]:
    """The phrases whose keys are known with their counts in a batch, as lists a part; k = 0: words of each language."""
    inside = Known(keys.value)
    for g in _grams(batches):
        words, langs = list(g.vocabulary), list(g.langs)
        times = np.bincount(g.word, minlength=len(g.word_keys))
        many = np.flatnonzero(inside.has(g.word_keys) & (times > 0))
        of, n = np.divmod(many, len(words))[0], np.bincount(g.lang, minlength=len(langs))
        at_key, lang, size, f = [np.zeros(len(langs), np.uint64), g.word_keys[many]], [np.arange(len(langs)), of], [0] * len(langs) + [1] * len(many), [n, times[many]]
        spelled = [""] * len(langs) + [words[i].decode() for i in (many % len(words)).tolist()]
        for k, at in g.counted(inside):
            if k == 1:
                continue
            key = g.key(k, at)
            ok = inside.has(key)
            at, key = at[ok], key[ok]
            distinct, first, place, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            first = at[first]
            same = g.lang[at] == g.lang[first[place]]
            for j in range(k):
                same &= g.id[at + j] == g.id[first[place] + j]
            if not same.all():  # two phrases share a key: the others are counted one by one
                n = np.append(np.bincount(place[same], minlength=len(first)), np.ones((~same).sum(), np.int64))
                first, distinct = np.append(first, at[~same]), np.append(distinct, key[~same])
            spelled += [b" ".join([words[i] for i in w]).decode() for w in np.stack([g.id[first + j] for j in range(k)], axis=1).tolist()]
            size += [k] * len(first)
            at_key.append(distinct)
            lang.append(g.lang[first])
            f.append(n)
        at_key = np.concatenate(at_key)
        order = np.argsort(at_key, kind="stable")
        table = pa.table([pa.array(langs).take(pa.array(np.concatenate(lang))), pa.array(size, pa.int32()), pa.array(spelled, pa.string()), pa.array(np.concatenate(f))], schema=COUNTED).take(pa.array(order))
        sent = [(p, *(table[c][s].combine_chunks() for c in COUNTED.names)) for p, s in cut_parts(at_key[order], parts)]
        lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(r[i]) for r in sent)]), pa.int32()), pa.concat_arrays([r[i] for r in sent])) for i in range(1, len(SPELLED))]
        yield pa.record_batch([pa.array([r[0] for r in sent], pa.int32()), *lists], schema=SPELLED)


def _sum(sent: pa.Table, least: int) -> pa.Table:
    """Exact counts of the phrases of a part that reach the threshold, and of words by language."""
    rows = pa.table([pc.list_flatten(sent[c]) for c in COUNTED.names], schema=COUNTED)
    rows = rows.group_by(["lang", "k", "phrase"]).aggregate([("f", "sum")]).select(["lang", "k", "phrase", "f_sum"])
    return rows.filter(pc.or_(pc.greater_equal(rows["f_sum"], least), pc.equal(rows["k"], 0))).rename_columns(COUNTED.names)


def phrases(docs: DataFrame, least: int = LEAST, sample: int = SAMPLE) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases of one to five words that occur often enough, and (lang, n), the words of each lang."""
    sizes = measured(docs.select("doc_id", "text"), "doc_id")
    _, parts = extent(sizes)
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    keys = known(frequent(docs, parts, least, sample).select("key"))
    sent = docs.mapInArrow(lambda it: _spell(it, keys, parts), "part int, lang array<string>, k array<int>, phrase array<string>, f array<long>")
    counts = materialize(sent.groupBy("part").applyInArrow(lambda t: _sum(t, least), "lang string, k int, phrase string, f long"), "phrases")
    return counts.filter("k > 0"), counts.filter("k = 0").select("lang", F.col("f").alias("n"))


def _slice_of_words(start, size):
    return F.concat_ws(" ", F.slice("w", start, size))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, sample: int = SAMPLE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first of each language by the score of their weakest cut."""
    counts, totals = phrases(docs, least, sample)
    split = counts.withColumn("w", F.split("phrase", " "))
    candidates = split.filter("k >= 2")
    cut = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cut = cut.select("lang", "phrase", F.col("f").alias("a"), "cut", _slice_of_words(F.lit(1), F.col("cut")).alias("first"), _slice_of_words(F.col("cut") + 1, F.col("k")).alias("rest"))
    side = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cut.join(side("first", "l"), ["lang", "first"]).join(side("rest", "r"), ["lang", "rest"])
    cut = cut.join(F.broadcast(totals) if totals.count() <= FEW else totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * whole("a")).cast("decimal(19,0)") * whole("n"), whole("l") * whole("r"))
    scored = cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r", "n")).alias("best"))
    sub = F.explode(F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), s -> concat_ws(' ', slice(w, s, m)))))"))
    inside = split.filter("k >= 3").select("lang", sub.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(inside, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * a")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "best.l", "best.r", "best.n", "best.score")


SQL = rf"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d
), places AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), total AS (
    SELECT lang, count(*) AS n FROM places GROUP BY lang
), f AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM places, range(1, {LONGEST + 1}) AS t(k)
    WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {LEAST}
), c AS (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k >= 2
), cuts AS (
    SELECT lang, phrase, f, k, w, unnest(range(1, k)) AS cut FROM c
), scored AS (
    SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, t.n, CAST((CAST(1000 AS HUGEINT) * c.f * t.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score, c.cut
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : c.cut], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1 : c.k], ' ') JOIN total t ON t.lang = c.lang
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
    SELECT * FROM weakest a WHERE NOT EXISTS (
        SELECT 1 FROM c b WHERE b.lang = a.lang AND len(b.phrase) > len(a.phrase) AND contains(' ' || b.phrase || ' ', ' ' || a.phrase || ' ') AND 100 * b.f >= 100 * a.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= {TOP}
"""
