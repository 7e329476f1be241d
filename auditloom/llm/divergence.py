"""How sources of a language differ in their terms: pairwise divergences by three-dimensional cube partitioning.

Terms are runs of letters and non-ASCII characters, A-Z lower-cased. A language keeps the terms of at least ``MIN_DOCS`` of its
documents. A group is a (lang, source); it gives a kept term p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers.

1. Tasks count terms of whole texts and send sums; one row a (lang, source, term) is left.
2. The kept terms of a language are dealt into term blocks of about ``TERMS``, its groups into group blocks of about ``GROUPS``
   (by hash, numbered inside a block). A slice is the counts of a group block in a term block, zeros left out.
3. A cell (group block, group block, term block) is one task's unit: the two slices, replicated to all cells that need them,
   are made dense, and the partial sums of abs(p - q) over the block's terms leave for each pair of groups.
4. Partial sums are added along the term axis (with map-side sums).

A slice has GROUPS x TERMS counts at most by expectation, whatever the number of documents; hot sources and words are sums
before they move. A slice is sent once a group block of its language: results are quadratic in the groups of a language, by
contract, and so are the cells, but never in documents or terms.

Null text, lang and source count as ''. Groups without terms take part with N = 0. A language without kept terms has V = 0: its
pairs have value 0 and it has no rows of part ``term``. Repeated rows count as often as they occur, rows of one doc_id are documents of
their own (doc_id is not read). Very long texts are counted in pieces of bounded memory but for the list of their own words.
Ties in rank go by item in UTF-8 order. An empty table gives no rows. Other columns are not read. Sums are exact up to 9 x 10^15 terms a language.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.llm.common import chunks, materialize

MIN_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP = 50
#: Groups and terms of a block, about.
GROUPS, TERMS = 32, 8192
#: Words that a task counts before it sends their sums.
FLUSH = 4_000_000
#: Tables of up to so many rows (a row a language) are broadcast, larger ones joined by key.
FEW = 10_000

#: All ASCII characters but letters part terms; A-Z are lower-cased.
LETTERS = bytes(c | 0x20 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])
PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(LETTERS).split() if text else []


class Tally:
    """Counts of terms by group, and the documents that hold them, until they are taken."""

    def __init__(self):
        self.group: dict[tuple[str, str], int] = defaultdict(count().__next__)
        self.term: dict[bytes, int] = defaultdict(count().__next__)
        self.ids: list[np.ndarray] = []
        self.doc: list[tuple[int, int]] = []  # group and number of words
        self.words = 0

    def add(self, lang: str, source: str, text: str) -> None:
        words = terms_of(text)
        if words:
            self.ids.append(np.fromiter(map(self.term.__getitem__, words), np.int32, len(words)))
            self.doc.append((self.group[lang, source], len(words)))
            self.words += len(words)

    def take(self) -> pa.RecordBatch:
        group, sizes = np.array(self.doc, np.int64).reshape(-1, 2).T
        wide = max(1, len(self.term))
        ids = np.concatenate(self.ids).astype(np.int64) if self.ids else np.zeros(0, np.int64)
        held, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) * wide + ids, return_counts=True)  # by document
        keys, place, docs = np.unique(group[held // wide] * wide + held % wide, return_inverse=True, return_counts=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, place, n)
        langs, sources = (pa.array([g[i] for g in self.group], pa.string()).take(pa.array(keys // wide)) for i in (0, 1))
        terms = pa.array(list(self.term), pa.binary()).cast(pa.string()).take(pa.array(keys % wide))
        self.__init__()
        return pa.record_batch([langs, sources, terms, pa.array(sums), pa.array(docs)], schema=COUNTS)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally()
    for batch in batches:
        langs, sources, text = batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")
        for a, z in chunks(text):
            for i, t in enumerate(text.slice(a, z - a).to_pylist(), a):
                tally.add(langs[i], sources[i], t)
                if tally.words >= FLUSH:
                    yield tally.take()
    if tally.words:
        yield tally.take()


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE (counts + SMOOTH) / total) by long division in thousands: exact while total is below 9.2 x 10^15."""
    rest, out = counts + SMOOTH, np.zeros_like(counts)
    out += rest // total
    rest = rest % total
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _dense(row: dict) -> np.ndarray:
    """Shares of all groups of a slice in all terms of its block."""
    m, n = row["terms"], len(row["groups"])
    counts = np.zeros((n, m), np.int64)
    if row["counts"]:
        gi, ti, c = (np.array([x[k] for x in row["counts"]], np.int64) for k in ("gi", "ti", "count"))
        counts[gi, ti] = c
    totals = np.array([g["n"] for g in row["groups"]], np.int64) + SMOOTH * row["v"]
    return shares(counts, totals[:, None]) if m else counts


def _cell(slices: pa.Table) -> pa.Table:
    """Partial sums of abs(p - q) for the ordered pairs of different groups of a cell."""
    own = slices["ci"][0] == slices["cj"][0]
    slices = slices.to_pylist()
    if len(slices) == 1 and not own:  # the other block has no group
        return PARTIAL.empty_table()
    a, b = slices[0], slices[-1]
    p, q = _dense(a), _dense(b)
    left, right = ([g["source"] for g in x["groups"]] for x in (a, b))
    out: list[tuple[str, str, int]] = []
    for i, s in enumerate(left):
        f = np.abs(p[i] - q).sum(axis=1).tolist()
        for t, value in zip(right, f):
            if s != t:
                out.append((s, t, value))
                if len(slices) > 1:
                    out.append((t, s, value))
    return pa.table([pa.array([a["lang"]] * len(out), pa.string()), *(pa.array([x[k] for x in out], f.type) for k, f in enumerate(list(PARTIAL)[1:]))], schema=PARTIAL)


def _small(df: DataFrame) -> DataFrame:
    """A table of a row a language, broadcast if it is known to be short."""
    return F.broadcast(df) if df.count() <= FEW else df


def share(n: Column, total: Column, v: Column) -> Column:
    """shares() as an expression."""
    whole = lambda c: c.cast("decimal(19,0)")
    scaled = F.lit(SCALE).cast("decimal(10,0)") * whole(n + SMOOTH)
    return F.call_function("div", scaled, whole(total + SMOOTH * v)).cast("long") + 1


class Audit:
    """The tables that both parts of the report come from."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS):
        docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
        tallied = docs.mapInArrow(_tally, "lang string, source string, term string, count long, docs long")
        counts = materialize(tallied.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")), "counts")
        kept = counts.groupBy("lang", "term").agg(F.sum("count").alias("total"), F.sum("docs").alias("docs")).filter(F.col("docs") >= min_docs).drop("docs")
        kept = materialize(kept, "kept")
        langs = materialize(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang")), "langs")
        block = F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / TERMS)).cast("int")
        numbered = kept.join(_small(langs), "lang").withColumn("tb", block).withColumn("ti", F.row_number().over(Window.partitionBy("lang", "tb").orderBy("term")) - 1)
        self.terms = materialize(numbered, "terms")  # lang, term, total, v, n_lang, tb, ti
        self.held = materialize(counts.drop("docs").join(self.terms, ["lang", "term"]), "held")  # a row a group and kept term of it
        sums = materialize(self.held.groupBy("lang", "source").agg(F.sum("count").alias("n")), "sums")
        found = materialize(docs.select("lang", "source").distinct(), "found")
        size = materialize(found.groupBy("lang").agg(F.ceil(F.count("*") / GROUPS).cast("int").alias("nb")), "sizes")
        groups = found.join(sums, ["lang", "source"], "left").join(_small(langs), "lang", "left").join(_small(size), "lang")
        groups = groups.select("lang", "source", "nb", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v")), F.pmod(F.xxhash64("source"), "nb").alias("gb"))
        self.groups = materialize(groups.withColumn("gi", F.row_number().over(Window.partitionBy("lang", "gb").orderBy("source")) - 1), "groups")

    def pairs(self) -> DataFrame:
        """lang, source, item (another source), value."""
        g_blocks = self.groups.groupBy("lang", "gb", "nb", "v").agg(F.array_sort(F.collect_list(F.struct("gi", "source", "n"))).alias("groups"))
        t_blocks = self.terms.groupBy("lang", "tb").agg(F.count("*").alias("terms"))
        none = self.groups.filter("v = 0").select("lang").distinct().select("lang", F.lit(0).alias("tb"), F.lit(0).cast("long").alias("terms"))
        slices = self.held.select("lang", "source", "tb", "ti", "count").join(self.groups.select("lang", "source", "gb", "gi"), ["lang", "source"])
        slices = slices.groupBy("lang", "gb", "tb").agg(F.collect_list(F.struct("gi", "ti", "count")).alias("counts"))
        grid = g_blocks.join(t_blocks.unionByName(none), "lang").join(slices, ["lang", "gb", "tb"], "left")
        cells = materialize(grid, "slices").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        cells = cells.select("lang", "tb", F.least("gb", "other").alias("ci"), F.greatest("gb", "other").alias("cj"), "groups", "terms", "v", "counts")
        partial = cells.groupBy("lang", "tb", "ci", "cj").applyInArrow(_cell, "lang string, source string, item string, value long")
        return partial.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    def over(self) -> DataFrame:
        """lang, source, item (a kept term that the group uses more than its language does), value."""
        held = self.held.join(self.groups.select("lang", "source", "n"), ["lang", "source"])
        p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
        return held.select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).filter("value > 0")


def report(docs: DataFrame, top: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has every other source of the language, part ``term`` the top terms."""
    audit = Audit(docs, min_docs)
    by = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = audit.pairs().withColumn("rank", F.row_number().over(by)).withColumn("part", F.lit("pair"))
    terms = audit.over().withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")


SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS (
    SELECT lang, source, row_no, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
    SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT row_no) >= {MIN_DOCS}
), l AS (
    SELECT lang, count(*) AS v, sum(total) AS n_lang FROM k GROUP BY lang
), g AS (
    SELECT DISTINCT lang, source FROM d
), c AS (
    SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term
), s AS (
    SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (CAST({SCALE} AS HUGEINT) * (coalesce(c.n, 0) + {SMOOTH})) // (coalesce(s.total, 0) + {SMOOTH} * l.v) AS p,
           1 + (CAST({SCALE} AS HUGEINT) * (k.total + {SMOOTH})) // (l.n_lang + {SMOOTH} * l.v) AS q
    FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
               GROUP BY x.lang, x.source, y.source) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), both_parts AS (
    SELECT lang, source, 'pair' AS part, item, value FROM pairs
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
