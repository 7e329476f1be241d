r"""Secret scans with a trigram inverted index, in DataFrame and SQL functions only.

From each rule's regular expression follows a Boolean query: of every stretch that a match must hold, one of its literal
strings, and so all trigrams of that string (lower-cased). The index has a posting (document, trigram) for every trigram
that some rule asks for; it is a table in the shared folder. Postings are intersected by document: an alternative holds if
all its trigrams are there, a clause if one of its alternatives does, and a document is a rule's candidate if all clauses
hold. Candidates are then matched by the expression itself. A rule without a trigram that must occur (long runs of
hexadecimal digits) is matched against every document.

Rules: assign, access, hex, and further kinds whose spans are added. Spans are leftmost and non-overlapping per kind, in code
points, end exclusive; matches that fail a rule's minimum are dropped after matching. For ``access`` and ``hex`` the minimum
stands in the expression: a shorter run of the same characters can't hold a longer match, so the spans are the same.

Null text counts as empty. Documents are told apart by a hash of id and text, so rows without doc_id, of equal doc_id, and
repeated rows each get their own spans. Very long texts are read whole by the expressions of one task. An empty table gives no
rows. Other columns are kept by ``redact`` and not read otherwise.
"""

from __future__ import annotations

from re import _constants as rc
from re import _parser as rp
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.llm.common import materialize


class Rule(NamedTuple):
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group
    base: bool = False


#: In the order in which kinds are listed.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", base=True),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
#: Strings an expression's stretch may expand to before it is cut.
EXPANSIONS = 64
REDACTED = "[SECRET]"
#: Matches of a text that are folded together.
FOLD = 256

Clause = frozenset[frozenset[str]]


def _finite(node) -> set[str] | None:
    """All strings that the node matches, if they are few."""
    op, arg = node
    if op is rc.LITERAL:
        return {chr(arg)}
    if op is rc.IN and all(k is rc.LITERAL for k, _ in arg) and len(arg) <= 8:
        return {chr(v) for _, v in arg}
    if op is rc.IN and all(k is rc.RANGE for k, _ in arg) and sum(b - a + 1 for _, (a, b) in arg) <= 8:
        return {chr(c) for _, (a, b) in arg for c in range(a, b + 1)}
    if op is rc.BRANCH:
        parts = [_product(x) for x in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op is rc.SUBPATTERN:
        return _product(arg[3])
    if op is rc.MAX_REPEAT and arg[:2] == (0, 1):
        inner = _product(arg[2])
        return None if inner is None else inner | {""}
    return None


def _product(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        one = _finite(node)
        if one is None or len(out) * len(one) > EXPANSIONS:
            return None
        out = {a + b for a in out for b in one}
    return out


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for any text with a match; in each, alternatives of which one holds with all its trigrams.
    Empty if no trigram must occur."""
    clauses: list[Clause] = []
    run = {""}

    def cut() -> None:
        nonlocal run
        if all(len(s) >= 3 for s in run):
            sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in map(str.lower, run)}
            clauses.append(frozenset(a for a in sets if not any(b < a for b in sets)))
        run = {""}

    for node in rp.parse(pattern):
        one = _finite(node)
        if one is None or len(run) * len(one) > EXPANSIONS:
            cut()
        if one is not None and len(one) <= EXPANSIONS:
            run = {a + b for a in run for b in one}
    cut()
    return list(dict.fromkeys(clauses))


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings key, trigram of the documents, as a table."""
    wanted = F.array(*[F.lit(t) for t in trigrams])
    low = docs.select(_key().alias("key"), F.lower("text").alias("low")).filter("low is not null")
    return materialize(low.select("key", F.explode(F.filter(wanted, lambda t: F.contains(F.col("low"), t))).alias("trigram")), "trigrams")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """key, kinds (array): the rules whose trigram query a document answers."""
    spark = docs.sparkSession
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    asked = [(kind, c, a, t, len(alt), len(q)) for kind, q in queries.items() for c, clause in enumerate(q) for a, alt in enumerate(sorted(map(sorted, clause))) for t in alt]
    terms = spark.createDataFrame(asked, "kind string, clause int, alternative int, trigram string, size int, clauses int")
    postings = index(docs, sorted({t for *_, t, _, _ in asked}))
    # The terms are as many as the rules have trigrams: a constant.
    held = postings.join(F.broadcast(terms), "trigram").groupBy("key", "kind", "clause", "alternative", "size", "clauses").agg(F.count_distinct("trigram").alias("n"))
    held = held.filter("n = size").groupBy("key", "kind", "clauses").agg(F.count_distinct("clause").alias("n")).filter("n = clauses")
    return held.groupBy("key").agg(F.collect_set("kind").alias("kinds"))  # no more than there are rules


def parts_of(values: Column) -> Column:
    """An array in parts of FOLD."""
    return F.when(F.size(values) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / FOLD).cast("int")), lambda i: F.slice(values, i * FOLD + 1, FOLD)))


def bound(value: Column, use) -> Column:
    """use(value), the value being computed once."""
    return F.transform(F.array(value), use)[0]


def _spans(rule: Rule, place: int, text: Column) -> Column:
    """array of struct(start, place, kind, end): matches and what stands between them, added up. A fold copies what it has at
    each step, so matches are folded in parts, and then the parts: texts with very many matches stay cheap."""
    pattern = F.lit(rule.pattern)
    match, group = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.filter(F.arrays_zip(match.alias("m"), group.alias("g"), F.split(text, rule.pattern, -1).alias("before")), lambda s: s["m"].isNotNull())
    span = "struct<start:long,place:int,kind:string,end:long>"
    zero, empty = F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>")

    def spanned(start: Column, end: Column) -> Column:
        return F.struct(start.cast("long").alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.cast("long").alias("end"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.length(s["before"])
        end = start + F.length(s["m"])
        kept = F.when(F.length(s["g"]) >= rule.least, F.concat(acc["out"], F.array(spanned(start, end)))).otherwise(acc["out"])
        return F.struct(end.cast("long").alias("at"), kept.alias("out"))

    def whole(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda x: spanned(acc["at"] + x["start"], acc["at"] + x["end"]))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    folded = F.transform(parts_of(steps), lambda part: F.aggregate(part, F.struct(zero, empty.alias("out")), step))
    found = F.flatten(F.aggregate(folded, F.struct(zero, F.array().cast(f"array<array<{span}>>").alias("out")), whole, lambda acc: acc["out"]))
    return F.when(text.rlike(rule.pattern), F.coalesce(found, empty)).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with __found: array of struct(start, place, kind, end), ordered by start and then kind."""
    empty = F.array().cast("array<struct<start:long,place:int,kind:string,end:long>>")
    keyed = docs.withColumn("__key", _key()).join(candidates(docs, rules).withColumnRenamed("key", "__key").withColumnRenamed("kinds", "__kinds"), "__key", "left")
    text = F.coalesce("text", F.lit(""))
    parts = []
    for place, rule in enumerate(rules):
        spans = _spans(rule, place, text)
        parts.append(F.when(F.array_contains("__kinds", rule.kind), spans).otherwise(empty) if trigram_query(rule.pattern) else spans)
    return keyed.withColumn("__found", F.array_sort(F.concat(*parts))).drop("__key", "__kinds")


def listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base kinds' spans), spans (of all kinds)."""
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    base = [r.kind for r in RULES if r.base]
    count = lambda kind: F.size(F.filter("__found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, base), F.sha2(listed(F.filter("__found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), listed(F.col("__found")).alias("spans"))


def stretches(spans: Column) -> Column:
    """array of struct(start, end): spans in order, those that overlap as one; folded only where some do."""
    plain = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    apart = F.forall(F.transform(spans, lambda s, i: (i == 0) | (s["start"] >= F.try_element_at(spans, i)["end"])), lambda x: x)

    def step(acc: Column, s: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        fresh = (F.size(acc) == 0) | (s["start"] >= last["end"])
        return F.when(fresh, F.concat(acc, F.array(s))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer)))

    return F.when(apart, plain).otherwise(F.aggregate(plain, F.array().cast("array<struct<start:long,end:long>>"), step))


def _replaced(text: Column, found: Column) -> Column:
    """The text with REDACTED for every stretch. Stretches go in parts, so that a text is walked once a part and a part's own
    text once a stretch."""

    def part(these: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.try_element_at(found, (i * FOLD).cast("int"))["end"])
        stop = F.try_element_at(these, F.lit(-1))["end"]
        body = text.substr((begin + 1).cast("int"), (stop - begin).cast("int"))

        def pieces(y: Column) -> Column:
            def piece(s: Column, j: Column) -> Column:
                after = F.when(j == 0, y["begin"]).otherwise(F.try_element_at(these, j)["end"])
                return F.concat(y["body"].substr((after - y["begin"] + 1).cast("int"), (s["start"] - after).cast("int")), F.lit(REDACTED))

            return F.array_join(F.transform(these, piece), "")

        return bound(F.struct(begin.alias("begin"), body.alias("body")), pieces)

    end = F.try_element_at(found, F.lit(-1))["end"]
    return F.concat(F.array_join(F.transform(parts_of(found), part), ""), text.substr((end + 1).cast("int"), F.length(text)))


def redact(docs: DataFrame) -> DataFrame:
    """The documents (all columns) with every stretch that spans cover replaced by REDACTED."""
    found = scan(docs)
    clean = bound(stretches(F.col("__found")), lambda s: _replaced(F.col("text"), s))
    return found.withColumn("text", F.when(F.size("__found") > 0, clean).otherwise(F.col("text"))).select(*docs.columns)


#: DuckDB's way to the same rows: expressions are matched on every document, without an index. Start and end come from the
#: pieces between matches. Minima are applied after matching.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT r, kind, place, least, string_split_regex(text, p) AS before, regexp_extract_all(text, p, 0) AS m, regexp_extract_all(text, p, g) AS v
  FROM d CROSS JOIN (VALUES
    ('assign', 0, '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
    ('access', 1, 'AKIA[A-Z0-9]+', 0, 20),
    ('hex', 2, '[0-9a-f]+', 0, 24),
    ('github', 3, 'gh[opsu]_[A-Za-z0-9]{36,}', 0, 0),
    ('slack', 4, 'xox[abprs]-[A-Za-z0-9-]{10,}', 0, 0),
    ('private_key', 5, '-----BEGIN [A-Z ]*PRIVATE KEY-----', 0, 0),
    ('jwt', 6, 'eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}', 0, 0)) k(kind, place, p, g, least)
),
u AS (SELECT r, kind, place, least, unnest(m) AS m, unnest(v) AS v, unnest(before[1:len(m)]) AS b, unnest(range(1, len(m) + 1)) AS i FROM m WHERE len(m) > 0),
s AS (
  SELECT r, kind, place, sum(length(b) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS e, length(m) AS n, length(v) >= least AS ok FROM u
),
j AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(e - n AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - n, place) FILTER (place < 3) AS base,
    string_agg(kind || ':' || CAST(e - n AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - n, place) AS spans
  FROM s WHERE ok GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (r)
"""
