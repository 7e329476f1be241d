"""Source divergence against plain loops, and the query against its SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from auditloom.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top=50):
    docs = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    df, counts, totals = Counter(), Counter(), Counter()
    for lang, source, terms in docs:
        df.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
        totals.update((lang, t) for t in terms)
    out = []
    groups = sorted({d[:2] for d in docs})
    for lang, source in groups:
        kept = [t for (k, t), n in df.items() if k == lang and n >= min_docs]

        def shares(c):
            n = sum(c(t) for t in kept)
            return {t: 1 + 10**9 * (c(t) + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = shares(lambda t: counts[lang, source, t]), shares(lambda t: totals[lang, t])
        pair = []
        for other_lang, other in groups:
            if other_lang == lang and other != source:
                o = shares(lambda t, other=other: counts[lang, other, t])
                pair.append((-sum(abs(p[t] - o[t]) for t in kept), other.encode()))
        term = [(q[t] - p[t], t.encode()) for t in kept if counts[lang, source, t] and p[t] > q[t]]
        for part, found in (("pair", pair), ("term", sorted(term)[:top])):
            out += [(lang, source, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(sorted(found), 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(k, 1, *r, "x", 5) for k, r in enumerate(rows)], "doc_id long, v long, lang string, source string, text string, term string, gb int")


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("groups,terms", [(32, 8192), (2, 5)])
def test_against_loops(spark, monkeypatch, groups, terms):
    """Nulls, empty texts, repeated rows, languages and groups without kept terms, ties, a hot source; many cells and few."""
    monkeypatch.setattr(divergence, "GROUPS", groups)
    monkeypatch.setattr(divergence, "TERMS", terms)
    rng = random.Random(3)
    words = ["The", "THE", "né", "Né", "x1y", "a_b", "日本", "q r", "z\x00w", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = [(None, None, None), ("en", None, ""), ("xx", "only", "rare"), ("xx", "other", None), ("en", "empty", " \n1")]
    for _ in range(150):
        source = "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 6)}"
        rows.append((rng.choice(["en", "de", None]), source, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))))
    rows += rows[10:20]
    assert got(divergence.report(frame(spark, rows), top=4, min_docs=6)) == brute(rows, 6, 4)


def test_empty_and_long(spark, monkeypatch):
    assert divergence.report(frame(spark, [])).count() == 0
    monkeypatch.setattr(divergence, "FLUSH", 1000)
    rows = [("en", f"s{k % 3}", " ".join(f"w{chr(97 + j % (3 + k % 5))}" for j in range(5000 if k else 60_000))) for k in range(8)]
    assert got(divergence.report(frame(spark, rows), min_docs=3)) == brute(rows, 3)


def test_shares_are_exact():
    rng = random.Random(0)
    for _ in range(300):
        total = rng.choice([rng.randint(5, 100), rng.randint(1, 9 * 10**15)])
        n = rng.randint(0, max(0, total - 5))
        assert divergence.shares(np.array([n]), np.array([total]))[0] == 1 + 10**9 * (n + 5) // total


def test_query_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = queries.op11_source_divergence(spark, sf_dir)
    want = duckdb.sql(divergence.SQL)
    assert df.columns == want.columns
    assert got(df) == sorted(want.fetchall())
