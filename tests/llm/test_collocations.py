"""Collocations against plain loops, and the query against its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from auditloom.llm import collocations, queries


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f[lang].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        many = {tuple(p.split(" ")): c for p, c in counts.items() if c >= least}
        kept = []
        for p, a in many.items():
            if len(p) < 2:
                continue
            if any(len(q) > len(p) and 100 * c >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in many.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (many[p[:k]] * many[p[k:]]), k, many[p[:k]], many[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, lang string, text string, k int, phrase string")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(rng):
    words = ["The", "of", "é", "x-y", "a\x1cb", *(f"w{i}" for i in range(12))]
    passage = [rng.choice(words) for _ in range(9)]
    rows = [(1, None, None), (2, "en", ""), (None, "en", " .,\n;"), (3, "de", "one")]
    for i in range(200):
        w = [rng.choice(words) + rng.choice(["", "", "", ".", ",\t", "\n", "\x0b", "  "]) for _ in range(rng.randint(0, 40))]
        rows.append((rng.choice([None, i, 7]), rng.choice(["en", "en", None, "fr"]), " ".join(w + (passage if i % 3 else []))))
    return rows + rows[20:40] * 3


@pytest.mark.parametrize("least,sample,flush,slices", [(10, 4, 3_000_000, 256), (6, 1000, 500, 1), (3, 2, 200, 2)])
def test_against_loops(spark, monkeypatch, least, sample, flush, slices):
    """A fair sample, one of (nearly) no documents, whose every phrase is a border failure, and small flushes."""
    monkeypatch.setattr(collocations, "FLUSH", flush)
    monkeypatch.setattr(collocations, "SLICES", slices)
    rows = corpus(random.Random(least))
    assert got(collocations.collocations(frame(spark, rows), least, 30, sample)) == brute(rows, least, 30)
    assert collocations.collocations(frame(spark, [])).count() == 0


def test_colliding_keys_and_full_filters(spark, monkeypatch):
    """Counts stay exact when keys collide (few hash bits) and when the filter lets everything through."""
    rows = corpus(random.Random(1))[:120]
    want = brute(rows, 5, 30)
    monkeypatch.setattr(collocations.Known, "has", lambda self, keys: np.ones(len(keys), bool))
    assert got(collocations.collocations(frame(spark, rows), 5, 30)) == want
    monkeypatch.undo()
    whole = collocations.tagged
    monkeypatch.setattr(collocations, "tagged", lambda x, k: whole(x, k) & np.uint64(0xF000000000000007))
    assert got(collocations.collocations(frame(spark, rows), 5, 30)) == want


def test_one_long_text(spark):
    rng = random.Random(4)
    rows = [(1, "en", " ".join(rng.choice("abcdefgh") for _ in range(60_000))), (2, "en", None)]
    assert got(collocations.collocations(frame(spark, rows), 100, 50)) == brute(rows, 100, 50)


def test_query_equals_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    df = queries.op13_collocations(spark, sf_dir)
    want = duckdb.sql(collocations.SQL)
    assert df.columns == want.columns
    assert got(df) == sorted(want.fetchall())
