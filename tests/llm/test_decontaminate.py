import random

import numpy as np
import pytest

from auditloom.llm import decontaminate as dc
from auditloom.llm import queries


def least_edits(p, s):
    prev = np.zeros(len(s) + 1, int)
    sc = np.array([ord(c) for c in s])
    ramp = np.arange(len(s) + 1)
    for i, ch in enumerate(p, 1):
        cur = np.empty_like(prev)
        cur[0] = i
        cur[1:] = np.minimum(prev[:-1] + (sc != ord(ch)), prev[1:] + 1)
        prev = np.minimum.accumulate(cur - ramp) + ramp
    return int(prev.min())


def brute(rows, items, candidates=None):
    best = []
    for d, (i, t) in enumerate(rows):
        s = dc.normal(t)
        found = {}
        for item, x in items:
            p = dc.normal(x)
            m = len(p)
            if m < dc.Q:
                continue
            k = min(int(dc.EDITS * m), (m - dc.Q) // dc.Q)
            e = 0 if p in s else least_edits(p, s) if candidates is None or (i, item) in candidates else 999
            if e <= k:
                found[item] = min(found.get(item, (e, m)), (e, m))
        best += [(str(i), str(item), e, m) for item, (e, m) in found.items()]
    return sorted(best)


def got(df):
    return sorted((str(r[0]), str(r[1]), r[2], r[3]) for r in df.collect())


def changed(rng, text, n):
    t = list(text)
    for _ in range(n):
        p = rng.randrange(len(t))
        kind = rng.randrange(3)
        if kind == 0:
            t[p] = rng.choice("xyzé ")
        elif kind == 1:
            del t[p]
        else:
            t.insert(p, rng.choice("xyz日"))
    return "".join(t)


@pytest.mark.parametrize("portion", [2_000_000, 300])
def test_edge_cases(spark, make_docs, monkeypatch, portion):
    monkeypatch.setattr(dc, "PORTION", portion)
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choice("aeioutnshrdé") for _ in range(rng.randint(2, 9))) for _ in range(n))
    items = [(k, words(rng.choice([3, 6, 20, 40]))) for k in range(12)] + [(12, None), (13, ""), (14, "short"), (3, "another of the same id here"), (None, "an item without an id but long enough"), (15, "the the the the the the the the the the")]
    rows = [(1, None), (2, ""), (3, "the " * 4000), (None, "see AN item\n without an id but long enough!"), (5, items[0][1]), (5, items[0][1])]
    for k in range(150):
        text = [words(rng.randint(0, 30))]
        for i in rng.sample(range(12), rng.randint(0, 2)):
            text += [changed(rng, items[i][1].upper(), rng.choice([0, 0, 1, 3, 8, 20, 40])), words(rng.randint(0, 9))]
        rows.append((100 + k, rng.choice([" ", "\n", ""]).join(text)))
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = brute(rows, items)
    assert got(dc.matches(make_docs(rows), bench)) == want
    held = {r[0] for r in want}
    left = dc.clean(make_docs(rows), bench)
    assert left.columns == make_docs(rows).columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(i) for i, _ in rows if str(i) not in held)
    assert dc.matches(make_docs([]), bench).count() == 0
    assert dc.matches(make_docs(rows), bench.limit(0)).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    # Brute force where item and document share a run of 15 characters, which 10 edits in 100 characters leave.
    near = set()
    for item, x in items:
        p = dc.normal(x)
        grams = {p[a : a + 9] for a in range(len(p) - 8)}
        near |= {(i, item) for i, t in rows for s in [dc.normal(t)] if len(s) < 20000 and sum(g in s for g in grams) > 5}
    assert got(queries.op9_decontaminate(spark, sf_dir)) == brute(rows, items, near)
