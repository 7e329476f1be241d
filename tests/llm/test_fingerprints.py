"""Fingerprints: the report against plain loops, the sums as a multiset hash, likeness against exact cosines."""

import hashlib
import random

import numpy as np
import pytest

from auditloom.llm import blocks, fingerprints, queries

ROW = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def one(text):
    return fingerprints.fingerprints([fingerprints.paragraphs(text)])


def brute(spark, rows):
    """Neighbours by plain sorting; rows of one id in the order of the hash that the docstring names."""
    hashes = [r[0] for r in spark.createDataFrame(list(enumerate(rows)), "n long, r struct<i:long,t:string>").selectExpr("xxhash64(r.i, r.t) h", "n").orderBy("n").collect()] if rows else []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] if rows[k][0] is not None else -(2**63), hashes[k]))
    out = []
    for k, following in zip(order, order[1:] + order[:1]):
        t, n = rows[k][1] or "", rows[following][1] or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, e, b = one(t), one(edited), one(n)
        near = [round(float(fingerprints.likeness(a, x)[0]), 9) for x in (e, b)]
        out.append((rows[k][0], len(t), hashlib.sha256(edited.encode()).hexdigest(), a.tobytes().hex(), e.tobytes().hex(), *near))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ROW
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


def texts(rng):
    words = [f"w{i}" for i in range(40)] + ["é", "日本", "𝒳"]
    return "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(0, 6)))


@pytest.mark.parametrize("size", [6_000_000, 300])
def test_report(spark, make_docs, monkeypatch, size):
    """Nulls, empty and long texts, repeated rows, ids with other texts, a third of all rows equal; one range and many."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    monkeypatch.setattr(fingerprints, "RANGE_BYTES", size)
    rng = random.Random(size)
    rows = [(rng.choice([None, rng.randint(-50, 300)]), texts(rng)) for _ in range(150)] + [(9, "x"), (10, None), (11, ""), (12, "\n\n"), (9, "y")]
    rows += [(40, "same words here\nand more")] * 80 + [(2**62, "word " * 30_000)]
    assert got(fingerprints.report(make_docs(rows))) == brute(spark, rows)
    assert fingerprints.report(make_docs([])).count() == 0
    assert got(fingerprints.report(make_docs([(5, "only one")]))) == brute(spark, [(5, "only one")])


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op12_fingerprints(spark, sf_dir)) == brute(spark, rows)


def test_multiset_hash(spark):
    rng = random.Random(2)
    lines = [texts(rng).replace("\n", " ") or "-" for _ in range(12)]
    shuffled = rng.sample(lines, len(lines))
    assert (one("\n".join(lines)) == one("\r\n".join(shuffled))).all()
    seen = {one("\n".join(lines[:k])).tobytes() for k in range(13)} | {one("\n".join(lines + [lines[0]])).tobytes()}
    assert len(seen) == 14  # each multiset has its own
    docs = spark.createDataFrame([(k, "\n".join(lines[:k])) for k in range(6)], "doc_id long, text string")
    # document k loses its first line and gains the lines 6 and 7, one of them twice
    changes = [(k, lines[0], -1) for k in range(1, 6)] + [(k, lines[6], 1) for k in range(7)] + [(k, lines[7], 2) for k in range(6)] + [(None, "x", 1), (3, None, 1), (3, "x", None)]
    after = fingerprints.updated(fingerprints.fingerprint(docs), spark.createDataFrame(changes, "doc_id long, paragraph string, times long"))
    want = {k: one("\n".join(lines[1:k] + [lines[6], lines[7], lines[7]])).tobytes() for k in range(1, 6)}
    want |= {0: one("\n".join([lines[6], lines[7], lines[7]])).tobytes(), 6: one(lines[6]).tobytes()}
    assert {r[0]: bytes(r[1]) for r in after.collect()} == want


def test_likeness():
    rng = random.Random(8)
    long = lambda: " ".join(f"v{rng.randint(0, 5000)}" for _ in range(400))
    halves, others, same = [], [], []
    for _ in range(60):
        t, u = long(), long()
        half = " ".join(t.split()[:200] + u.split()[:200])
        halves.append(float(fingerprints.likeness(one(t), one(half))[0]))
        others.append(float(fingerprints.likeness(one(t), one(u))[0]))
        same.append(float(fingerprints.likeness(one(t), one(t))[0]))
    assert abs(np.mean(halves) - 0.5) < 0.05 and max(others) < 0.3 and min(halves) > 0.3 and set(same) == {1.0}
    assert float(fingerprints.likeness(one(""), one("a b c"))[0]) == 0.0
    assert float(fingerprints.likeness(one(""), one(None))[0]) == 1.0
