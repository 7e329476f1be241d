import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from auditloom.llm import blocks, lm, queries, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeats(rows):
    docs = sorted(((i, t, WORD.findall(t or "")) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for i, _, words in docs:
        gone = set()
        for s in range(len(words) - 19):
            w = tuple(words[s : s + 20])
            if w in seen:
                gone.update(range(s, s + 20))
            seen.add(w)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((str(i), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def got_repeats(df):
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in df.collect())


@pytest.mark.parametrize("size", [6_000_000, 700])
def test_substring_edge_cases(spark, make_docs, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    monkeypatch.setattr(blocks, "RANGES", 3 if size == 700 else 1000)
    rng = random.Random(1)
    passage = [[f"w{rng.randint(0, 99)}" for _ in range(n)] for n in (19, 20, 21, 50)]
    rows = [(1, None), (2, ""), (None, "x " * 45), (3, "x " * 45), (4, "y\x0b" * 20), (5, "y " * 20 + "Z"), (5, "y " * 20 + "Z"), (6, "y " * 19)]
    for k in range(60):
        w = [f"v{rng.randint(0, 9)}" for _ in range(rng.randint(0, 30))]
        for p in rng.sample(passage, rng.randint(0, 2)):
            w += p + [f"u{rng.randint(0, 9999)}"]
        rows.append((rng.randint(10, 60), " ".join(w)))
    assert got_repeats(substring_dedup.remove_repeats(make_docs(rows))) == brute_repeats(rows)
    assert substring_dedup.remove_repeats(make_docs([])).count() == 0


def test_substring_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got_repeats(queries.op10_substring_dedup(spark, sf_dir)) == brute_repeats(rows)


def test_runs():
    h = np.random.default_rng(0).integers(0, 2**64, 100, dtype=np.uint64)
    for n in (1, 3, 8, 20):
        got = blocks.runs(h, n)
        assert len(got) == 101 - n
        assert (got == blocks.runs(np.concatenate([h[50:], h[:50]]), n)[np.arange(101 - n) - 50])[50:].all()
    x = np.sort(h)
    assert (blocks.unpacked(blocks.packed(x)) == x).all()
    assert [k for p, s in blocks.cut_parts(x, 8) for k in x[s]] == x.tolist()
    assert (substring_dedup.sliding_min(h, 13) == [h[i : i + 13].min() for i in range(88)]).all()


def brute_lm(rows):
    docs = []
    for i, t in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 10 == 0
        docs.append((i, held, WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]))
    c, pair, follow = Counter(), Counter(), defaultdict(set)
    for _, held, tokens in docs:
        if not held:
            c.update(tokens)
            for u, w in zip(["\n", *tokens], tokens):
                pair[u, w] += 1
                follow[u].add(w)
    n, v = sum(c.values()), len(c)
    p0 = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for i, held, tokens in docs:
        score = 0.0
        for u, w in zip(["\n", *tokens], tokens):
            p = p0(w)
            if c[u]:
                p = max(pair[u, w] - 0.75, 0) / c[u] + 0.75 * len(follow[u]) / c[u] * p
            score += math.log10(p)
        out.append((str(i), held, len(tokens), sum(c[w] > 0 for w in tokens), n, round(sum(math.log10(p0(w)) for w in tokens), 6), round(score, 6)))
    return sorted(out, key=str)


def got_lm(df):
    return sorted(((str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6), round(r[6], 6)) for r in df.collect()), key=str)


def close(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-5)


@pytest.mark.parametrize("size", [6_000_000, 300])
def test_lm_edge_cases(spark, make_docs, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    rng = random.Random(2)
    rows = [(1, None), (2, ""), (None, "a B c"), (3, "É é A"), (3, "É é A"), (4, "zz " * 3000)]
    rows += [(k, " ".join(rng.choice("abcdefgh") + rng.choice(["", "x", ","]) for _ in range(rng.randint(0, 40)))) for k in range(10, 90)]
    close(got_lm(lm.score(make_docs(rows))), brute_lm(rows))
    assert lm.score(make_docs([])).count() == 0
    held = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    close(got_lm(lm.score(make_docs([(held, "only held out")]))), brute_lm([(held, "only held out")]))


def test_lm_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = got_lm(queries.op5_lm_score(spark, sf_dir))
    close(got, brute_lm(rows))
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)
