import random
import re

import numpy as np
import pytest
import xxhash

from auditloom.llm import components, embedding_dedup, queries, simhash


def closure(nodes, links):
    """The smallest node reachable."""
    at = {n: n for n in nodes}

    def root(n):
        while at[n] != n:
            n = at[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return {n: root(n) for n in nodes}


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_simhash(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    known = [(i, f) for i, f in prints if i is not None]
    f = np.array([x for _, x in known], np.uint64)
    ids = [i for i, _ in known]
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None]) <= 4))] if ids else []
    c = closure(ids, links)
    return sorted((str(i), f"{x:016x}", str(c.get(i))) for i, x in prints)


def got_simhash(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


@pytest.mark.parametrize("cell", [2048, 3])
def test_simhash_edge_cases(spark, make_docs, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    rng = random.Random(3)
    base = [rng.choice(["alpha", "Beta", "gamma", "delta", "épsilon"]) + str(rng.randint(0, 40)) for _ in range(400)]
    rows = [(5, None), (4, ""), (9, " \t\n"), (None, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"), (7, "A B C D E"), (3, "one"), (2, "x " * 30000), (6, "one  two three")]
    for k in range(40):
        w = list(base)
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "changed"
        rows.append((100 + k, " ".join(w)))
    assert got_simhash(simhash.near_duplicates(make_docs(rows))) == brute_simhash(rows)


@pytest.mark.parametrize("m", [0, 5, 6])
def test_every_pair_within_distance_is_found(spark, monkeypatch, m):
    monkeypatch.setattr(simhash, "finer_blocks", lambda n: m)
    rng = np.random.default_rng(m)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    fps = set(base.tolist())
    for x in base:
        y = int(x)
        for _ in range(3):
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                y ^= 1 << int(b)
            fps.add(y)
    nodes = [(i, f) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in nodes], "node long, fp long")
    found = components.connected_components(simhash.links(df, 10)).collect()
    f = np.array([x for _, x in nodes], np.uint64)
    want = closure(range(len(nodes)), zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None]) <= 4)))
    got = {i: i for i, _ in nodes} | {r["node"]: r["component"] for r in found}
    assert got == want


def test_golay_covers():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 1 << 23, 2000)
    near = simhash.anchors(x)
    d = np.where(near >= 0, np.bitwise_count((near ^ x[:, None]).astype(np.uint64)), 99)
    assert (d[:, 0] <= 3).all() and (np.sort(d[:, 1:], axis=1)[:, 0] >= 4).all()
    y = x ^ (1 << rng.integers(0, 23, 2000))
    assert (simhash.anchors(y) == near[:, :1]).any(axis=1).all()


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 300 + i) for i in range(30)] + [(rng.randint(400, 440), rng.randint(400, 440)) for _ in range(25)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and a != b]
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == closure({x for p in real for x in p}, real)
    assert components.connected_components(df.filter("a = 7 and b = 7")).count() == 0


def test_simhash_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert got_simhash(queries.op7_simhash(spark, sf_dir)) == brute_simhash(rows)


def brute_vectors(rows):
    def sound(v, lab, i):
        return i is not None and lab is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [k for k, (i, v, lab) in enumerate(rows) if sound(v, lab, i)]
    n, links = {k: 0 for k in range(len(rows))}, []
    for a in ok:
        for b in ok:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    n[a] += 1
                    n[b] += 1
                    links.append((a, b))
    c = closure(range(len(rows)), links)
    least = {}
    for k in ok:
        least[c[k]] = min(least.get(c[k], rows[k][0]), rows[k][0])
    out = []
    for k, (i, _, _) in enumerate(rows):
        comp = least.get(c[k], i) if k in ok else i
        out.append((str(i), n[k], str(comp), str(None if i is None else i == comp)))
    return sorted(out)


@pytest.mark.parametrize("cell", [1024, 4])
def test_embeddings(spark, monkeypatch, cell):
    monkeypatch.setattr(embedding_dedup, "CELL", cell)
    rng = np.random.default_rng(4)
    rows, i = [], 50
    for lab in (0, 1, None):
        for _ in range(12):
            v = rng.standard_normal(16)
            for k in range(rng.integers(1, 9)):
                w = v + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.15])
                rows.append((i, (w * rng.choice([1.0, 2.0])).tolist(), lab))
                i += 1
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [float("nan")] * 16, 0), (5, [None] + [1.0] * 15, 0), (6, [float("inf")] * 16, 1), (None, [1.0] * 16, 1), (7, [1.0] * 16, 1), (8, [1.0] * 8, 1), (7, [1.0] * 16, 1), (7, [-1.0] * 16, 0), (9, [-0.0] + [1.0] * 15, 1), (10, [0.0] + [1.0] * 15, 1)]
    df = spark.createDataFrame([(a, b, c, "x") for a, b, c in rows], "vec_id long, embedding array<float>, label int, node string")
    f32 = [(a, None if b is None else [None if x is None else float(np.float32(x)) for x in b], c) for a, b, c in rows]
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), str(r["kept"])) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == brute_vectors(f32)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_query_and_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), str(r["kept"])) for r in queries.op1_embedding_dedup(spark, sf_dir).collect())
    assert got == brute_vectors(rows)
