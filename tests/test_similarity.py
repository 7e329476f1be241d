"""The pivot join against all pairs: same pairs, same components, each pair compared once, fewer comparisons where data cluster."""

import numpy as np
import pytest

from auditloom.operators import dedup, similarity


def vectors(seed, n, dim, centres, spread):
    r = np.random.default_rng(seed)
    middle = r.standard_normal((centres, dim))
    return [(int(k), (middle[k % centres] + spread * r.standard_normal(dim)).tolist()) for k in r.permutation(n)]


def brute(rows, threshold):
    out = {}
    for d in {len(v) for _, v in rows}:
        some = sorted((i, v) for i, v in rows if len(v) == d and any(v))
        ids, x = np.array([i for i, _ in some]), np.array([v for _, v in some], float)
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
        p, q = np.nonzero(np.triu(x @ x.T >= threshold, 1))
        out |= {(int(ids[a]), int(ids[b])): round(float(x[a] @ x[b]), 9) for a, b in zip(p, q)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("threshold,inner,outer", [(0.4, 2000, 16_000), (0.9, 7, 11), (-0.2, 20, 30)])
def test_pairs(spark, monkeypatch, threshold, inner, outer):
    monkeypatch.setattr(similarity, "INNER", inner)
    monkeypatch.setattr(similarity, "OUTER", outer)
    monkeypatch.setattr(similarity, "STEP", max(3, inner // 4))
    rows = vectors(1, 150, 8, 5, 0.5) + [(1000 + i, v) for i, v in vectors(2, 20, 3, 2, 0.1)] + [(2000, [0.0] * 8), (2001, [1.0] * 8), (2002, [2.0] * 8)]
    bad = [(3000, None), (None, [1.0] * 8), (3001, [1.0, None]), (3002, [float("nan")] * 8), (3003, [])]
    got = similarity.pairs(frame(spark, rows + bad), threshold).collect()
    assert len(got) == len({(r["i"], r["j"]) for r in got})
    assert {(r["i"], r["j"]): round(r["sim"], 9) for r in got} == brute(rows, threshold)
    assert similarity.pairs(frame(spark, []), threshold).count() == 0


@pytest.mark.parametrize("small", [0, 10_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr(similarity, "INNER", 15)
    monkeypatch.setattr(similarity, "STEP", 6)
    monkeypatch.setattr(dedup, "SMALL", small)
    rows = vectors(3, 120, 16, 9, 0.35)
    label = {i: i for i, _ in rows}
    links = brute(rows, 0.6)
    for _ in rows:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    linked = {i for p in links for i in p}
    got = {r["vec_id"]: r["root"] for r in dedup.dbscan(frame(spark, rows), 0.4).collect()}
    assert got == {i: label[i] if i in linked else None for i, _ in rows} and len(set(got.values())) > 3
    # Links are a few a vector, not all pairs.
    assert similarity.stars(frame(spark, rows), 0.6).count() <= 2 * len(rows)


def work(spark, rows, threshold):
    found = similarity.dealt(frame(spark, rows), threshold).selectExpr(*similarity.UNIT, "int(inner) AS i", "int(NOT inner) AS o").groupBy(*similarity.UNIT).sum("i", "o").collect()
    return sum(r["sum(i)"] * (r["sum(o)"] + (r["sum(i)"] / 2 if r["share"] == 0 else 0)) for r in found)


def test_work_is_below_a_quarter_of_all_pairs_where_data_cluster(spark):
    n = 3000
    rows = vectors(4, n, 32, 30, 0.12)
    assert work(spark, rows, 0.8) < n * n / 2 / 4
    assert work(spark, vectors(5, 600, 32, 600, 1.0), 0.4) <= 600 * 600 / 2 + 600  # without structure: all pairs once, no more
