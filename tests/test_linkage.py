"""Average linkage by rounds against the whole matrix."""

import numpy as np
import pytest

from auditloom.operators import linkage


def plain(groups, threshold):
    """Least members of each vector's cluster, by merging the nearest pair again and again."""
    out = {}
    for g, rows in groups.items():
        ids, x = [i for i, _ in rows], np.array([v for _, v in rows], float)
        norm = np.sqrt((x * x).sum(axis=1))
        x = x / np.where(norm > 0, norm, 1)[:, None]
        d = 1 - x @ x.T
        held = [[k] for k in range(len(ids))]
        while len(held) > max(1, int(len(ids) * (1 - threshold))):
            a, b = min(((a, b) for a in range(len(held)) for b in range(a)), key=lambda p: (round(d[np.ix_(held[p[0]], held[p[1]])].mean(), 10), min(held[p[1]] + held[p[0]])))
            held[b] += held.pop(a)
        out |= {(g, ids[k]): min(ids[j] for j in h) for h in held for k in h}
    return out


@pytest.mark.parametrize("local,block,threshold", [(1000, 2000, 0.85), (10, 9, 0.85), (10, 2000, 0.4), (10, 25, 1.0)])
def test_same_clusters(spark, monkeypatch, local, block, threshold):
    monkeypatch.setattr(linkage, "LOCAL", local)
    monkeypatch.setattr(linkage, "BLOCK", block)
    r = np.random.default_rng(7)
    groups = {0: [(i, r.standard_normal(6).tolist()) for i in range(60)], 1: [(100 + i, (np.eye(6)[i % 4] + 0.2 * r.standard_normal(6)).tolist()) for i in range(25)], 2: [(200, [1.0] * 6)], 3: [(300 + i, r.standard_normal(6).tolist()) for i in range(8)]}
    groups[0].append((70, [0.0] * 6))
    rows = [(g, i, v) for g, vs in groups.items() for i, v in vs] + [(None, 1000, [1.0] * 6), (5, None, [1.0] * 6), (5, 1001, None)]
    found = linkage.agglomerative(spark.createDataFrame(rows, "report int, vec_id long, embedding array<double>"), "report", threshold).collect()
    least = {}
    for x in found:
        key = (x["report"], x["cluster"])
        least[key] = min(least.get(key, 10**9), x["vec_id"])
    assert {(x["report"], x["vec_id"]): least[x["report"], x["cluster"]] for x in found} == plain(groups, threshold)
    for g in groups:  # numbered by least members
        mine = sorted((v, k[1]) for k, v in least.items() if k[0] == g)
        assert [c for _, c in mine] == list(range(len(mine)))
