"""Operators that are cut into ranges or read in order, against plain loops over the whole."""

import datetime
import hashlib
import random

from auditloom.operators import cost, dedup, evaluate, telemetry

START = datetime.datetime(2024, 1, 1)


def test_chain_across_ranges(spark):
    r = random.Random(5)
    rows = [(i, r.choice(["a", "b", None]), f"k{i % 3}", "low") for i in r.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "event_id long, mode string, alert_id string, severity string")
    last, want = {}, set()
    for event, mode, alert, severity in sorted(rows):
        sha = hashlib.sha256(f"{event}|{alert}|{severity}".encode()).hexdigest()
        want.add((event, sha[:16], event % 97 != 0))
        last[mode] = sha
    got = {tuple(x) for x in telemetry.chained(df, width=7).collect()}
    assert got == want and None in last


def test_admitted_pieces(spark):
    r = random.Random(6)
    times = [r.choice([0, 5 * 3600, 9 * 3600]) + r.randrange(5400) for _ in range(300)]
    rows = [(i, r.choice(["a", "b", None]), START + datetime.timedelta(seconds=t)) for i, t in enumerate(times)] + [(300, "a", None)]
    want, kept = {300: False}, {}
    for event, mode, ts in sorted(rows[:-1], key=lambda x: (x[2], x[0])):
        mine = kept.setdefault(mode, [])
        ok = sum(ts - t < datetime.timedelta(hours=1) for t in mine) < 3 and not any(ts - t < datetime.timedelta(minutes=1) for t in mine)
        mine += [ts] * ok
        want[event] = ok
    got = dict(map(tuple, telemetry.admitted(spark.createDataFrame(rows, "event_id long, mode string, ts timestamp")).collect()))
    assert got == want and 0 < sum(want.values()) < 300


def test_fold_over_batches(spark):
    r = random.Random(7)
    rows = [(r.choice([1, 2, None]), i, r.choice("ab"), r.choice([None, 3, 40])) for i in range(400)]
    state, want = {}, {}
    for run, seq, stage, cents in rows:
        s = state.setdefault(run, {"spent": 0, "b": 0, "over": False})
        ok = s["spent"] + (cents or 0) <= 1000
        s["over"] |= not ok
        ok = ok and (stage != "b" or s["b"] + (cents or 0) <= 90)
        s["spent"] += (cents or 0) * ok
        s["b"] += (cents or 0) * (ok and stage == "b")
        want[seq] = (ok, s["spent"], s["over"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = cost.fold(spark.createDataFrame(rows, "run_id long, seq long, stage string, cents long"), 1000, {"b": 90}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {x["seq"]: (x["accepted"], x["spent"], x["exceeded"]) for x in got} == want


def test_false_discovery_over_ranges(spark):
    r = random.Random(8)
    rows = [(i, r.choice([0.001, r.random() ** 3, r.random()])) for i in range(300)] + [(300, None)]
    ordered = sorted((p, i) for i, p in rows[:-1])
    n, low, want = len(ordered), 1.0, {}
    for rank in range(n, 0, -1):
        p, i = ordered[rank - 1]
        low = min(low, p * n / rank)
        want[i] = (rank, round(low, 9), low <= 0.05)
    got = evaluate.false_discovery(spark.createDataFrame(rows, "id long, p double").repartition(3)).collect()
    assert {x["id"]: (x["rank"], round(x["adjusted"], 9), x["rejected"]) for x in got} == want
    assert evaluate.false_discovery(spark.createDataFrame([], "id long, p double")).count() == 0


def test_agglomerative_by_all_pairs(spark):
    r = random.Random(9)
    rows = [(g, i, [r.gauss(0, 1) for _ in range(3)]) for g in (1, 2) for i in range(g * 40, g * 40 + 30)]

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    want = set()
    for g in (1, 2):
        vectors = {i: v for h, i, v in rows if h == g}
        clusters = [{i} for i in vectors]
        while len(clusters) > max(1, int(len(vectors) * 0.15)):
            far = lambda a, b: sum(1 - cosine(vectors[i], vectors[j]) for i in a for j in b) / len(a) / len(b)
            a, b = min(((a, b) for k, a in enumerate(clusters) for b in clusters[:k]), key=lambda p: far(*p))
            clusters = [c for c in clusters if c not in (a, b)] + [a | b]
        want |= {frozenset(c) for c in clusters}
    got = {}
    for x in dedup.agglomerative(spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>"), "label", 0.85).collect():
        got.setdefault((x["label"], x["cluster"]), set()).add(x["vec_id"])
    assert {frozenset(c) for c in got.values()} == want


def test_weights_by_plain_arithmetic():
    import numpy as np

    r = random.Random(12)
    ids = [0, 1, evaluate.PRIME - 1] + [r.randrange(evaluate.PRIME) for _ in range(40)]
    each = [(i * 48_271 + 12_345) % evaluate.PRIME for i in range(1, 2001)]
    y = [[(a * 16_807 + e) % evaluate.PRIME for e in each] for a in ids]
    want = [[sum((v * 69_621 % evaluate.PRIME + v * v % evaluate.PRIME) % evaluate.PRIME / evaluate.PRIME >= c for c in evaluate.POISSON) for v in row] for row in y]
    got = evaluate._weights(np.array(ids, np.int64) * 16_807 % evaluate.PRIME, np.array(each, np.int64))
    assert got.tolist() == want
    # Sums that are 0, 1, 2 and PRIME - 1 before and after they are folded.
    assert evaluate._weights(np.array([0, evaluate.PRIME - 69_621, evaluate.PRIME - 1]), np.array([0, 1])).tolist()[0][0] == 0


def test_draws_are_dealt_evenly(spark):
    """A small file is one split, but its rows are much work."""
    values = spark.range(100).selectExpr("id", "1.0D AS a", "0.5D AS b").coalesce(1)
    plan = evaluate.bootstrap(values, 10)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
