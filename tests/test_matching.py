"""Findings against labels by brute force, as the reference's loops do it."""

import random

from auditloom.operators import evaluate


def near(found, label):
    a, b = found.rsplit(":", 1), label.rsplit(":", 1)
    if len(a) != 2 or len(b) != 2 or not a[1].isdigit() or not b[1].isdigit():
        return False
    return (a[0] == b[0] or a[0].endswith(b[0].split("/")[-1])) and abs(int(a[1]) - int(b[1])) <= 5


def places(seed, n):
    draw = random.Random(seed)
    names = ["foo.c", "xfoo.c", "src/foo.c", "lib/xfoo.c", "a/b/main.rs", "main.rs", "c", "src/", "", "other/c"]
    return [draw.choice(["nowhere", "a.c:x"]) if draw.random() < 0.05 else f"{draw.choice(names)}:{draw.randint(1, 60)}" for _ in range(n)]


def test_band_join_by_base_name(spark, monkeypatch):
    found, labels = places(1, 80), places(2, 60)
    f = spark.createDataFrame(list(enumerate(found)), "finding_id long, location string")
    t = spark.createDataFrame(list(enumerate(labels)), "vuln_id long, location string")
    want = sorted((i, j) for i, a in enumerate(found) for j, b in enumerate(labels) if near(a, b))
    assert any(found[i].rsplit(":", 1)[0] != labels[j].rsplit(":", 1)[0] for i, j in want)
    for cell in (1000, 3):
        monkeypatch.setattr(evaluate, "CELL", cell, raising=False)
        assert sorted((r["finding_id"], r["vuln_id"]) for r in evaluate.band_join(f, t).collect()) == want


def test_greedy_match_by_brute_force(spark):
    draw = random.Random(5)
    cwes, classes = ["CWE-1", "cwe-1", "CWE-2", "CWE-3", None], ["race", "race_condition", "auth-bypass", "auth_bypass", "x"]
    found = [(i, p, draw.choice(cwes), draw.choice(classes)) for i, p in enumerate(places(3, 120))]
    labels = [(i, p, draw.choice(cwes), draw.choice(classes).replace("-", "_")) for i, p in enumerate(places(4, 70))]
    taken, want = set(), []
    for i, place, cwe, cls in found:
        best = (0, None)
        for j, at, t_cwe, t_cls in labels:
            points = 5 if place == at else 3 if near(place, at) else 0
            points += 3 * bool(cwe and t_cwe and cwe.upper() == t_cwe.upper())
            a, b = t_cls.replace("_", ""), cls.replace("_", "").replace("-", "")
            points += 2 * (a in b or b in a)
            if j not in taken and points >= 5 and points > best[0]:
                best = (points, j, "cwe_only" if place != at and not near(place, at) else "exact" if points >= 8 else "fuzzy")
        if best[1] is not None:
            taken.add(best[1])
            want.append((i, best[1], best[0], best[2]))
    assert {kind for *_, kind in want} == {"exact", "fuzzy", "cwe_only"}
    f = spark.createDataFrame(found, "finding_id long, location string, cwe_id string, bug_class string")
    t = spark.createDataFrame(labels, "vuln_id long, location string, cwe_id string, category string")
    assert sorted(map(tuple, evaluate.greedy_match(evaluate.scored_pairs(f, t), f, t).collect())) == want


def scored(found, labels, by_path):
    """(match_type, points) -> pairs and sum of finding ids, of all pairs."""
    out = {}
    for i, place, cwe, cls in found:
        for _, at, t_cwe, t_cls in labels:
            close = near(place, at) and (not by_path or place.rsplit(":", 1)[0] == at.rsplit(":", 1)[0])
            where = 5 if place == at else 3 if close else 0
            points = where + 3 * bool(cwe and t_cwe and cwe.upper() == t_cwe.upper())
            a, b = t_cls.replace("_", "").replace("-", ""), cls.replace("_", "").replace("-", "")
            points += 2 * (a in b or b in a)
            if points >= 5:
                key = ("cwe_only" if not where else "exact" if points >= 8 else "fuzzy", points)
                n, ids = out.get(key, (0, 0))
                out[key] = (n + 1, ids + i)
    return out


def both_tables(spark, n, m):
    draw = random.Random(11)
    cwes, classes = ["CWE-1", "cwe-1", "CWE-2", None], ["race", "race_condition", "auth-bypass", "x"]
    found = [(i, p, draw.choice(cwes), draw.choice(classes)) for i, p in enumerate(places(6, n))]
    labels = [(i, p, draw.choice(cwes), draw.choice(classes)) for i, p in enumerate(places(7, m))]
    return found, labels, spark.createDataFrame(found, "finding_id long, location string, cwe_id string, bug_class string"), spark.createDataFrame(labels, "vuln_id long, location string, cwe_id string, category string")


def test_summary_counts_without_pairs(spark, monkeypatch):
    found, labels, f, t = both_tables(spark, 200, 90)
    monkeypatch.setattr(evaluate, "band_join", None)  # pairs are not listed
    for by_path in (False, True):
        got = {(r["match_type"], r["points"]): (r["n"], r["ids"]) for r in evaluate.match_summary(f, t, same_path=by_path).collect()}
        assert got == scored(found, labels, by_path)
    assert evaluate.match_summary(f.limit(0), t).count() == 0


def test_summary_of_sums_beyond_64_bits(spark):
    big = 2**62
    f = spark.createDataFrame([(big - i, f"a/foo.c:{i}", "CWE-1", "race") for i in range(6)], "finding_id long, location string, cwe_id string, bug_class string")
    t = spark.createDataFrame([(i, f"a/foo.c:{90 * i}", "cwe-1", "race") for i in range(3)], "vuln_id long, location string, cwe_id string, category string")
    want = {("exact", 10): (1, big), ("exact", 8): (5, 5 * big - 15), ("cwe_only", 5): (12, 12 * big - 30)}
    for by_path in (False, True):
        assert {(r["match_type"], r["points"]): (r["n"], r["ids"]) for r in evaluate.match_summary(f, t, same_path=by_path).collect()} == want


def test_who_is_met_without_pairs(spark):
    found, labels, f, t = both_tables(spark, 60, 90)
    edge = spark.createDataFrame([(900, "foo.c:2147483647"), (901, "foo.c:-2147483648")], "id long, location string")
    f = f.select("finding_id", "location").unionByName(edge.select(edge["id"].alias("finding_id"), "location"))
    pairs = [(i, j) for i, a, *_ in found for j, b, *_ in labels if near(a, b)]
    assert sorted(r[0] for r in evaluate.labels_met(f, t).collect()) == sorted({j for _, j in pairs})
    assert sorted(r[0] for r in evaluate.findings_met(f, t).collect()) == sorted({i for i, _ in pairs})
    assert {r["vuln_id"] for r in evaluate.band_join(f, t, same_path=True).collect()} == {r[0] for r in evaluate.labels_met(f, t, same_path=True).collect()}


def test_greedy_assignment_without_pairs(spark, monkeypatch):
    found, labels, f, t = both_tables(spark, 400, 150)
    f = f.unionByName(f.filter("finding_id % 7 = 0").selectExpr("finding_id", "'foo.c:9' AS location", "cwe_id", "bug_class"))
    t = t.unionByName(t.filter("vuln_id % 9 = 0").selectExpr("vuln_id", "'foo.c:9' AS location", "cwe_id", "category"))
    nulls = f.limit(3).selectExpr("cast(null AS bigint) AS finding_id", "location", "cwe_id", "bug_class").unionByName(f.limit(2).selectExpr("finding_id + 900 AS finding_id", "cast(null AS string) AS location", "cwe_id", "cast(null AS string) AS bug_class"))
    f = f.unionByName(nulls).repartition(3)
    want = sorted(map(tuple, evaluate.greedy_match(evaluate.scored_pairs(f, t), f, t).collect()))
    assert {kind for *_, kind in want} == {"exact", "fuzzy", "cwe_only"}
    monkeypatch.setattr(evaluate, "band_join", None)  # pairs are not listed
    for block in (1000, 7):  # blocks of several findings, one finding over two blocks
        monkeypatch.setattr(evaluate, "BLOCK", block)
        assert sorted(map(tuple, evaluate.greedy_assignment(f, t).collect())) == want
    assert evaluate.greedy_assignment(f.limit(0), t).count() == 0
    parted = f.filter("cwe_id is null").unionByName(f.limit(0)), t.filter("cwe_id is null")
    monkeypatch.undo()
    want = sorted(map(tuple, evaluate.greedy_match(evaluate.scored_pairs(*parted), *parted).collect()))
    assert sorted(map(tuple, evaluate.greedy_assignment(*parted).collect())) == want and want
