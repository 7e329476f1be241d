"""Merge rules against sets joined one by one."""

import random
from collections import defaultdict

import pytest

from auditloom.operators import merging


settled = set()


def joined(rows, rules):
    group = {r[0]: {r[0]} for r in rows}
    for rule in rules:
        for a in rows:
            for b in rows:
                x, y = rule(a), rule(b)
                if None not in x and x == y and group[a[0]] is not group[b[0]]:
                    group[a[0]] |= group[b[0]]
                    for i in group[b[0]]:
                        group[i] = group[a[0]]
    return group


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rules(spark, monkeypatch, seed):
    monkeypatch.setattr(merging, "SMALL", 0 if seed == 1 else 100_000)
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "b", "c", None]), r.choice([f"f{r.randint(0, 25)}", None]), f"CWE-{r.randint(0, 2)}", f"p{r.randint(0, 25)}", r.choice([f"l{r.randint(0, 9)}", None])) for i in range(90)]
    one = joined(rows, [lambda x: (x[1], x[2]), lambda x: (x[3], x[4])])
    two = joined(rows, [lambda x: (x[1], x[2]), lambda x: (x[1], x[3], x[4])])
    by = {x[0]: x for x in rows}

    def conflict(ids):
        at = defaultdict(set)
        for i in ids:
            at[by[i][5]].add(by[i][1])
        return any(len(v - {None}) > 1 for k, v in at.items() if k is not None)

    want = {i: (min(two[i]), True) if conflict(one[i]) else (min(one[i]), False) for i in by}
    findings = spark.createDataFrame(rows + [(None, "a", "f1", "CWE-1", "p1", "l1")], "finding_id long, bug_class string, function string, cwe_id string, pattern string, location string")
    got = {x["finding_id"]: (x["cluster"], x["settled"]) for x in merging.merge_findings(findings).collect()}
    assert got == want
    settled.update(s for _, s in got.values())
    members = defaultdict(list)
    for i, (c, _) in got.items():
        members[c].append(i)
    assert not any(conflict(ids) for ids in members.values())
    assert merging.merge_findings(findings.limit(0)).count() == 0


def test_both_kinds_were_met():
    assert settled == {True, False}


def test_settled_stars_leave_the_rounds(spark):
    from auditloom.operators.graph import _marked, connected_components

    draw = random.Random(3)
    pairs = [(1, 2), (1, 3), (1, 4), (10, 11), (11, 12), (20, 22), (21, 22), (30, 31)]
    marked = _marked(spark.createDataFrame([(b, a) for a, b in pairs], "v long, u long")).collect()
    assert {(r["u"], r["v"]) for r in marked if r["settled"]} == {(1, 2), (1, 3), (1, 4), (30, 31)} and len(marked) == len(pairs)
    pairs += [(draw.randint(100, 900), draw.randint(100, 900)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(40)]
    least = {x: x for pair in pairs for x in pair}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    for small in (0, 20, 10_000):
        found = connected_components(spark.createDataFrame(pairs, "a long, b long"), small=small).collect()
        assert sorted(map(tuple, found)) == sorted((x, least[x]) for x in linked)
