"""Hierarchies against plain walks; the cascade, its file and recommendations by hand."""

import json
import random

from auditloom.operators import ontology
from auditloom.sources.files import ontology_json


def test_ancestors(spark):
    r = random.Random(4)
    up = {i: {r.randrange(i) for _ in range(r.choice([0, 1, 1, 2]))} for i in range(1, 60)}
    up |= {100 + i: {99 + i} for i in range(1, 40)} | {200: {201}, 201: {202}, 202: {200}, 300: {300}}
    want = {}
    for i in up:
        front, depth = {i}, 0
        while front := {p for n in front for p in up.get(n, ()) if p != n} - {p for (n, p) in want if n == i}:
            depth += 1
            want |= {(i, p): depth for p in front}
    rows = [(i, p) for i, ps in up.items() for p in ps] + [(None, 1), (1, None)]
    found = ontology.ancestors(spark.createDataFrame(rows, "node long, parent long"))
    assert {(x["node"], x["ancestor"]): x["depth"] for x in found.collect()} == want
    assert want[139, 100] == 39 and want[200, 200] == 3
    tactics = spark.createDataFrame([(i, "even" if i % 2 == 0 else None) for i in up], "technique_id long, tactic string")
    below = {(x["ancestor"], x["tactic"]): (x["n"], x["deepest"]) for x in ontology.subtree_tactics(found, tactics).collect()}
    mine = [d for (i, p), d in want.items() if p == 0 and i % 2]
    assert below[0, "unknown"] == (len(mine), max(mine))


def test_the_first_source_answers(spark, tmp_path):
    (tmp_path / "ontology.json").write_text(json.dumps({"techniques": {"O1": {"label": "one", "tactic": "Detect"}, "O2": {"label": "two"}}, "cwe_mappings": {"CWE-3": ["O1", "gone", "L1"], "CWE-1": ["O2"]}}))
    known, mapped = ontology_json(spark, str(tmp_path / "ontology.json"))
    assert sorted(tuple(x) for x in known.collect()) == [("O1", "one", "Detect", None), ("O2", "two", "unknown", None)]
    catalog = spark.createDataFrame([("C1", "Detect", "Some", "", "", 'Checks "buffer", sizes.'), ("C2", "Isolate", "x", "", "", "buffers"), ("", "Detect", "", "", "", "buffer")], "technique_id string, tactic string, technique string, level_0 string, level_1 string, definition string")
    two = lambda rows, name: spark.createDataFrame(rows, f"cwe_id string, {name} string")
    cwes = spark.createDataFrame([("cwe-1",), ("CWE-1",), ("CWE-2",), ("CWE-3",), ("CWE-4",), (None,), ("",), ("CWE-1",)], "cwe_id string")
    listed = two([("CWE-1", "C1"), ("CWE-1", "L1"), ("CWE-3", "L1"), ("CWE-3", "L2")], "technique")
    found = ontology.cwe_techniques(cwes, catalog, two([("CWE-1", "buffer"), ("CWE-3", "nothing")], "keyword"), two([("CWE-2", "Isolate"), ("CWE-3", "Harden")], "tactic"), ["Detect"], known, mapped, listed)
    # CWE-1: by keyword, whatever its case; CWE-2: by its tactic; CWE-3: neither, so the ontology's known ones; CWE-4: default tactic.
    assert sorted(map(tuple, found.collect())) == [("CWE-1", "C1", "keyword"), ("CWE-1", "L1", "list"), ("CWE-2", "C2", "tactic"), ("CWE-3", "L1", "list"), ("CWE-3", "L2", "list"), ("CWE-3", "O1", "ontology"), ("CWE-4", "C1", "tactic"), ("cwe-1", "C1", "keyword")]


def test_recommendations(spark):
    attacks = spark.createDataFrame([(1, "A", 0), (1, "B", 1), (1, "none", 2), (2, "none", 0)], "finding_id long, tactic string, ordinal int")
    texts = spark.createDataFrame([("A", 0, "x"), ("A", 1, "y"), ("B", 0, "y"), ("B", 1, "z")], "tactic string, place int, text string")
    defences = spark.createDataFrame([(1, "D1", "one", "Harden", 1), (1, "D0", "zero", "Detect", 0), (2, "D1", "one", "Harden", 0), (2, "D1", "one", "Harden", 5)], "finding_id long, technique_id string, label string, tactic string, ordinal int")
    got = sorted(map(tuple, ontology.recommendations(attacks, defences, texts).collect()))
    d = "Apply D3FEND technique {}: {} ({} tactic)"
    assert got == [(1, 1, "x"), (1, 2, "y"), (1, 3, "z"), (1, 4, d.format("D0", "zero", "Detect")), (1, 5, d.format("D1", "one", "Harden")), (2, 1, d.format("D1", "one", "Harden"))]
