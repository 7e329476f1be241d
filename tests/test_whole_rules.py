"""Rules that the bound tables do not reach."""

from auditloom.operators import enrich, knowledge


def test_narrative_names_techniques_of_the_cwe(spark):
    from auditloom.functions.catalogs import CLASS_ATTACK, CWE_ATTACK

    rows = [(i, c, w) for i, (c, w) in enumerate((c, w) for c in [*CLASS_ATTACK, "outside"] for w in [*CWE_ATTACK, "CWE-0"])]
    want = {}
    for i, c, w in rows:
        listed = list(dict.fromkeys([*CLASS_ATTACK.get(c, []), *CWE_ATTACK.get(w, [])]))
        want[i] = f"{c} may lead to {', '.join(listed[:3]) or 'nothing known'}"
    findings = spark.createDataFrame(rows, "finding_id long, bug_class string, cwe_id string")
    assert {r["finding_id"]: r["text"] for r in enrich.narrative(findings).collect()} == want


def test_suggested_by_contained_words(spark):
    asked = ["harden it", "each credential", "one token", "token store", "must", "Rotation of keys", "network, traffic"]
    held = [("A", "Application Hardening", "protects"), ("B", "Credentials", "rotations of tokens"), ("C", "Tokenizer", "nothing"), ("D", "x", "stores")]
    want = sorted(
        {(q, t) for q in asked for t, name, text in held if any(len(w) > 5 and w in text.lower() or len(w) > 4 and w in name.lower() for w in q.lower().split())}
    )
    assert ("one token", "C") in want and ("one token", "B") not in want and ("token store", "D") not in want
    got = knowledge.suggest_techniques(spark.createDataFrame([(q,) for q in asked], "requirement string"), spark.createDataFrame(held, "technique_id string, name string, definition string"))
    assert sorted(map(tuple, got.collect())) == want
