"""Patch classes, contexts and taint flows against Python's own expressions."""

import re
import random

from auditloom.functions import patch_rules, taint_rules
from auditloom.functions.catalogs import SANITIZERS
from auditloom.operators import patches, taint


def test_classes_and_contexts(spark):
    r = random.Random(3)
    bits = ["free(ab)", "x = ab;", "free(c)", "delete node", "node->v ? 1 : 2", "if (k) k", "strcpy(", "memcpy(a, len +", "eval(", 'f"{x}"', "SELECT a +", "\n", " ", "toctou", "#r", "extern 'x' \"C\"", "call.delegatecall", "selfdestruct", "pad " * 20]
    text = lambda: r.choice([None, "", " ".join(r.choice(bits) for _ in range(r.randint(0, 9)))])
    rows = [(i, text(), text(), text()) for i in range(150)] + [(150, None, "strcpy gets( " * 4, None)]
    found = patches.classify(spark.createDataFrame(rows, "patch_id long, description string, pre string, post string"))
    want, around = {}, {}
    for i, *parts in rows:
        whole = " ".join(p or "" for p in parts).lower()
        scores = {k: sum(sum(1 for _ in re.finditer(p, whole, re.I)) for p in ps) for k, ps in patch_rules.PATCH_CLASSES.items()}
        best = max(scores, key=scores.get)
        want[i] = (best, scores[best])
        pre = parts[1] or ""
        around[i] = [pre[max(0, m.start() - 50) : m.end() + 50].strip() for p in patch_rules.PATCH_CLASSES[best] for m in re.finditer(p, pre, re.I)][:5]
    assert {x["patch_id"]: (x["bug_class"], x["score"]) for x in found.collect()} == want and len({k for k, _ in want.values()}) > 5
    got = {i: [] for i in around}
    for x in patches.contexts(found).orderBy("patch_id", "place").collect():
        got[x["patch_id"]].append(x["context"])
    assert got == around and max(map(len, got.values())) == 5


def test_flows(spark):
    r = random.Random(9)
    rows = []
    for i in range(250):
        lang = r.choice(list(taint_rules.SOURCES))
        bits = ["input (", "open(p, 'w')", "env::var", "args()", "fetch (", 'require("fs")', "os.Args", "cursor.execute(", "eval (", "ptr::write", "db.query", "db.Exec", "x.strip (", "CLEAN", "revalidated", "\n", "word", 'import "C"', "libc::x"]
        rows.append((i, lang, " ".join(r.choice(bits) for _ in range(r.randint(0, 14)))))
    rows += [(990, "python", None), (991, "cobol", "input ( eval (")]
    want = []
    for i, lang, text in rows:
        hits = lambda rules: [(k, m.start()) for k, ps in rules.get(lang, {}).items() for p in ps for m in re.finditer(p, text or "")]  # noqa: B023, E731
        native = any(re.search(p, text or "") for p in taint_rules.NATIVE.get(lang, []))
        for s, a in hits(taint_rules.SOURCES):
            for k, b in hits(taint_rules.SINKS):
                if b > a and not any(re.search(p, text[a:b], re.I) for p in SANITIZERS):
                    want.append((i, s, k, a, b, text[:a].count("\n") + 1, text[:b].count("\n") + 1, f"{taint_rules.EXTENSION[lang]}->native" if native else "none", taint_rules.FLOW_CLASSES.get((s, k), "Unsanitized Data Flow"), round(min(1, max(0.3, 1 - (b - a) / 1000)), 6)))
    found = taint.flows(spark.createDataFrame(rows, "file_id long, lang string, content string"))
    got = [(x["file_id"], x["source"], x["sink"], x["source_at"], x["sink_at"], x["source_line"], x["sink_line"], x["boundary"], x["vulnerability"], round(x["confidence"], 6)) for x in found.collect()]
    assert sorted(got) == sorted(want) and len(want) > 50
