"""Scopes by bracket depth against a stack."""

import random

import pytest

from auditloom.operators import scopes


def plain(text, places):
    """(open, close, name) of named scopes, and the innermost name around each place, by a stack."""
    stack, found, around, i = [], [], {}, 0
    while i < len(text):
        if i in places:
            around[i] = next((n for _, n in reversed(stack) if n), None)
        if text[i] == "{":
            head = text[:i].rsplit("}", 1)[-1].rsplit("{", 1)[-1].rsplit(";", 1)[-1].split()
            stack.append((i, head[1] if len(head) == 2 and head[0] == "function" else None))
        elif text[i] == "}" and stack:
            at, name = stack.pop()
            if name:
                found.append((name, at, i))
        i += 1
    return sorted(found + [(n, at, None) for at, n in stack if n]), around


@pytest.mark.parametrize("seed", range(3))
def test_against_a_stack(spark, seed):
    r = random.Random(seed)
    texts = []
    for _ in range(12):
        depth, out = 0, []
        for k in range(r.randint(0, 80)):
            step = r.choice(["open", "name", "close", "hit", "hit"])
            if step == "close" and depth:
                out.append("}")
                depth -= 1
            elif step in ("open", "name"):
                out.append(f"function f{k} {{" if step == "name" else "if {")
                depth += 1
            else:
                out.append("X;")
        texts.append(" ".join(out) + ("}" * depth if r.random() < 0.7 else ""))
    files = spark.createDataFrame(list(enumerate(texts)), "file_id long, content string")
    found = scopes.scopes(files, [("fn", r"function\s+(\w+)[^{};]*\{")], "{}")
    places = [(k, i, "x") for k, t in enumerate(texts) for i, c in enumerate(t) if c == "X"]
    got = scopes.innermost(spark.createDataFrame(places, "file_id long, start int, more string"), found, ["fn"])
    assert got.columns == ["file_id", "start", "more", "fn"]
    want_scopes, want = [], []
    for k, t in enumerate(texts):
        s, around = plain(t, {i for f, i, _ in places if f == k})
        want_scopes += [(k, *x) for x in s]
        want += [(k, i, "x", n) for i, n in around.items()]
    assert sorted(((r["file_id"], r["name"], r["open"], r["close"]) for r in found.collect()), key=str) == sorted(want_scopes, key=str)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) > 20


def test_blocks_end_at_their_own_bracket(spark):
    text = 'extern "C" {\n fn a(x: i32) { if x { unsafe { y } } }\n fn malloc2(p: *mut u8);\n}\nfn outside(q: i32) {}\nextern "C" {\n fn late();\n'
    rows = [(1, "rust", text), (2, "rust", None), (3, "python", text), (4, "rust", "")]
    got = {(r["name"], r["line"], r["unsafe"], r["manual_memory"], r["raw_pointer"]) for r in scopes.extern_functions(spark.createDataFrame(rows, "file_id long, lang string, content string")).collect()}
    assert got == {("a", 2, True, True, True), ("malloc2", 3, True, True, True), ("late", 7, False, False, False)}


def test_calls_know_both_kinds_of_scope(spark):
    pad = "// " + "x" * 300 + "\n"
    text = "contract C {\nfunction far() {\n" + pad + "a.send(1);\n}\n}\ncontract D is B { function near() { b.send(2); } }\nc.send(3);"
    rows = scopes.contract_calls(spark.createDataFrame([(1, "solidity", text)], "file_id long, lang string, content string")).orderBy("start").collect()
    # By windows the file has one contract, and a head too far away is lost; by brackets each call has its own.
    assert [(r["contract"], r["function"], r["in_contract"], r["in_function"]) for r in rows] == [("D", "unknown", "C", "far"), ("D", "near", "D", "near"), ("D", "near", None, None)]


def test_contract_texts_are_dealt_by_file(spark):
    files = spark.createDataFrame([(i, "solidity", "contract C { function f() { a.delegatecall(b); } }") for i in range(40)], "file_id long, lang string, content string").coalesce(1)
    plan = scopes.contract_calls(files)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file_id" in plan and "REPARTITION_BY_NUM" in plan


def test_scopes_of_modules_are_not_broadcast(spark):
    text = "(module m (func $a (i32.load (x)) (func $b (i32.store)) (i64.load)) (i32.load) (func c"
    rows = [(1, "wasm", text), (2, "rust", text), (3, "wasm", None), (4, "wasm", "i32.load ) func (func d i32.store")]
    out = scopes.wasm_boundaries(spark.createDataFrame(rows, "file_id long, lang string, content string"))
    assert sorted((r["file_id"], r["start"], r["in_function"]) for r in out.collect()) == [(1, 20, "a"), (1, 44, "b"), (1, 57, "a"), (1, 69, None), (4, 0, None), (4, 24, "d")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Only the catalog of patterns goes to all tasks; brackets and heads are as many as the texts.
    assert "HashJoin" not in plan and "SortMergeJoin" not in plan and "REPARTITION_BY_NUM" in plan


def test_heads_keep_their_own_brackets(spark):
    heads = [("x", r"(\w+)\s*\{"), ("y", r"fn (\w+)\s*\{")]
    found = scopes.scopes(spark.createDataFrame([(1, "} fn a { { } fn b { } }"), (2, "fn c {")], "file_id long, content string"), heads, "{}")
    want = [(1, "x", "a", 7, 22, 0), (1, "x", "b", 18, 20, 1), (1, "y", "a", 7, 22, 0), (1, "y", "b", 18, 20, 1), (2, "x", "c", 5, None, 1), (2, "y", "c", 5, None, 1)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
