import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from auditloom.llm import bpe, chat_format, lang_id, queries, secrets, simhash
from auditloom.llm.tokenization import default_path

BASE = [
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
MORE = [(r.kind, re.compile(r.pattern), 0, 0) for r in secrets.RULES if not r.base]


def brute_secrets(rows):
    out = []
    for i, t in rows:
        spans = [(m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(BASE + MORE) for m in p.finditer(t or "") if len(m[g]) >= least]
        spans.sort()
        text = lambda some: ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in some)
        base = [s for s in spans if s[1] < 3]
        out.append((str(i), *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(text(base).encode()).hexdigest(), text(spans)))
    return sorted(out)


def got_secrets(df):
    return sorted((str(r["doc_id"]), r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in df.collect())


def secret_rows():
    rng = random.Random(8)
    bits = ["password", "PassWd", "secret", "TOKEN", "api_key", "APIKEY", "api", "=", ":", " ", '"', "'", "abc", "abcdef", "AKIA", "0123456789ABCDEFG", "deadbeef", "0123456789abcdef", "é", "😀", "\n", "ghp_", "x" * 40, "xoxb-", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJ", "K", "ſecret"]
    rows = [(k, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for k in range(400)]
    return rows + [(None, "token=abcdef"), (3, "token=abcdef"), (3, "token=abcdef"), (5, None), (6, ""), (7, "secret=token:abcdefgh"), (8, "a " * 40000 + "password: hunter22 " + "f" * 30)]


def test_secrets(spark, make_docs):
    rows = secret_rows()
    assert got_secrets(secrets.digests(make_docs(rows))) == brute_secrets(rows)
    assert secrets.digests(make_docs([])).count() == 0


def test_trigram_query():
    q = secrets.trigram_query(secrets.RULES[0].pattern)
    assert len(q) == 1 and frozenset({"sec", "ecr", "cre", "ret"}) in q[0] and len(q[0]) == 6
    assert secrets.trigram_query(r"[0-9a-f]{24,}") == []
    assert secrets.trigram_query("AKIA[A-Z0-9]{16,}") == [frozenset({frozenset({"aki", "kia"})})]


def brute_redact(t):
    if t is None:
        return None
    spans = sorted((m.start(), m.end()) for kind, p, g, least in BASE + MORE for m in p.finditer(t) if len(m[g]) >= least)
    out, at = [], 0
    for a, b in spans:
        if a >= at or not out:
            out += [t[at:a], secrets.REDACTED]
            at = b
        at = max(at, b)
    return "".join(out) + t[at:]


def test_redact(spark, make_docs):
    rows = secret_rows()
    docs = make_docs(rows).withColumnsRenamed({"source": "found", "block": "kinds"})
    df = secrets.redact(docs)
    assert df.columns == docs.columns and {r["found"] for r in df.collect()} == {"s"}
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect()) == sorted((str(i), str(brute_redact(t))) for i, t in rows)


def table_rows(spark, sf_dir, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf_dir)
    want = con.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert sorted(map(tuple, df.collect())) == sorted(tuple(dict(zip(want.columns, r))[c] for c in df.columns) for r in want.fetchall())


def brute_chat(rows):
    convs = {}
    for c, n, role, text in sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    out = []
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((str(c), len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)))
    return sorted(out)


def test_chat(spark):
    rng = random.Random(9)
    bits = ["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<s>", "é", "😀", "a", "\n", "<\\s>"]
    rows = [(rng.choice([1, 2, 3, None, 5]), k // 2, rng.choice(["user", "assistant", "system", None, "[INST]"]), rng.choice([None, "", "x" * 50000, "".join(rng.choice(bits) for _ in range(12))])) for k in range(300)]
    rows += [(k, 0, "assistant", f"only {k}") for k in range(100, 160)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat_format.format_conversations(df)
    assert sorted((str(r[0]), *r[1:5]) for r in chat_format.digests(made).collect()) == brute_chat(rows)
    for r in made.collect():
        assert len(chat_format._TURN.sub("", r["formatted"])) == 0
        assert all(r["formatted"][b : b + 4] == "</s>" for b in r["loss_spans"][1::2])
    assert chat_format.digests(chat_format.format_conversations(df.limit(0))).count() == 0


def test_language_edge_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "hello there"), (4, "é"), (4, "é"), (5, "the " * 50000)]
    got = {r["doc_id"]: r for r in lang_id.identify(make_docs(rows)).collect()}
    assert len(got) == 6
    assert [got[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and got[1]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = lang_id.identify(make_docs(rows).selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert lang_id.identify(make_docs([])).count() == 0


def test_language_accuracy(spark, sf_dir):
    lang = dict(table_rows(spark, sf_dir, "documents", "doc_id", "lang"))
    got = queries.op4_language(spark, sf_dir).collect()
    assert len(got) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und" and lang[r["doc_id"]] is not None]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.9


def test_ftrl_learns_and_is_sparse():
    rng = np.random.default_rng(1)
    m = lang_id.Model(["a", "b"], np.ones(lang_id.DIM))
    ex = []
    for _ in range(300):
        y = int(rng.integers(2))
        at = np.unique(np.concatenate([rng.integers(100, 2000, 30), [y]]))
        ex.append((np.append(at, lang_id.DIM), np.append(np.full(len(at), len(at) ** -0.5), 1.0), y))
    m.fit(ex[:250])
    m.calibrate(ex[250:])
    s = [m.w[at].T @ x for at, x, _ in ex[250:]]
    assert np.mean([int(np.argmax(v)) == y for v, (_, _, y) in zip(s, ex[250:])]) > 0.95
    assert (m.w == 0).mean() > 0.5 and 0.04 < m.temperature < 20


def test_near_copies_stage(spark, make_docs, sf_dir):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (3, "one two three four five"), (3, "one two three four five"), (4, "p q r s t u"), (4, "k l m n o p q"), (5, None), (6, "")]
    left = corpus_pipeline.near_copies(spark, make_docs(rows), sf_dir)
    assert left.columns == make_docs(rows).columns
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in left.collect()])) == sorted(map(str, [(1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (3, "one two three four five"), (4, "k l m n o p q"), (5, None)]))


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one = corpus_pipeline.language(spark, docs, sf_dir)
    assert one.columns == docs.columns
    kept1 = {r["doc_id"] for r in one.collect()}
    pred = {r["doc_id"]: r for r in lang_id.identify(docs).collect()}
    assert kept1 == {i for i, r in pred.items() if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_LANGUAGE}
    two = corpus_pipeline.near_copies(spark, one, sf_dir)
    comp = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(one).collect()}
    kept2 = {r["doc_id"] for r in two.collect()}
    assert two.columns == docs.columns and kept2 == {i for i, c in comp.items() if i == c}
    three = corpus_pipeline.benchmark_passages(spark, two, sf_dir)
    from auditloom.llm import decontaminate

    hit = {r["doc_id"] for r in decontaminate.matches(two, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    kept3 = {r["doc_id"] for r in three.collect()}
    assert three.columns == docs.columns and kept3 == kept2 - hit
    four = corpus_pipeline.without_secrets(spark, three, sf_dir)
    text = dict(table_rows(spark, sf_dir, "documents", "doc_id", "text"))
    got = {r["doc_id"]: r["text"] for r in four.collect()}
    assert four.columns == docs.columns and got == {i: brute_redact(text[i]) for i in kept3}
    last = {r["doc_id"]: tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(last) == kept3
    want = {r["doc_id"]: tuple(r) for r in bpe.encode_decode(four, default_path()).collect()}
    assert last == want
