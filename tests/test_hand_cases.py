"""Cases worked out by hand, streaming against batch, and edge cases of the text primitives."""

import datetime
import re
import tempfile

from pyspark.sql import functions as F

from auditloom.functions.text import line_of, matches
from auditloom.operators import cost, dedup, evaluate, exposure, extract, graph, scan, telemetry, triage, votes
from auditloom.sources.bindings import domain
from auditloom.streaming import alerts as streaming


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_statuses(spark):
    rows = [(f, v == "T") for f, vs in (("a", "TTT"), ("b", "TTF"), ("c", "TFF"), ("d", "FFF")) for v in vs]
    got = {r["finding_id"]: (r["status"], round(r["confidence"], 3)) for r in votes.status(spark.createDataFrame(rows, "finding_id string, vote boolean")).collect()}
    assert got == {"a": ("validated", 1.0), "b": ("unconfirmed", 0.333), "c": ("unconfirmed", 0.667), "d": ("false_positive", 1.0)}


def test_priorities(spark):
    f = spark.createDataFrame([(1, "critical", [1]), (2, "medium", [1]), (3, "low", [1]), (4, "critical", [2]), (5, "low", [])], "finding_id long, severity string, addresses array<long>")
    intel = spark.createDataFrame([(2, 80.0)], "address long, exposure double")
    got = {r["finding_id"]: (round(r["priority"], 3), r["adjusted"]) for r in exposure.prioritize(f, intel).collect()}
    assert got == {1: (9.85, "critical"), 2: (8.635, "high"), 3: (7.6, "high"), 4: (58.85, "medium"), 5: (0.6, "low")}


def test_host_exposure(spark):
    score = lambda *a: exposure.host_exposure(*map(F.lit, a))
    got = one(spark, a=score(10, 1, 1, 0, "x"), b=score(10, 1, 1, 0, "buffer-overflow"), c=score(100, 3, 5, 2, "buffer-overflow"), d=score(0, 0, 0, 0, "buffer-overflow"))
    assert [round(x, 6) for x in got] == [24.0, 31.2, 100.0, 0.0]


def test_patch_tuesday(spark):
    day = lambda d, s="high", p=3: triage.patch_date(F.lit(d).cast("date"), F.lit(s), F.lit(p))
    got = one(spark, a=day("2024-03-01"), b=day("2024-03-13"), c=day("2024-03-15"), d=day("2024-03-15", "critical", 2), e=day("2024-12-31"))
    assert [str(x) for x in got] == ["2024-03-12", "2024-03-12", "2024-04-09", "2024-03-22", "2025-01-14"]


def test_jaccard(spark):
    j = lambda a, b: dedup.jaccard(F.lit(a), F.lit(b))
    assert [round(x, 6) for x in one(spark, a=j("a b", "b c"), b=j("", " "), c=j("a", ""))] == [round(1 / 3, 6), 1.0, 0.0]


def test_matches_equal_python(spark):
    texts = ["", "abc", "aXXb😀XX\nXX", "XXXX", None, "é XX é"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: [tuple(m) for m in r["m"] or []] for r in df.select("i", matches(F.col("t"), "XX").alias("m")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [(m.start(), m.end(), m[0]) for m in re.finditer("XX", t or "")]
    assert one(spark, n=line_of(F.lit("a\nb\nc"), F.lit(4)))["n"] == 3


def test_budget_latch(spark):
    rows = [(1, 1, "a", 60), (1, 2, "b", 50), (1, 3, "a", 40), (1, 4, "a", 1)]
    got = cost.fold(spark.createDataFrame(rows, "run_id long, seq long, stage string, cents long"), 100, {"b": 10}).orderBy("seq").collect()
    assert [(r["accepted"], r["spent"], r["exceeded"]) for r in got] == [(True, 60, False), (False, 60, True), (True, 100, True), (False, 100, True)]


def test_greedy_match(spark):
    pairs = spark.createDataFrame([(1, 10, 8, "exact"), (2, 10, 9, "exact"), (2, 11, 5, "fuzzy"), (3, 12, 5, "fuzzy"), (3, 13, 5, "fuzzy")], "finding_id long, vuln_id long, points int, match_type string")
    assert sorted((r["finding_id"], r["vuln_id"]) for r in evaluate.greedy_match(pairs).collect()) == [(1, 10), (2, 11), (3, 12)]


def test_numbered_and_components(spark):
    df = spark.createDataFrame([(x,) for x in (5, 900, 17, 3)], "k long")
    assert {r["k"]: r["n"] for r in scan.numbered(df, "k", "n", 2).collect()} == {3: 0, 5: 1, 17: 2, 900: 3}
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in graph.connected_components(links).collect()}
    assert got == {i: 0 for i in range(21)} | {100: 100, 200: 100}


def test_json_and_symbols(spark):
    a = spark.createDataFrame([(1, 'x {"vulnerabilities": [{"location": "a"}]} y'), (2, "none"), (3, None)], "id int, response string")
    got = {r["id"]: (r["location"], r["bug_class"], r["confidence"]) for r in extract.json_answers(a).collect()}
    assert got == {1: ("a", "unknown", 0.3), 2: (None, "unknown", 0.3), 3: (None, "unknown", 0.3)}
    f = spark.createDataFrame([(1, "import os\nclass A:\n  def f(self): return os.path.join('a')\n"), (2, "def ("), (3, None)], "file_id long, content string")
    assert sorted((r["kind"], r["name"]) for r in extract.python_symbols(f).collect()) == [("call", "os.path.join"), ("class", "A"), ("function", "f"), ("import", "os")]


def test_streams_equal_batch(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    folder = tempfile.mkdtemp()
    spark.read.parquet(f"{sf_dir}/events.parquet").coalesce(1).write.parquet(f"{folder}/in")
    stream = lambda: streaming.alerts(spark.readStream.schema(schema).parquet(f"{folder}/in"))
    batch = domain(spark, sf_dir, "alerts").withColumn("ts", F.col("ts").cast("timestamp"))
    streaming.run_once(streaming.dedupe(stream()), f"{folder}/dedupe", f"{folder}/c1")
    kept = [r["alert_id"] for r in spark.read.parquet(f"{folder}/dedupe").collect()]
    assert set(kept) == {r["alert_id"] for r in batch.select("alert_id").collect()}
    streaming.run_once(streaming.tumbling(stream()), f"{folder}/tumbling", f"{folder}/c2")
    closed = {(r["start"], r["severity"]): r["n"] for r in spark.read.parquet(f"{folder}/tumbling").collect()}
    whole = {(r["start"], r["severity"]): r["n"] for r in telemetry.tumbling(batch).collect()}
    assert closed.items() <= whole.items() and len(whole) - len(closed) <= 8
    streaming.run_once(streaming.sessions(stream()), f"{folder}/sessions", f"{folder}/c3")
    closed = {(r["agent_id"], r["start"], r["n"]) for r in spark.read.parquet(f"{folder}/sessions").collect()}
    assert closed and closed <= {(r["agent_id"], r["start"], r["n"]) for r in telemetry.sessions(batch).collect()}
    assert isinstance(next(iter(whole))[0], datetime.datetime)
    streaming.run_once(streaming.admit(stream()), f"{folder}/admit", f"{folder}/c4")
    assert {(r["event_id"], r["admitted"]) for r in spark.read.parquet(f"{folder}/admit").collect()} == {tuple(r) for r in telemetry.admitted(batch).collect()}


def test_bootstrap(spark):
    rows = [(i, 1.0, float(i % 2)) for i in range(400)]
    got = [r["difference"] for r in evaluate.bootstrap(spark.createDataFrame(rows, "id long, a double, b double"), 50).collect()]
    assert len(got) == 50 and 0.45 < sum(got) / 50 < 0.55 and max(got) - min(got) > 0.02
