"""File sources against small written files."""

import json

from pyspark.sql import functions as F

from auditloom.sources import files


def test_source_files(spark, tmp_path):
    for name, text in (("a.py", "x = 1"), ("node_modules/b.js", "no"), (".git/c.py", "no"), ("d/e.rs", "é"), ("f.txt", "no")):
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    got = {(r["path"].rsplit("/", 1)[1], r["lang"], r["content"]) for r in files.source_files(spark, str(tmp_path)).collect()}
    assert got == {("a.py", "python", "x = 1"), ("e.rs", "rust", "é")}


def test_technique_csv(spark, tmp_path):
    head = "ID,D3FEND Tactic,D3FEND Technique,D3FEND Technique Level 0,D3FEND Technique Level 1,Definition\n"
    (tmp_path / "t.csv").write_text(head + " D1 ,Harden,A,,,first\nD2,Detect,,B,C,two\n,Isolate,X,,,none\nD1,Harden,A2,,,last\n")
    got = {r["entry_id"]: (r["label"], r["definition"]) for r in files.technique_csv(spark, str(tmp_path / "t.csv")).collect()}
    assert got == {"D1": ("A2", "last"), "D2": ("C", "two")}


def test_json_sources(spark, tmp_path):
    v = lambda x: {"value": x}
    rows = [{"Control": v("c1"), "Relation": v("r"), "Defensive_Technique": v("http://x#T1"), "Technique": v("n"), "CCI_Definition": v("d")}, {"Control": v("c2")}]
    (tmp_path / "c.json").write_text(json.dumps({"results": {"bindings": rows}}, indent=1))
    assert [(r["control"], r["technique_id"]) for r in files.control_json(spark, str(tmp_path / "c.json")).collect()] == [("c1", "T1")]
    truth = [{"id": "1", "category": "race", "line_start": 3, "line_end": 4}, {"id": "2", "category": "odd", "line_start": 3}]
    (tmp_path / "g.json").write_text(json.dumps({"vulnerabilities": truth}))
    got = {r["vuln_id"]: (r["category"], r["lo"], r["hi"]) for r in files.ground_truth_json(spark, str(tmp_path / "g.json"), ["race"]).collect()}
    assert got == {"1": ("race", 3, 4), "2": ("other", None, None)}
    (tmp_path / "cves/CVE-1").mkdir(parents=True)
    (tmp_path / "cves/CVE-1/CVE-1.json").write_text(json.dumps({"description": "d", "patch": {"pre_patch": "a", "post_patch": "b"}}))
    r = files.vulnerability_json(spark, str(tmp_path / "cves")).first()
    assert (r["cve_id"], r["pre"], r["post"]) == ("CVE-1", "a", "b")


def test_commit_log_and_sinks(spark, tmp_path):
    (tmp_path / "log.txt").write_text("h1|a|m|d|fix: a|b\nshort|x\n")
    assert [tuple(r) for r in files.commit_log(spark, str(tmp_path / "log.txt")).collect()] == [("h1", "a", "m", "d", "fix: a|b")]
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    files.write_log(df, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0]) == {"id": 1, "text": "x"}
    lines = files.report("T", [("H", df.select(F.col("id").alias("o"), "text"))]).orderBy("section", "o").collect()
    assert [r["text"] for r in lines] == ["# T", "## H", "- x"]
