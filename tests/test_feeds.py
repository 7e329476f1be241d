"""Paged searches that fail and recover, snapshots that are replayed, symbols of broken files."""

import json

import pytest

from auditloom.functions import symbols
from auditloom.sources import pages
from auditloom.streaming import snapshots


def recorded(folder, query, rows):
    for n in range(max(1, -(-len(rows) // 100))):
        at = folder / f"query={query}" / f"page={n + 1}"
        at.mkdir(parents=True)
        (at / "part-0.txt").write_text(json.dumps({"total": len(rows), "matches": rows[100 * n : 100 * n + 100]}) + "\n")


SCHEMA = "ip long, port long, country string"


def test_pages(spark, tmp_path):
    rows = [{"ip": i, "port": [22, 80][i % 2], "country": "de" if i % 3 else None} for i in range(250)]
    recorded(tmp_path, "all", rows)
    recorded(tmp_path, "all+port=22", [r for r in rows if r["port"] == 22])
    recorded(tmp_path, "none", [])
    for k in range(4):  # page 3 answers at the fifth try
        (tmp_path / "query=all" / "page=3" / f"error-{k}").write_text("")
    found = pages.search(spark, str(tmp_path), SCHEMA, wait=0)
    assert sorted((r["ip"], r["port"], r["country"]) for r in found.collect()) == sorted((r["ip"], r["port"], r["country"]) for r in rows)
    assert found.rdd.getNumPartitions() == 3
    narrowed = pages.search(spark, str(tmp_path), SCHEMA, wait=0).filter("port = 22 AND country = 'de'")
    assert {r["ip"] for r in narrowed.collect()} == {r["ip"] for r in rows if r["port"] == 22 and r["country"] == "de"}
    assert narrowed.rdd.getNumPartitions() == 2  # the narrower search has fewer pages
    assert pages.search(spark, str(tmp_path), SCHEMA, "none", wait=0).count() == 0
    (tmp_path / "query=all" / "page=2" / "part-0.txt").unlink()
    with pytest.raises(Exception, match="retry limit reached"):
        pages.search(spark, str(tmp_path), SCHEMA, wait=0).collect()


def test_recorded_by_spark(spark, tmp_path):
    rows = [(i, i * 2, 80, "x") for i in range(201)]
    pages.record(spark.createDataFrame(rows, f"number long, {SCHEMA}"), str(tmp_path / "p"))
    assert sorted(r["ip"] for r in pages.search(spark, str(tmp_path / "p"), SCHEMA, wait=0).collect()) == [2 * i for i in range(201)]


def test_snapshots(spark, tmp_path, monkeypatch):
    path, batch = str(tmp_path / "s"), lambda *rows: spark.createDataFrame(rows, "a string, b int")
    save = snapshots.saver(path, ["a", "b"])
    state = lambda: {(r["kind"], r["key"]): r["n"] for r in snapshots.load(spark, path).collect()}
    assert state() == {} and snapshots.last_epoch(spark, path) is None
    save(batch(("x", 1), ("y", None)), 0)
    save(batch(("x", 2)), 1)
    once = {("a", "x"): 2, ("a", "y"): 1, ("b", "1"): 1, ("b", "2"): 1}
    assert state() == once
    save(batch(("x", 2)), 1)  # replayed
    save(batch(("x", 9)), 0)  # an old one again
    assert state() == once
    whole = spark.range(1).write.__class__.parquet

    def killed(self, to, *a, **k):
        if to.endswith("/done"):
            raise RuntimeError("killed before the mark")
        return whole(self, to, *a, **k)

    monkeypatch.setattr(spark.range(1).write.__class__, "parquet", killed)
    with pytest.raises(RuntimeError):
        save(batch(("z", 1)), 2)
    monkeypatch.undo()
    assert state() == once and snapshots.last_epoch(spark, path) == 1  # what broke off does not count
    save(batch(("z", 1)), 2)
    assert state() == once | {("a", "z"): 1, ("b", "1"): 2}
    assert sorted((r["epoch"], r["n"]) for r in snapshots.history(spark, path).filter("key = 'x'").collect()) == [(0, 1), (1, 2), (2, 2)]


def test_snapshots_of_a_stream(spark, tmp_path):
    spark.createDataFrame([("x",), ("y",), ("x",)], "a string").coalesce(1).write.parquet(str(tmp_path / "in"))
    run = lambda: spark.readStream.schema("a string").parquet(str(tmp_path / "in")).writeStream.foreachBatch(snapshots.saver(str(tmp_path / "s"), ["a"])).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    run()
    spark.createDataFrame([("x",)], "a string").write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert {r["key"]: r["n"] for r in snapshots.load(spark, str(tmp_path / "s")).collect()} == {"x": 3, "y": 1}


def test_symbols(spark):
    symbols.register(spark)
    broken = "import a.b\nfrom c import (d\n@mark(1)\n\n@other\nclass K:\n  def f(self:\n    pass\nasync def g()\n"
    rows = [(1, "x", "def f(): pass"), (2, "y", broken), (3, "z", None), (4, "w", "")]
    spark.createDataFrame(rows, "file_id long, tag string, content string").createOrReplaceTempView("t")
    got = spark.sql("SELECT * FROM symbols(TABLE(t), 'content') ORDER BY file_id, line")
    assert got.columns == ["file_id", "tag", "kind", "name", "line", "decorators", "parsed"]
    assert [tuple(r) for r in got.collect()] == [
        (1, "x", "function", "f", 1, "", "yes"), (2, "y", "import", "a.b", 1, "", "no"), (2, "y", "import", "c", 2, "", "no"), (2, "y", "class", "K", 6, "mark,other", "no"),
        (2, "y", "function", "f", 7, "", "no"), (2, "y", "function", "g", 9, "", "no"),
    ]
    with pytest.raises(Exception, match="no column"):
        spark.sql("SELECT * FROM symbols(TABLE(t), 'nothing')").collect()
