"""Short benchmark items, equal items, batches beyond 32-bit offsets, rows that share an id."""

import random

import pytest
from test_decontaminate import brute, got

from auditloom.llm import chat_format, queries, simhash
from auditloom.llm import decontaminate as dc


@pytest.mark.parametrize("portion", [6_000_000, 50])
def test_short_and_equal_items(spark, make_docs, monkeypatch, portion):
    monkeypatch.setattr(dc, "PORTION", portion)
    items = [(1, "short"), (2, "ox"), (2, "OX"), (None, "a  b"), (3, "quite a long item of the benchmark"), (3, "quite a long item of the benchmark"), (4, " "), (5, "seven77"), (5, "a long item that shares its number"), (6, "x")]
    rows = [(1, "This is a SHORT text"), (2, "fox and a\n b"), (None, "an ox"), (3, None), (4, ""), (5, "now quite a lung item of the benchmark seven77"), (6, "a long item that shares its number, seven77")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in rows:
        s = dc.normal(t)
        want |= {(str(i), str(k), 0, len(dc.normal(x))) for k, x in items if 0 < len(dc.normal(x)) < dc.Q and dc.normal(x) in s}
    want |= set(brute(rows, [x for x in items if len(dc.normal(x[1])) >= dc.Q]))
    best = {}
    for i, k, e, m in want:
        best[i, k] = min(best.get((i, k), (e, m)), (e, m))
    # An item_id of several texts is named once a scan, so once a portion.
    found = {}
    for i, k, e, m in got(dc.matches(make_docs(rows), bench)):
        found[i, k] = min(found.get((i, k), (e, m)), (e, m))
    assert found == best
    left = {str(r["doc_id"]) for r in dc.clean(make_docs(rows), bench).collect()}
    assert left == {str(i) for i, _ in rows} - {i for i, _ in best}


def test_long_documents_by_alignment(spark, sf_dir):
    """Whole documents of any length against all items, without a filter."""
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    longest = sorted(docs, key=lambda r: -len(r[1] or ""))[:2]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r["doc_id"] for r in queries.op9_decontaminate(spark, sf_dir).collect()}
    some = longest + [r for r in docs if r[0] in hit][:4] + [r for r in docs if r[0] not in hit and len(r[1] or "") < 4000][:6]
    want = brute(some, items[:40])
    ids, names = {str(i) for i, _ in some}, {str(i) for i, _ in items[:40]}
    assert [x for x in got(queries.op9_decontaminate(spark, sf_dir)) if x[0] in ids and x[1] in names] == want


def test_batches_beyond_offsets(spark, monkeypatch):
    monkeypatch.setattr(chat_format, "MOST_BYTES", 300)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t} " + "y" * (c * 7)) for c in range(12) for t in range(2)]
    import pyarrow as pa

    turns = pa.table({"conv_id": pa.array([r[0] for r in rows], pa.int64()), "role": [r[2] for r in rows], "text": [r[3] for r in rows]})
    made = list(chat_format.assemble(turns, chat_format._begins(turns)))
    assert len(made) > 3 and all(b.column("formatted").nbytes < 600 for b in made)
    parsed = [chat_format.parse(t) for b in made for t in b.column("formatted").to_pylist()]
    assert parsed == [[(r[2], r[3]) for r in rows if r[0] == c] for c in range(12)]
    monkeypatch.setattr(chat_format, "MOST_BYTES", 30)
    with pytest.raises(ValueError):
        list(chat_format.assemble(turns.slice(0, 2), chat_format._begins(turns.slice(0, 2))))


def test_representatives_are_rows(spark, make_docs):
    rng = random.Random(1)
    word = lambda n: " ".join(f"w{rng.randint(0, 99999)}" for _ in range(n))
    a, b, c = word(30), word(30), word(30)
    rows = [(1, a), (4, a), (4, b), (4, c), (4, c), (None, a), (7, c), (2, None), (3, "")]
    docs = make_docs(rows)
    kept = simhash.representatives(docs)
    out = docs.withColumn("text_hash", simhash.text_hash(docs["text"])).join(kept, ["doc_id", "text_hash"], "left_semi")
    assert sorted((r["doc_id"], r["text"]) for r in out.distinct().collect()) == sorted([(1, a), (4, b), (4, c), (2, None)])
    assert simhash.representatives(make_docs([])).count() == 0
