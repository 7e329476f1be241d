"""The automaton's share in removing repeats, and rows that crowd one id."""

import random

import pytest
from test_blocks import brute_lm, brute_repeats, close, got_lm, got_repeats

import pyarrow as pa

from auditloom.llm import blocks, lm, substring_dedup


def crowded(rng):
    """A third of the rows repeat one row, a third have no id and many texts."""
    words = lambda n: " ".join(f"w{rng.randint(0, 400)}" for _ in range(n))
    passage, one = words(30), words(60)
    rows = [(50, one)] * 100 + [(None, rng.choice(["", passage + " "]) + words(rng.randint(0, 60))) for _ in range(100)]
    return rows + [(rng.randint(0, 99), words(rng.randint(0, 40)) + " " + rng.choice([passage, one, "x"])) for _ in range(100)] + [(51, None), (None, None)]


@pytest.mark.parametrize("size", [6_000_000, 2000])
def test_crowded_ids(spark, make_docs, monkeypatch, size):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
    rows = crowded(random.Random(11))
    assert got_repeats(substring_dedup.remove_repeats(make_docs(rows))) == brute_repeats(rows)
    close(got_lm(lm.score(make_docs(rows))), brute_lm(rows))
    docs = make_docs(rows).select("doc_id", "text")
    sizes = blocks.measured(docs, "doc_id")
    few, hot = blocks.folded(docs, sizes, "doc_id")
    assert few.agg({"copies": "sum"}).first()[0] == len(rows)
    if size == 2000:
        assert few.count() < 250
        largest = few.withColumn("block", blocks.range_block(sizes, blocks.extent(sizes)[0], hot)).groupBy("block").agg({"text": "count"}).agg({"count(text)": "max"}).first()[0]
        assert largest < 60


def block_of(rows):
    return substring_dedup.Block(pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows]), "copies": pa.array([1] * len(rows), pa.int64())}))


def test_what_the_automaton_does_not_hit_stays(monkeypatch):
    rng = random.Random(5)
    passages = [" ".join(f"p{k}w{j}" for j in range(30)) for k in range(4)]
    rows = [(i, f"a{i} {passages[i % 4]} b{i}") for i in range(12)]
    b = block_of(rows)
    flags = b.again().astype("u1")  # first here
    answers = pa.table({"part": pa.array([0], pa.int32()), "flags": pa.array([flags.tobytes()])})
    docs = pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows]), "copies": pa.array([1] * 12, pa.int64())})
    removed = lambda: substring_dedup._remove(docs, answers)["n_removed"].to_pylist()
    assert removed() == [0] * 4 + [30] * 8
    whole = substring_dedup.phrases
    lost = [k for k, w in enumerate(b.words.distinct) if w.startswith(b"p2")]
    monkeypatch.setattr(substring_dedup, "phrases", lambda b, r: whole(b, r)[[b.words.ids[x] not in lost for x in whole(b, r)]])
    assert removed() == [0] * 4 + [30, 30, 0, 30] * 2
    rng.shuffle(rows)


def test_one_long_text(spark, make_docs):
    rng = random.Random(6)
    part = " ".join(f"v{rng.randint(0, 3000)}" for _ in range(60_000))
    rows = [(1, part + " " + " ".join(f"u{rng.randint(0, 3000)}" for _ in range(90_000)) + " " + part[:100_000]), (2, part[50_000:250_000]), (3, "the " * 250_000)]
    assert sum(len(t) for _, t in rows) > 1_900_000
    assert got_repeats(substring_dedup.remove_repeats(make_docs(rows))) == brute_repeats(rows)
