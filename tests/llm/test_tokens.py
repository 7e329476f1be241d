import hashlib
import random
import uuid
import zlib

import numpy as np
import pytest

from auditloom.llm import bpe, queries, token_store
from auditloom.llm.common import shared_dir
from auditloom.llm.tokenization import default_path, encoder, pieces_of

ALPHABET = [" ", "  ", "\n", "a", "b", "don", "'t", "'s", "　", "\x1c", "1", "23", "!", "<|endoftext|>", "é", "日本", "\t", "😀", "\x00", "\xa0", "\r\n", "\x85"]
ROWS = [(3, "one two  three"), (1, None), (2, ""), (1, "zz again"), (1, "zz again"), (None, "no id"), (9, "ab" * 9000 + " x \n" + "!" * 7000), (7, "<|endoftext|> a <|endoftext|>")]


def ref_ids(text):
    return encoder(default_path()).tok.encode(text or "", add_special_tokens=False).ids


def rand_text(rng, most=14):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_encoder_equals_library():
    rng, enc = random.Random(5), encoder(default_path())
    texts = [rand_text(rng) for _ in range(3000)]
    assert all("".join(pieces_of(t)) == t for t in texts)
    assert [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)] == [ref_ids(t) for t in texts]
    for _ in range(500):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 9))]
        assert enc.decode(ids) == enc.tok.decode(ids, skip_special_tokens=False)


def test_tree_concatenation_equals_library():
    rng, unsplit = random.Random(6), bpe.UnsplitEncoder(default_path())
    for _ in range(150):
        kind = rng.choice(["abcdefghij", "tioneringthand", "a", "日本語é", "ab", "=-_"])
        text = "".join(rng.choice(kind) for _ in range(rng.randint(1, 1500)))
        data = text.encode()
        leaf = rng.choice([3, 7, 32, 100])
        got = unsplit.tree([unsplit.leaf(data[a:b]) for a, b in bpe.halves(len(data), leaf)])
        assert got == unsplit.leaf(data)


@pytest.mark.parametrize("leaf", [16, bpe.LEAF])
def test_encode_decode(spark, make_docs, leaf):
    rng = random.Random(7)
    rows = ROWS + [(100 + i, rand_text(rng, 40) + rng.choice(["", " " * 30, "\n" * 30, "x" * 50, "!?" * 20]) + rand_text(rng)) for i in range(200)]
    got = sorted(tuple(map(str, r)) for r in bpe.encode_decode(make_docs(rows), default_path(), leaf).collect())
    want = []
    for i, t in rows:
        ids = ref_ids(t)
        text = encoder(default_path()).tok.decode(ids, skip_special_tokens=False)
        want.append((str(i), str(len(ids)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)


def brute_store(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*ref_ids(t), 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_store(spark, make_docs, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_BYTES", 40)
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    token_store.write_tokens(make_docs(ROWS), path, default_path(), 2)
    got = [tuple(r) for r in token_store.read_digests(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == brute_store(ROWS)
    assert token_store.lookup(spark, path, 3) == [[*ref_ids("one two  three"), 2]]
    assert sorted(token_store.lookup(spark, path, 1)) == sorted([[2], [*ref_ids("zz again"), 2], [*ref_ids("zz again"), 2]])
    assert token_store.lookup(spark, path, 4) == []


def test_token_store_empty(spark, make_docs):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    token_store.write_tokens(make_docs([]), path, default_path(), 2)
    assert token_store.read_digests(spark, path).count() == 0
    assert bpe.encode_decode(make_docs([]), default_path()).count() == 0


def test_perfect_index():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000, 20000):
        keys = np.unique(rng.integers(-(2**62), 2**62, n))
        index = token_store.PerfectIndex.build(keys, np.arange(len(keys)))
        assert sorted(index.slot(keys).tolist()) == list(range(len(keys)))
        assert (index.find(keys) == np.arange(len(keys))).all()
        assert (index.find(rng.integers(2**62, 2**63 - 1, 500)) < 0).mean() > 0.99 if n else True


def test_queries_over_whole_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in queries.op2_token_store(spark, sf_dir).collect()), key=lambda r: r[1])
    assert got == brute_store([tuple(r) for r in docs])
    assert queries.op6_bpe(spark, sf_dir).count() == len(docs)
