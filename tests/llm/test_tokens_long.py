"""Hot ids in the token store, and queries over tables with long unsplit texts."""

import hashlib
import random
import uuid
import zlib

import numpy as np

from auditloom.llm import bpe, queries, token_store
from auditloom.llm.common import shared_dir
from auditloom.llm.tokenization import default_path, encoder


def ids_of(text):
    return encoder(default_path()).tok.encode(text or "", add_special_tokens=False).ids


def test_one_id_in_half_the_rows(spark, make_docs):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these rows would fit one part
    rng = random.Random(3)
    rows = [(rng.choice([7, 7, None, k]), " ".join(rng.choice(["alpha", "beta.\nGamma", "x1", "(y)"]) for _ in range(rng.randint(0, 60)))) for k in range(400)]
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    token_store.write_tokens(make_docs(rows), path, default_path(), 2)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted((tuple(r) for r in token_store.read_digests(spark, path).collect()), key=lambda r: r[1])
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*ids_of(t), 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert spark.read.parquet(f"{path}/shards").filter("first_key = 7 or last_key = 7").select("part").distinct().count() > 1
    assert [r["ids"] for r in token_store.documents_of(spark, path, 7).collect()] == [[*ids_of(t), 2] for t in sorted(t for i, t in rows if i == 7)]


def test_encode_query_with_long_unsplit_texts(spark, make_docs, tmp_path):
    rng = random.Random(4)
    run = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    rows = [(1, run("abcdefgh", 60_000)), (2, "see " + run("tioneringthand", 9000) + " and " + run("=-_", 20_000) + "\n" * 6000 + "end"), (3, run("日本語é", 8000)), (4, "short text"), (None, " " * 9000), (5, "a" * 300_000)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(map(str, r)) for r in queries.op6_bpe(spark, str(tmp_path)).collect())
    want = []
    for i, t in rows:
        ids = ids_of(t)
        text = encoder(default_path()).tok.decode(ids, skip_special_tokens=False)
        want.append((str(i), str(len(ids)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want)
    assert sum(bpe.cut(t, []) is not None for _, t in rows) == 5  # these took the tree


def test_encode_query_over_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: hashlib.sha256(",".join(map(str, ids_of(r["text"]))).encode()).hexdigest() for r in docs}
    assert {r["doc_id"]: r["ids_sha256"] for r in queries.op6_bpe(spark, sf_dir).collect()} == want
