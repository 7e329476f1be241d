"""The stage that keeps one row of linked ones, by rows and not by ids."""

import random

import corpus_pipeline


def test_rows_of_one_id(spark, make_docs, sf_dir):
    rng = random.Random(1)
    word = lambda: " ".join(f"w{rng.randint(0, 99999)}" for _ in range(30))
    a, b, c = word(), word(), word()
    rows = [(1, a), (4, a), (4, b), (4, c), (4, c), (None, a), (None, a), (7, c), (5, None), (6, "")]
    docs = make_docs(rows)
    left = corpus_pipeline.near_copy_rows(spark, docs, sf_dir)
    assert left.columns == docs.columns
    assert sorted(map(str, [(r["doc_id"], r["text"]) for r in left.collect()])) == sorted(map(str, [(1, a), (4, b), (4, c), (None, a), (None, a), (5, None)]))
    assert corpus_pipeline.near_copy_rows(spark, docs.limit(0), sf_dir).count() == 0


def test_run_over_hard_rows(spark, make_docs, sf_dir, tmp_path):
    """Nulls, empty texts and repeated rows through all stages; and an empty table."""
    real = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "en", "s", 0), (10**9 + 1, "123 !!", "en", "s", 6), (None, "the the", "en", "s", 7)], "doc_id long, text string, lang string, source string, n_chars long")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = odd.select(*[odd[c].cast(real.schema[c].dataType) for c in real.columns])
    real.unionByName(odd).unionByName(real.limit(50)).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and set(ids) == {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} and not {10**9, 10**9 + 1} & set(ids)
    real.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
