from auditloom.llm import lang_id


def test_rare_language_is_learned(spark):
    """Six languages of 1500 documents and one of 12: the share of 280 is 40 each, and the six hold small hashes enough for all."""
    rows = [(k * 1500 + i, " ".join(chr(97 + 3 * k + j) * 3 for j in range(3)), f"l{k}") for k in range(6) for i in range(1500)]
    rows += [(10_000 + i, "zzz yyy zyz", "rare") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.train(docs, 280)
    assert model.predict(["zzz yyy zyz"])[0][0] == "rare"
    sizes = {f"l{k}": 1500 for k in range(6)} | {"rare": 12}
    got = {r["lang"]: r["count"] for r in lang_id.sampled(docs, sizes, 280).groupBy("lang").count().collect()}
    assert got == lang_id.shares(sizes, 280) and got["rare"] == 12 and sum(got.values()) == 280
