"""A corpus pipeline of five stages over documents: language, near copies, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet into the shared folder
and reads it back for the next. All but the last return the columns of documents. A document without doc_id, which the
operators define, stays unless a stage's own rule rejects it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditloom.llm import bpe, decontaminate, lang_id, secrets, simhash
from auditloom.llm.common import materialize, table
from auditloom.llm.tokenization import default_path

#: The least calibrated probability at which a document's language counts as known.
LEAST_LANGUAGE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or of no clear language go; repeated rows are judged each, by their texts alone."""
    return lang_id.accept(docs, LEAST_LANGUAGE)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints link up the one of the smallest doc_id stays; rows without doc_id stay. Rows of one
    doc_id count as one document: for tables where ids are known to be unique. The pipeline uses near_copy_rows."""
    kept = materialize(simhash.near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct(), "kept")
    # As many ids as documents: a merge join at every size. Rows of one doc_id are one document, the first by text; the window
    # needs no exchange beyond the join's.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    staying = docs.join(kept.hint("merge"), "doc_id", "left_semi").withColumn("__n", first).filter("__n = 1").select(*docs.columns)
    return staying.unionByName(docs.filter("doc_id is null"))


def near_copy_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose SimHash fingerprints link up one stays, that of the smallest doc_id; repeated rows are one. Other texts under
    the same doc_id stay, and so do rows without doc_id. Where ids are unique it keeps what near_copies keeps."""
    key = docs.withColumn("__hash", simhash.text_hash(F.col("text")))
    kept = materialize(simhash.representatives(docs).withColumnRenamed("text_hash", "__hash"), "kept")
    # As many rows as documents: a merge join at every size. The window numbers repeated rows and needs no other exchange.
    first = F.row_number().over(Window.partitionBy("doc_id", "__hash").orderBy("doc_id"))
    staying = key.join(kept.hint("merge"), ["doc_id", "__hash"], "left_semi").withColumn("__n", first).filter("__n = 1").select(*docs.columns)
    return staying.unionByName(docs.filter("doc_id is null"))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; repeated rows are judged each, by their texts alone."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced; n_chars follows. Every row stays; repeated rows come out equal."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    return bpe.encode_decode(docs, default_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copy_rows),
    ("benchmark_passages", benchmark_passages),
    ("without_secrets", without_secrets),
    ("encoded", encoded),
]

#: Language models and encodings are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
