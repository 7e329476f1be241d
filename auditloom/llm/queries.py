"""The queries of the operators over the synthetic tables, and SQL where it can express them.

Each query applies its operator with production parameters to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from auditloom.llm import bpe, chat_format, collocations, decontaminate, divergence, embedding_dedup, fingerprints, lang_id, lm, secrets, simhash, substring_dedup, token_store
from auditloom.llm.common import shared_dir, table
from auditloom.llm.tokenization import default_path

END_ID = 2
CONTROLS = "</s>[INST] ok [/INST]"


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, default_path(), END_ID)
    return token_store.read_digests(spark, path)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), default_path())


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROLS), (-1, 1, "assistant", CONTROLS)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(own)))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.report(table(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_token_store": op2_token_store,
    "op3_secrets": op3_secrets,
    "op4_language": op4_language,
    "op5_lm_score": op5_lm_score,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_chat_format": op8_chat_format,
    "op9_decontaminate": op9_decontaminate,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_fingerprints": op12_fingerprints,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {"op3_secrets": secrets.SQL, "op8_chat_format": chat_format.SQL, "op11_source_divergence": divergence.SQL, "op13_collocations": collocations.SQL}
