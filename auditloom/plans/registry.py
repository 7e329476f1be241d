"""All registered queries and their SQL; importing the other modules of this package fills them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = sql


from auditloom.plans import code, feeds, findings, knowledge, labelled, lookups, ontology, patches, records, scopes, summaries, texts, timeline, versions  # noqa: E402, F401
