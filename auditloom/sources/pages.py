"""Paged search results as a data source: a partition a page, retries, filters that go into the query."""

from __future__ import annotations

import glob
import json
import math
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

SIZE = 100
RETRIES = 5


class Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


class SearchReader(DataSourceReader):
    """Rows of all pages of a query. The first page tells how many there are; every page is fetched by the task that needs it, and
    again after a failure, up to RETRIES times; a page that is lost after that fails the job, so results are never short."""

    def __init__(self, schema, options: dict):
        self.names = [f.name for f in schema]
        self.folder, self.query, self.wait = options["path"].removeprefix("file:"), options.get("query", "all"), float(options.get("wait", "1"))

    def pushFilters(self, filters):
        """Equalities become part of the query (``column:value``) where such a search is known; the others are left to Spark."""
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and re.fullmatch(r"[\w.-]+", str(f.value)):
                narrowed = f"{self.query}+{f.attribute[0]}={f.value}"
                if os.path.isdir(f"{self.folder}/query={narrowed}"):
                    self.query = narrowed
                    continue
            yield f

    def fetch(self, page: int, attempt: int) -> dict:
        """A recorded answer; ``error-<attempt>`` beside it stands for a failed try."""
        at = f"{self.folder}/query={self.query}/page={page}"
        if os.path.exists(f"{at}/error-{attempt}"):
            raise OSError(f"page {page} failed")
        found = glob.glob(f"{at}/part-*")
        if not found:
            raise OSError(f"page {page} is not there")
        with open(found[0], encoding="utf-8") as f:
            return json.loads(f.readline())

    def page(self, number: int) -> dict:
        for attempt in range(RETRIES + 1):
            try:
                return self.fetch(number, attempt)
            except OSError as lost:
                if attempt == RETRIES:
                    raise RuntimeError(f"retry limit reached ({RETRIES}): {lost}") from lost
                time.sleep(self.wait * (attempt + 1))
        raise AssertionError

    def partitions(self):
        return [Page(n) for n in range(1, max(1, math.ceil((self.page(1).get("total") or 0) / SIZE)) + 1)]

    def read(self, partition: Page):
        for match in self.page(partition.number).get("matches", []):
            yield tuple(match.get(c) for c in self.names)


class SearchSource(DataSource):
    """``spark.read.format("paged_search").schema(...).option("query", ...).load(folder)``; the folder is one that driver and
    executors can open."""

    @classmethod
    def name(cls) -> str:
        return "paged_search"

    def schema(self):
        return "ip long, port long, country string"

    def reader(self, schema):
        return SearchReader(schema, self.options)


def search(spark: SparkSession, folder: str, schema: str, query: str = "all", wait: float = 1.0) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SearchSource)
    return spark.read.format("paged_search").schema(schema).option("query", query).option("wait", str(wait)).load(folder)


def record(matches: DataFrame, folder: str, query: str = "all") -> None:
    """Write rows (number, from 0 without gaps, and the columns of a match) as the pages of a query."""
    total = matches.count()
    columns = [c for c in matches.columns if c != "number"]
    paged = matches.groupBy((F.floor(F.col("number") / SIZE) + 1).alias("page")).agg(F.collect_list(F.struct(*columns)).alias("matches"))
    paged.select(F.lit(query).alias("query"), "page", F.to_json(F.struct(F.lit(total).alias("total"), "matches")).alias("value")).repartition("page").write.mode("append").partitionBy("query", "page").text(folder)
