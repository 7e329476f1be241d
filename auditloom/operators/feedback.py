"""Missed vulnerabilities and what they have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missed(truth: DataFrame, found: DataFrame) -> DataFrame:
    return truth.join(found.select("vuln_id"), "vuln_id", "left_anti")


def frequencies(missed_: DataFrame) -> DataFrame:
    """Counts by class, by language, by stage and in all (a row even if nothing is missed)."""
    by = ("category", "lang", "stage")
    sums = missed_.groupingSets([[F.col(c)] for c in by], *map(F.col, by)).agg(F.count("*").alias("n"))
    sums = sums.unionByName(missed_.agg(F.count("*").alias("n")), allowMissingColumns=True)
    return sums.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in by], "n")


def trending(missed_: DataFrame, n: int = 5) -> DataFrame:
    g = missed_.groupBy("category").agg(F.count("*").alias("n"), F.min("vuln_id").alias("first_seen"))
    return g.orderBy(F.desc("n"), "first_seen").limit(n)


def last_of_each(missed_: DataFrame, k: int = 5) -> DataFrame:
    w = Window.partitionBy("agent_id").orderBy(F.desc("vuln_id"))
    return missed_.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("agent_id", "vuln_id", "r")


def patterns(missed_: DataFrame, least: int = 3, examples: int = 3) -> DataFrame:
    """Classes missed at least so often, with their first examples in order."""
    w = Window.partitionBy("category").orderBy("vuln_id")
    some = missed_.withColumn("r", F.row_number().over(w)).groupBy("category").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.when(F.col("r") <= examples, F.col("vuln_id")))).alias("examples"))
    return some.filter(F.col("n") >= least)


def agent_profile(missed_: DataFrame) -> DataFrame:
    s = lambda c, name: F.array_sort(F.collect_set(c)).alias(name)
    return missed_.groupBy("agent_id").agg(F.count("*").alias("total"), s("category", "classes"), s("lang", "languages"))


def recommendations(missed_: DataFrame, least: int = 3) -> DataFrame:
    g = missed_.groupBy("lang").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return g.select(F.format_string("Improve %s analysis: %d missed", "lang", "n").alias("text"))
