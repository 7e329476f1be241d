"""Merge rules of findings, some of which forbid a merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize
from auditloom.operators.graph import connected_components


#: Links up to so many are joined in one task, more in rounds.
SMALL = 100_000


def _stars(findings: DataFrame, keys: list[str]) -> DataFrame:
    """Links of the findings with equal keys (none of them null) to the least one."""
    known = findings.dropna(subset=keys)
    least = known.groupBy(*keys).agg(F.min("finding_id").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return known.join(least, keys).select(F.col("finding_id").alias("a"), "b").filter("a <> b")


def merge_findings(findings: DataFrame) -> DataFrame:
    """findings: finding_id, bug_class, function, cwe_id, pattern, location -> finding_id, cluster (its least finding), settled.

    Findings merge if class and function are equal, or CWE and code pattern; findings of different classes at one place never
    do, however they are linked. Where the rules are at odds, in this order: no place has two classes in a cluster; equal class and function
    merge; equal CWE and pattern merge within a class; they merge across classes only where all that hangs together by any
    rule is free of such a place (else settled is true). Findings of one class never conflict, so two rounds of components do, and only
    conflicting components go through the second. Null values link nothing; findings without id are left out."""
    known = findings.filter("finding_id is not null").select("finding_id", "bug_class", "function", "cwe_id", "pattern", "location")
    links = _stars(known, ["bug_class", "function"]).unionByName(_stars(known, ["cwe_id", "pattern"]))
    found = connected_components(links, small=SMALL).select(F.col("node").alias("finding_id"), F.col("component").alias("cluster"))
    first = materialize(known.join(found, "finding_id", "left").withColumn("cluster", F.coalesce("cluster", "finding_id")), "clusters")
    placed = first.filter("location is not null").groupBy("cluster", "location").agg(F.min("bug_class").alias("least"), F.max("bug_class").alias("most"))
    odd = materialize(placed.filter("least <> most").select("cluster").distinct(), "conflicts")
    again = materialize(first.join(odd, "cluster", "left_semi").drop("cluster"), "again")
    links = _stars(again, ["bug_class", "function"]).unionByName(_stars(again, ["bug_class", "cwe_id", "pattern"]))
    found = connected_components(links, small=SMALL).select(F.col("node").alias("finding_id"), F.col("component").alias("cluster"))
    second = again.join(found, "finding_id", "left").select("finding_id", F.coalesce("cluster", "finding_id").alias("cluster"), F.lit(True).alias("settled"))
    return first.join(odd, "cluster", "left_anti").select("finding_id", "cluster", F.lit(False).alias("settled")).unionByName(second)
