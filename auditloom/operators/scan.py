"""Collected findings: ids, filters, summaries, the best of each location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.catalogs import RISK_CLASS, THREAT_CLASS
from auditloom.functions.text import choose


def finding_hash(bug_class: Column, location: Column) -> Column:
    """The first 16 hexadecimal digits of sha256 of class:location."""
    return F.substring(F.sha2(F.concat_ws(":", bug_class, location), 256), 1, 16)


def above(findings: DataFrame, score: float = 0.5) -> DataFrame:
    return findings.filter(F.col("score") >= score)


def collector_summary(findings: DataFrame) -> DataFrame:
    """One row: total, average, greatest and least score; 0.0 where there are none."""
    zero = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    return findings.agg(F.count("*").alias("total"), zero(F.avg("score"), "avg_score"), zero(F.max("score"), "max_score"), zero(F.min("score"), "min_score"))


def class_counts(findings: DataFrame) -> DataFrame:
    return findings.groupBy("bug_class").agg(F.count("*").alias("n"))


def best_per_location(findings: DataFrame, ordinal: str = "finding_id") -> DataFrame:
    """The finding of the highest score of each location, the first one of equals. An aggregate, so it combines map-side."""
    best = F.max_by(F.struct(*[c for c in findings.columns if c != "location"]), F.struct("score", -F.col(ordinal)))
    return findings.groupBy("location").agg(best.alias("b"), F.min(ordinal).alias("first_seen")).select("location", "b.*", "first_seen")


def top(findings: DataFrame, n: int, ordinal: str = "finding_id") -> DataFrame:
    return findings.orderBy(F.desc("score"), ordinal).limit(n)


def class_of_risk(risk: Column) -> Column:
    return choose(risk, RISK_CLASS, "logic_error")


def class_of_threat(threat: Column) -> Column:
    return choose(F.lower(threat), THREAT_CLASS, "logic_error")


def primary_language(files: DataFrame) -> DataFrame:
    """The extension of most files, of equals the one that sorts first."""
    ext = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    counts = files.groupBy(ext.alias("ext")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "ext").limit(1)


def first_per_key(findings: DataFrame, ordinal: str = "finding_id") -> DataFrame:
    """One finding for each class and first 50 characters of the location: the first."""
    key = F.concat_ws(":", "bug_class", F.substring("location", 1, 50))
    return findings.groupBy(key.alias("key")).agg(F.min(ordinal).alias("finding_id"), F.count("*").alias("n"))


def location_clusters(findings: DataFrame, ordinal: str = "finding_id") -> DataFrame:
    """Findings of one location: representative (first of the highest score), size, and a cluster number by first sight.

    Numbers are global, so they are counted in two steps: within ranges of first sight, and over the ranges' sizes."""
    grouped = findings.groupBy("location").agg(F.max_by(ordinal, F.struct("score", -F.col(ordinal))).alias("representative"), F.count("*").alias("n"), F.min(ordinal).alias("first_seen"))
    return numbered(grouped, "first_seen", "cluster_id")


def numbered(df: DataFrame, order: str, name: str, ranges: int = 256) -> DataFrame:
    """df with a number from 0 in ascending order of a unique integer column, without a window over all rows."""
    span = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    lo, wide = span["lo"] or 0, ((span["hi"] or 0) - (span["lo"] or 0)) // ranges + 1
    dealt = df.withColumn("__range", F.floor((F.col(order) - lo) / F.lit(wide)))
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = sizes.select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))  # a row a range
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(order)) - 1
    return dealt.withColumn("__at", inside).join(F.broadcast(before), "__range").withColumn(name, F.col("__before") + F.col("__at")).select(*df.columns, name)
