"""Exposure scores and priorities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import EXPOSURE, HOST_MULTIPLIER, SEVERITY_RANGE, UNKNOWN_EXPOSURE
from auditloom.functions.text import choose


def metric_exposure(metrics: dict[str, Column]) -> Column:
    """Weighted metrics, each clamped to 0..100 of its range; missing ones add nothing; 100 at most."""
    part = lambda name, c: F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(100.0), c / EXPOSURE[name][1] * 100)) * EXPOSURE[name][0], F.lit(0.0))
    return F.least(F.lit(100.0), sum((part(k, c) for k, c in metrics.items()), F.lit(0.0)))


def intel_scores(intel: DataFrame) -> DataFrame:
    return intel.select("address", metric_exposure({k: F.col(k) for k in EXPOSURE}).alias("exposure"))


def midpoint(severity: Column) -> Column:
    return choose(severity, {k: (a + b) / 2 for k, (a, b) in SEVERITY_RANGE.items()}, 5.0)


def band(score: Column) -> Column:
    """Severity whose range holds the score; gaps and scores above 10 are medium."""
    out = F.lit("medium")
    for name, (a, b) in reversed(SEVERITY_RANGE.items()):
        out = F.when(score.between(a, b), name).otherwise(out)
    return out


def impact(exposure: Column) -> Column:
    return F.when(exposure >= 80, "CRITICAL").when(exposure >= 50, "HIGH").when(exposure >= 20, "MEDIUM").otherwise("LOW")


def prioritize(findings: DataFrame, intel: DataFrame) -> DataFrame:
    """findings (finding_id, severity, addresses) with intel (address, exposure): mean exposure, priority, adjusted severity.

    Addresses without intel count UNKNOWN_EXPOSURE; no addresses count 0."""
    each = findings.select("finding_id", "severity", F.explode_outer("addresses").alias("address")).join(intel, "address", "left")
    value = F.when(F.col("address").isNotNull(), F.coalesce("exposure", F.lit(UNKNOWN_EXPOSURE)))
    g = each.groupBy("finding_id", "severity").agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("exposure"))
    g = g.withColumn("priority", F.col("exposure") * 0.7 + midpoint(F.col("severity")) * 0.3)
    return g.withColumn("adjusted", band(F.col("priority"))).withColumn("impact", impact(F.col("exposure")))


def transitions(prioritized: DataFrame) -> DataFrame:
    return prioritized.groupBy(F.concat_ws(" -> ", "severity", "adjusted").alias("transition")).agg(F.count("*").alias("n"))


def exposure_bands(prioritized: DataFrame) -> DataFrame:
    return prioritized.groupBy("impact").agg(F.count("*").alias("n"))


def host_exposure(hosts: Column, services: Column, countries: Column, vulns: Column, bug_class: Column) -> Column:
    points = F.when(hosts > 0, F.least(F.lit(40.0), 10 + hosts * 0.5)).otherwise(0.0)
    points = points + F.least(F.lit(20), services * 5) + F.least(F.lit(20), countries * 4) + F.least(F.lit(20), vulns * 2)
    return F.least(F.lit(100.0), points * choose(F.lower(bug_class), HOST_MULTIPLIER, 1.0))


def host_metadata(hosts: DataFrame) -> DataFrame:
    """Per address: hosts, distinct services, countries and vulnerabilities, sorted; and the score that follows."""
    s = lambda c: F.array_sort(F.collect_set(c)).alias(c)
    g = hosts.groupBy("address").agg(F.count("*").alias("hosts"), s("service"), s("country"), s("vuln"))
    return g.withColumn("exposure", host_exposure(F.col("hosts"), F.size("service"), F.size("country"), F.size("vuln"), F.lit("buffer-overflow")))


def agent_exposure(severity: Column, location: Column) -> Column:
    """Base by severity, more for kernels and drivers, else for hypervisors; 100 at most."""
    low = F.lower(location)
    base = choose(severity, {"critical": 90.0, "high": 70.0, "medium": 50.0, "low": 30.0}, 50.0)
    more = F.when(low.rlike("kernel|driver"), 15.0).when(low.rlike("hyper-?v"), 20.0).otherwise(0.0)
    return F.least(F.lit(100.0), base + more)
