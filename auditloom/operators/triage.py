"""Severity, owner, priority, deadline and action of findings; gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import OWNERS, SLA_HOURS
from auditloom.functions.text import choose


def severity(base: Column, exposure: Column, location: Column) -> Column:
    low = F.lower(location)
    return (
        F.when((exposure > 80) & (base == "high"), "critical").when((exposure > 60) & (base == "medium"), "high")
        .when((F.contains(low, F.lit("kernel")) | F.contains(low, F.lit("driver"))) & (base == "medium"), "high").otherwise(base)
    )


def owner(location: Column) -> Column:
    out = F.lit("Security Triage")
    for word, name in reversed(OWNERS):
        out = F.when(F.contains(F.lower(location), F.lit(word)), name).otherwise(out)
    return out


def false_positive_risk(confidence: Column, n_for: Column, n_against: Column, bug_class: Column) -> Column:
    total = n_for + n_against
    return (
        F.when((total > 0) & (F.try_divide(n_for, total) < 0.5), "high").when(confidence < 0.6, "medium")
        .when(F.replace(bug_class, F.lit("_"), F.lit("-")).isin("race-condition", "type-confusion"), "medium").otherwise("low")
    )


def priority(level: Column, risk: Column, exposure: Column) -> Column:
    base = choose(level, {"critical": 1, "high": 2, "medium": 3, "low": 4}, 3) + F.when(risk == "high", 1).otherwise(0)
    return F.least(F.lit(5), F.when(exposure > 80, F.greatest(F.lit(1), base - 1)).otherwise(base))


def action(level: Column, risk: Column) -> Column:
    return F.when(risk == "high", "route-to-investigator").when(level.isin("critical", "high"), "route-to-defend").otherwise("route-to-investigator")


def patch_date(as_of: Column, level: Column, rank: Column) -> Column:
    """Second Tuesday of the month (also when it is past, up to the 14th; after that of the next month); a week from as_of
    for critical findings of the two first priorities."""
    month = F.when(F.dayofmonth(as_of) <= 14, F.trunc(as_of, "MM")).otherwise(F.add_months(F.trunc(as_of, "MM"), 1))
    second = F.date_add(F.next_day(F.date_sub(month, 1), "TU"), 7)
    return F.when((level == "critical") & (rank <= 2), F.date_add(as_of, 7)).otherwise(second)


def triage(findings: DataFrame, as_of: Column) -> DataFrame:
    """findings: finding_id, bug_class, location, severity, confidence, exposure, n_for, n_against."""
    out = findings.withColumn("level", severity(F.col("severity"), F.col("exposure"), F.col("location")))
    out = out.withColumn("risk", false_positive_risk(F.col("confidence"), F.col("n_for"), F.col("n_against"), F.col("bug_class")))
    out = out.withColumn("rank", priority(F.col("level"), F.col("risk"), F.col("exposure")))
    return out.select(
        "finding_id", "level", "risk", "rank", owner(F.col("location")).alias("owner"), choose(F.col("level"), SLA_HOURS, 168).alias("sla_hours"),
        action(F.col("level"), F.col("risk")).alias("action"), F.date_format(patch_date(as_of, F.col("level"), F.col("rank")), "yyyy-MM-dd").alias("patch"),
    )


def gate(findings: DataFrame, key: str) -> DataFrame:
    """The worst severity of each key decides."""
    rank = choose(F.col("severity"), {"low": 1, "medium": 2, "high": 3, "critical": 4}, 0)
    g = findings.groupBy(key).agg(F.max(rank).alias("worst"))
    return g.withColumn("verdict", F.when(F.col("worst") >= 4, "block").when(F.col("worst") == 3, "fix").when(F.col("worst") == 2, "warn").otherwise("pass"))


def confidence(base: Column, quality: Column) -> Column:
    """base weighed by a debate's quality, within 0 and 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), base * (0.7 + 0.3 * quality)))


def remediation(severity_: Column, exposure: Column) -> Column:
    return (
        F.when((severity_ == "critical") & (exposure > 70), "critical").when(severity_.isin("critical", "high") | (exposure > 60), "high")
        .when((severity_ == "medium") | (exposure > 40), "medium").otherwise("low")
    )


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key: an aggregate, so it combines map-side."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def best_model(models: DataFrame, group: str) -> DataFrame:
    """Per group the threat model of most items (confidence items / 10, 1 at most), the first of equals."""
    sure = models.withColumn("confidence", F.least(F.lit(1.0), F.col("items") / 10))
    return sure.groupBy(group).agg(F.max_by(F.struct("ordinal", "confidence"), F.struct("confidence", -F.col("ordinal"))).alias("b")).select(group, "b.*")
