"""Techniques, likelihood, exposure adjustment and compliance of findings; all catalogs are constants and broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import AGENT_ANALYTICS, AGENT_ATTACKS, AGENT_DEFAULTS, AGENT_DEFENCES, CLASS_ATTACK, CLASS_D3FEND, CLASS_D3FEND_DEFAULT, CLASS_SERVICE, CONTROLS, CWE_ATTACK, CWE_D3FEND, SERVICES, frame, listed
from auditloom.functions.text import choose

HIGH_CLASSES = ("memory_corruption", "auth_bypass", "deserialization", "reentrancy", "oracle_manipulation")

#: Ordinals of techniques that come from the CWE begin here.
CWE_ORDINAL = 100


def attack_techniques(findings: DataFrame) -> DataFrame:
    """finding_id, technique, ordinal: those of the class first, then those of the CWE that are not among them."""
    spark = findings.sparkSession
    by_class = frame(spark, "bug_class string, o int, technique string", listed(CLASS_ATTACK))
    by_cwe = frame(spark, "cwe_id string, o int, technique string", [(k, CWE_ORDINAL + i, v) for k, i, v in listed(CWE_ATTACK)])
    one = findings.select("finding_id", "bug_class").join(F.broadcast(by_class), "bug_class").select("finding_id", "technique", "o")
    two = findings.select("finding_id", "cwe_id").join(F.broadcast(by_cwe), "cwe_id").select("finding_id", "technique", "o")
    return one.unionByName(two).groupBy("finding_id", "technique").agg(F.min("o").alias("ordinal"))


def defence_techniques(findings: DataFrame) -> DataFrame:
    """finding_id, technique, ordinal from the CWE's list."""
    catalog = frame(findings.sparkSession, "cwe_id string, ordinal int, technique string", listed(CWE_D3FEND))
    return findings.select("finding_id", "cwe_id").join(F.broadcast(catalog), "cwe_id").select("finding_id", "technique", "ordinal")


def likelihood(bug_class: Column, techniques: Column) -> Column:
    return F.when(F.lower(bug_class).isin(*HIGH_CLASSES) & (techniques >= 2), "HIGH").when(techniques >= 2, "MEDIUM").when(techniques >= 1, "LOW").otherwise("UNKNOWN")


def adjustment(level: Column, attack: Column, defence: Column) -> Column:
    """Factor on exposure, 1 to 1.5, in hundredths."""
    hundredths = 100 + F.when(level == "HIGH", 20).when(level == "MEDIUM", 10).otherwise(0) + F.when(attack >= 3, 10).otherwise(0) - F.when(defence >= 3, 5).otherwise(0)
    return F.greatest(F.lit(100), F.least(F.lit(150), hundredths)) / 100


def raised(severity: Column) -> Column:
    """One level up."""
    return F.when(severity == "low", "medium").when(severity == "medium", "high").when(severity.isin("high", "critical"), "critical").otherwise(severity)


def enrich(findings: DataFrame) -> DataFrame:
    """Per finding: numbers of techniques, likelihood, adjustment, severity (one up at HIGH)."""
    n = lambda df, name: df.groupBy("finding_id").agg(F.count("*").alias(name))
    out = findings.join(n(attack_techniques(findings), "n_attack"), "finding_id", "left").join(n(defence_techniques(findings), "n_defence"), "finding_id", "left")
    out = out.withColumn("n_attack", F.coalesce("n_attack", F.lit(0))).withColumn("n_defence", F.coalesce("n_defence", F.lit(0)))
    out = out.withColumn("likelihood", likelihood(F.col("bug_class"), F.col("n_attack")))
    out = out.withColumn("adjustment", adjustment(F.col("likelihood"), F.col("n_attack"), F.col("n_defence")))
    return out.withColumn("raised", F.when(F.col("likelihood") == "HIGH", raised(F.col("severity"))).otherwise(F.col("severity")))


def class_defences(findings: DataFrame) -> DataFrame:
    """finding_id, technique by class, with a default list."""
    lists = F.create_map(*[x for k, v in CLASS_D3FEND.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return findings.select("finding_id", "severity", F.explode(F.coalesce(lists[F.col("bug_class")], F.array(*map(F.lit, CLASS_D3FEND_DEFAULT)))).alias("technique"))


def compliance(findings: DataFrame) -> DataFrame:
    """finding_id, framework, control, status: controls that share a technique with the finding."""
    rows = [(f, c, t) for f, cs in CONTROLS.items() for c, ts in cs.items() for t in ts]
    catalog = frame(findings.sparkSession, "framework string, control string, technique string", rows)
    hit = class_defences(findings).join(F.broadcast(catalog), "technique").select("finding_id", "framework", "control", "severity").distinct()
    status = F.when(F.col("severity").isin("critical", "high"), "non-compliant").when(F.col("severity") == "medium", "partial").otherwise("compliant")
    return hit.select("finding_id", "framework", "control", status.alias("status"))


def compliance_kpis(mapped: DataFrame) -> DataFrame:
    g = mapped.groupBy("framework").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "non-compliant").alias("non_compliant"))
    return g.withColumn("rate", (F.col("total") - F.col("non_compliant")) / F.col("total") * 100)


def service(location: Column, bug_class: Column) -> Column:
    """The first service word in the location, else the class's service, else null."""
    words = F.filter(F.array(*map(F.lit, SERVICES)), lambda w: F.contains(F.lower(location), w))
    return F.coalesce(F.get(words, F.lit(0)), choose(F.replace(F.lower(bug_class), F.lit("_"), F.lit("-")), CLASS_SERVICE))


def technique_coverage(findings: DataFrame) -> DataFrame:
    """Findings and distinct classes each attack technique reaches."""
    t = attack_techniques(findings).join(findings.select("finding_id", "bug_class"), "finding_id")
    return t.groupBy("technique").agg(F.count("*").alias("findings"), F.count_distinct("bug_class").alias("classes"))


def class_of_impact(text: Column) -> Column:
    """The class that an impact text speaks of: the first of five groups of words, else logic_error."""
    has = lambda *words: F.lower(text).rlike("|".join(words))
    return (
        F.when(has("memory", "buffer", "overflow"), "memory_corruption").when(has("auth", "access control"), "auth_bypass").when(has("reentrancy", "race"), "reentrancy")
        .when(has("oracle", "price"), "oracle_manipulation").when(has("integer", "arithmetic"), "integer_overflow").otherwise("logic_error")
    )


def narrative(findings: DataFrame, by_cwe: bool = True) -> DataFrame:
    """finding_id, text: the class and the first three of its techniques and then, unless by_cwe is off, the CWE's, in order."""
    ranked = F.slice(F.array_sort(F.collect_list(F.struct("ordinal", "technique"))), 1, 3)
    known = attack_techniques(findings) if by_cwe else attack_techniques(findings).filter(F.col("ordinal") < CWE_ORDINAL)
    first = known.groupBy("finding_id").agg(F.transform(ranked, lambda x: x["technique"]).alias("t"))
    return findings.join(first, "finding_id", "left").select("finding_id", F.concat("bug_class", F.lit(" may lead to "), F.coalesce(F.array_join("t", ", "), F.lit("nothing known"))).alias("text"))


def action_plan(findings: DataFrame, n: int = 10) -> DataFrame:
    """The n first non-compliant controls by the finding's severity."""
    rank = F.create_map(*[F.lit(x) for kv in (("critical", 0), ("high", 1), ("medium", 2), ("low", 3)) for x in kv])[F.col("severity")]
    todo = compliance(findings).filter("status = 'non-compliant'").join(findings.select("finding_id", "severity"), "finding_id")
    return todo.orderBy(rank, "finding_id", "framework", "control").limit(n).select("finding_id", "framework", "control", "severity")


def agent_bindings(findings: DataFrame) -> DataFrame:
    """findings: finding_id, bug_class (with hyphens), attack_ids (array or null) -> finding_id, analytics, defences, attacks: by class,
    each with a default; attacks that a finding brings along stand as they are (none of them counts as none)."""
    def bound(table: dict[str, list[str]], default: list[str]) -> Column:
        lists = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        return F.coalesce(F.try_element_at(lists, F.col("bug_class")), F.array(*map(F.lit, default)))

    tables = (AGENT_ANALYTICS, AGENT_DEFENCES, AGENT_ATTACKS)
    analytics, defences, attacks = (bound(t, d) for t, d in zip(tables, AGENT_DEFAULTS))
    own = F.when(F.size("attack_ids") > 0, F.col("attack_ids"))
    return findings.select("finding_id", analytics.alias("analytics"), defences.alias("defences"), F.coalesce(own, attacks).alias("attacks"))
