"""Enrichment, exposure, compliance and triage."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import AGENT_ANALYTICS, AGENT_ATTACKS, AGENT_DEFAULTS, AGENT_DEFENCES, CLASS_ATTACK, CLASS_D3FEND, CLASS_D3FEND_DEFAULT, CLASS_SERVICE, CONTROLS, CWE_ATTACK, CWE_D3FEND, EXPOSURE, OWNERS, SERVICES, listed, values_sql
from auditloom.operators import enrich, exposure, triage
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, with_sql

r6 = lambda c: F.round(c, 6)

attack_class = values_sql(listed(CLASS_ATTACK), "k, o, v", "a")
attack_cwe = values_sql([(k, 100 + i, v) for k, i, v in listed(CWE_ATTACK)], "k, o, v", "a")
defence_cwe = values_sql(listed(CWE_D3FEND), "k, o, v", "a")
ATTACK = f"SELECT finding_id, v AS technique, min(o) AS ordinal FROM (SELECT finding_id, v, o FROM findings JOIN {attack_class} ON bug_class = k UNION ALL SELECT finding_id, v, o FROM findings JOIN {attack_cwe} ON cwe_id = k) GROUP BY 1, 2"
DEFENCE = f"SELECT finding_id, v AS technique, o AS ordinal FROM findings JOIN {defence_cwe} ON cwe_id = k"
register("attack_enrich", lambda s, d: enrich.attack_techniques(domain(s, d, "findings")), with_sql(["findings"], "SELECT * FROM atk", atk=ATTACK))
register("d3fend_cascade", lambda s, d: enrich.defence_techniques(domain(s, d, "findings")), with_sql(["findings"], "SELECT * FROM de", de=DEFENCE))
ENRICHED = {
    "atk": ATTACK,
    "de": DEFENCE,
    "nn": "SELECT f.*, coalesce(a.n, 0) AS n_attack, coalesce(d.n, 0) AS n_defence FROM findings f LEFT JOIN (SELECT finding_id, count(*) AS n FROM atk GROUP BY 1) a USING (finding_id) LEFT JOIN (SELECT finding_id, count(*) AS n FROM de GROUP BY 1) d USING (finding_id)",
    "li": "SELECT *, CASE WHEN bug_class IN ('memory_corruption', 'auth_bypass', 'deserialization', 'reentrancy', 'oracle_manipulation') AND n_attack >= 2 THEN 'HIGH' WHEN n_attack >= 2 THEN 'MEDIUM' WHEN n_attack >= 1 THEN 'LOW' ELSE 'UNKNOWN' END AS likelihood FROM nn",
    "ad": "SELECT *, greatest(100, least(150, 100 + CASE likelihood WHEN 'HIGH' THEN 20 WHEN 'MEDIUM' THEN 10 ELSE 0 END + CASE WHEN n_attack >= 3 THEN 10 ELSE 0 END - CASE WHEN n_defence >= 3 THEN 5 ELSE 0 END)) / 100 AS adjustment FROM li",
}
register("likelihood", lambda s, d: enrich.enrich(domain(s, d, "findings")).groupBy("likelihood").agg(F.count("*").alias("n")), with_sql(["findings"], "SELECT likelihood, count(*) AS n FROM li GROUP BY 1", **ENRICHED))
register(
    "exposure_adjust",
    lambda s, d: enrich.enrich(domain(s, d, "findings")).select("finding_id", "n_attack", "n_defence", r6("adjustment").alias("adjustment"), "raised"),
    with_sql(["findings"], "SELECT finding_id, n_attack, n_defence, round(adjustment, 6) AS adjustment, CASE WHEN likelihood = 'HIGH' THEN CASE severity WHEN 'low' THEN 'medium' WHEN 'medium' THEN 'high' ELSE 'critical' END ELSE severity END AS raised FROM ad", **ENRICHED),
)
register("technique_coverage", lambda s, d: enrich.technique_coverage(domain(s, d, "findings")), with_sql(["findings"], "SELECT technique, count(*) AS findings, count(DISTINCT bug_class) AS classes FROM atk JOIN findings USING (finding_id) GROUP BY 1", atk=ATTACK))
controls = values_sql([(f, c, t) for f, cs in CONTROLS.items() for c, ts in cs.items() for t in ts], "framework, control, technique")
by_class = values_sql([(k, v) for k, vs in CLASS_D3FEND.items() for v in vs], "k, v", "a")
COMPLIANCE = {
    "te": f"SELECT finding_id, severity, v AS technique FROM findings JOIN {by_class} ON bug_class = k UNION ALL SELECT finding_id, severity, v FROM findings CROSS JOIN {values_sql([(v,) for v in CLASS_D3FEND_DEFAULT], 'v', 'z')} WHERE bug_class NOT IN ({', '.join(repr(k) for k in CLASS_D3FEND)})",
    "co": f"SELECT DISTINCT finding_id, framework, control, CASE WHEN severity IN ('critical', 'high') THEN 'non-compliant' WHEN severity = 'medium' THEN 'partial' ELSE 'compliant' END AS status FROM te JOIN {controls} USING (technique)",
}
register("compliance_map", lambda s, d: enrich.compliance(domain(s, d, "findings")), with_sql(["findings"], "SELECT * FROM co", **COMPLIANCE))
register(
    "compliance_kpis",
    lambda s, d: enrich.compliance_kpis(enrich.compliance(domain(s, d, "findings"))).withColumn("rate", r6("rate")),
    with_sql(["findings"], "SELECT framework, count(*) AS total, count(*) FILTER (status = 'non-compliant') AS non_compliant, round((count(*) - count(*) FILTER (status = 'non-compliant')) / count(*) * 100, 6) AS rate FROM co GROUP BY 1", **COMPLIANCE),
)
register(
    "service_of",
    lambda s, d: domain(s, d, "findings").select("finding_id", enrich.service(F.col("location"), F.col("bug_class")).alias("service")),
    with_sql(["findings"], "SELECT finding_id, coalesce(list_filter([" + ", ".join(f"'{w}'" for w in SERVICES) + "], lambda w: contains(lower(location), w))[1], CASE replace(bug_class, '_', '-') " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_SERVICE.items()) + " END) AS service FROM findings"),
)
SCORE = "least(100.0, " + " + ".join(f"coalesce(greatest(0.0, least(100.0, {k} / CAST({m} AS DOUBLE) * 100)) * CAST({w} AS DOUBLE), 0.0)" for k, (w, m) in EXPOSURE.items()) + ")"
register("metric_exposure", lambda s, d: exposure.intel_scores(domain(s, d, "intel")).withColumn("exposure", r6("exposure")), with_sql(["intel"], f"SELECT address, round({SCORE}, 6) AS exposure FROM intel"))


def _prioritized(s, d):
    f = domain(s, d, "findings").select("finding_id", "severity", F.array("address", F.col("address") + 3, F.col("address") * 2).alias("addresses"))
    return exposure.prioritize(f, exposure.intel_scores(domain(s, d, "intel")))


PRIORITY = {
    "sc": f"SELECT address, {SCORE} AS e FROM intel",
    "ex": "SELECT finding_id, severity, unnest([address, address + 3, address * 2]) AS address FROM findings",
    "av": "SELECT finding_id, severity, avg(coalesce(e, 10.0)) AS exposure FROM ex LEFT JOIN sc USING (address) GROUP BY 1, 2",
    "pr": "SELECT *, exposure * CAST(0.7 AS DOUBLE) + CASE severity WHEN 'critical' THEN (CAST(9.0 AS DOUBLE) + 10.0) / 2 WHEN 'high' THEN (CAST(7.0 AS DOUBLE) + CAST(8.9 AS DOUBLE)) / 2 WHEN 'medium' THEN (CAST(4.0 AS DOUBLE) + CAST(6.9 AS DOUBLE)) / 2 ELSE (CAST(0.1 AS DOUBLE) + CAST(3.9 AS DOUBLE)) / 2 END * CAST(0.3 AS DOUBLE) AS priority FROM av",
    "bd": "SELECT *, CASE WHEN priority BETWEEN 9.0 AND 10.0 THEN 'critical' WHEN priority BETWEEN 7.0 AND 8.9 THEN 'high' WHEN priority BETWEEN 4.0 AND 6.9 THEN 'medium' WHEN priority BETWEEN 0.1 AND 3.9 THEN 'low' ELSE 'medium' END AS adjusted, CASE WHEN exposure >= 80 THEN 'CRITICAL' WHEN exposure >= 50 THEN 'HIGH' WHEN exposure >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS impact FROM pr",
}
register("prioritize", lambda s, d: _prioritized(s, d).withColumn("exposure", r6("exposure")).withColumn("priority", r6("priority")), with_sql(["findings", "intel"], "SELECT finding_id, severity, round(exposure, 6) AS exposure, round(priority, 6) AS priority, adjusted, impact FROM bd", **PRIORITY))
register("severity_transitions", lambda s, d: exposure.transitions(_prioritized(s, d)), with_sql(["findings", "intel"], "SELECT severity || ' -> ' || adjusted AS transition, count(*) AS n FROM bd GROUP BY 1", **PRIORITY))
register("exposure_bands", lambda s, d: exposure.exposure_bands(_prioritized(s, d)), with_sql(["findings", "intel"], "SELECT impact, count(*) AS n FROM bd GROUP BY 1", **PRIORITY))
register(
    "host_exposure",
    lambda s, d: exposure.host_metadata(domain(s, d, "hosts")).select("address", "hosts", F.concat_ws(",", "service").alias("service"), F.concat_ws(",", "country").alias("country"), F.concat_ws(",", "vuln").alias("vuln"), r6("exposure").alias("exposure")),
    with_sql(["hosts"], "SELECT address, count(*) AS hosts, array_to_string(list_sort(list(DISTINCT service)), ',') AS service, array_to_string(list_sort(list(DISTINCT country)), ',') AS country, array_to_string(list_sort(list(DISTINCT vuln)), ',') AS vuln, round(least(100.0, (least(40.0, 10 + count(*) * 0.5) + least(20, count(DISTINCT service) * 5) + least(20, count(DISTINCT country) * 4) + least(20, count(DISTINCT vuln) * 2)) * CAST(1.3 AS DOUBLE)), 6) AS exposure FROM hosts GROUP BY address"),
)
AS_OF = "2024-03-13"


def _triage(s, d):
    v = domain(s, d, "votes").groupBy("finding_id").agg(F.count_if(F.col("stance") == "FOR").alias("n_for"), F.count_if(F.col("stance") == "AGAINST").alias("n_against"))
    f = domain(s, d, "findings").join(v, "finding_id").withColumn("confidence", F.col("score")).withColumn("exposure", (F.col("finding_id") * 7 % 101).cast("double"))
    return triage.triage(f, F.lit(AS_OF).cast("date"))


TRIAGE = {
    "vo": "SELECT finding_id, count(*) FILTER (stance = 'FOR') AS n_for, count(*) FILTER (stance = 'AGAINST') AS n_against FROM votes GROUP BY 1",
    "t1": "SELECT *, CAST(finding_id * 7 % 101 AS DOUBLE) AS exposure FROM findings JOIN vo USING (finding_id)",
    "t2": "SELECT *, CASE WHEN exposure > 80 AND severity = 'high' THEN 'critical' WHEN exposure > 60 AND severity = 'medium' THEN 'high' WHEN (contains(location, 'kernel') OR contains(location, 'driver')) AND severity = 'medium' THEN 'high' ELSE severity END AS level, CASE WHEN n_for + n_against > 0 AND n_for / (n_for + n_against) < 0.5 THEN 'high' WHEN score < 0.6 THEN 'medium' WHEN bug_class IN ('race_condition', 'type_confusion') THEN 'medium' ELSE 'low' END AS risk FROM t1",
    "t3": "SELECT *, CASE level WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 WHEN 'low' THEN 4 ELSE 3 END + CASE WHEN risk = 'high' THEN 1 ELSE 0 END AS b FROM t2",
    "t4": "SELECT *, CAST(least(5, CASE WHEN exposure > 80 THEN greatest(1, b - 1) ELSE b END) AS INT) AS rank FROM t3",
}
OWNER = "CASE " + " ".join(f"WHEN contains(lower(location), '{w}') THEN '{n}'" for w, n in OWNERS) + " ELSE 'Security Triage' END"
register(
    "triage_full",
    _triage,
    with_sql(
        ["findings", "votes"],
        f"SELECT finding_id, level, risk, rank, {OWNER} AS owner, CASE level WHEN 'critical' THEN 24 WHEN 'high' THEN 72 WHEN 'medium' THEN 168 WHEN 'low' THEN 720 ELSE 168 END AS sla_hours, CASE WHEN risk = 'high' THEN 'route-to-investigator' WHEN level IN ('critical', 'high') THEN 'route-to-defend' ELSE 'route-to-investigator' END AS action, CASE WHEN level = 'critical' AND rank <= 2 THEN '2024-03-20' ELSE '2024-03-12' END AS patch FROM t4",
        **TRIAGE,
    ),
)
register(
    "patch_tuesday",
    lambda s, d: s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.date_format(triage.patch_date(F.col("o_orderdate").cast("date"), F.lit("high"), F.lit(3)), "yyyy-MM-dd").alias("patch")),
    "SELECT o_orderkey, strftime(m + INTERVAL 7 DAY + INTERVAL 1 DAY * ((9 - isodow(m)) % 7), '%Y-%m-%d') AS patch FROM (SELECT o_orderkey, CASE WHEN day(o_orderdate) <= 14 THEN date_trunc('month', o_orderdate) ELSE date_trunc('month', o_orderdate) + INTERVAL 1 MONTH END AS m FROM orders)",
)
register(
    "gate_decision",
    lambda s, d: triage.gate(domain(s, d, "findings"), "location"),
    with_sql(["findings"], "SELECT location, worst, CASE WHEN worst >= 4 THEN 'block' WHEN worst = 3 THEN 'fix' WHEN worst = 2 THEN 'warn' ELSE 'pass' END AS verdict FROM (SELECT location, max(CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 ELSE 0 END) AS worst FROM findings GROUP BY 1)"),
)
register(
    "impact_class",
    lambda s, d: domain(s, d, "commits").select("commit_id", enrich.class_of_impact(F.col("message")).alias("bug_class")),
    with_sql(["commits"], "SELECT commit_id, CASE WHEN regexp_matches(lower(message), 'memory|buffer|overflow') THEN 'memory_corruption' WHEN regexp_matches(lower(message), 'auth|access control') THEN 'auth_bypass' WHEN regexp_matches(lower(message), 'reentrancy|race') THEN 'reentrancy' WHEN regexp_matches(lower(message), 'oracle|price') THEN 'oracle_manipulation' WHEN regexp_matches(lower(message), 'integer|arithmetic') THEN 'integer_overflow' ELSE 'logic_error' END AS bug_class FROM commits"),
)
register(
    "threat_narrative",
    lambda s, d: enrich.narrative(domain(s, d, "findings"), by_cwe=False),
    with_sql(["findings"], "SELECT finding_id, bug_class || ' may lead to ' || coalesce(t, 'nothing known') AS text FROM findings LEFT JOIN (SELECT finding_id, string_agg(technique, ', ' ORDER BY ordinal) AS t FROM atk WHERE ordinal < 3 GROUP BY 1) USING (finding_id)", atk=ATTACK),
)
register(
    "threat_narrative_by_cwe",
    lambda s, d: enrich.narrative(domain(s, d, "findings")),
    with_sql(["findings"], "SELECT finding_id, bug_class || ' may lead to ' || coalesce(t, 'nothing known') AS text FROM findings LEFT JOIN (SELECT finding_id, string_agg(technique, ', ' ORDER BY r) AS t FROM (SELECT *, row_number() OVER (PARTITION BY finding_id ORDER BY ordinal, technique) AS r FROM atk) WHERE r <= 3 GROUP BY 1) USING (finding_id)", atk=ATTACK),
)
register(
    "agent_exposure",
    lambda s, d: domain(s, d, "findings").select("finding_id", exposure.agent_exposure(F.col("severity"), F.col("location")).alias("exposure")),
    with_sql(["findings"], "SELECT finding_id, least(100.0, CASE severity WHEN 'critical' THEN 90.0 WHEN 'high' THEN 70.0 WHEN 'medium' THEN 50.0 WHEN 'low' THEN 30.0 ELSE 50.0 END + CASE WHEN regexp_matches(lower(location), 'kernel|driver') THEN 15.0 WHEN regexp_matches(lower(location), 'hyper-?v') THEN 20.0 ELSE 0.0 END)::DOUBLE AS exposure FROM findings"),
)
register(
    "remediation_priority",
    lambda s, d: domain(s, d, "findings").select("finding_id", triage.remediation(F.col("severity"), F.col("score") * 100).alias("priority"), F.round(triage.confidence(F.col("score"), F.col("finding_id") % 11 / 10), 6).alias("confidence")),
    with_sql(["findings"], "SELECT finding_id, CASE WHEN severity = 'critical' AND score * 100 > 70 THEN 'critical' WHEN severity IN ('critical', 'high') OR score * 100 > 60 THEN 'high' WHEN severity = 'medium' OR score * 100 > 40 THEN 'medium' ELSE 'low' END AS priority, round(least(1.0, greatest(0.0, score * (CAST(0.7 AS DOUBLE) + CAST(0.3 AS DOUBLE) * (finding_id % 11 / 10)))), 6) AS confidence FROM findings"),
)
register(
    "intel_latest",
    lambda s, d: triage.latest(domain(s, d, "findings").select("address", "finding_id", "score"), "address", "finding_id"),
    with_sql(["findings"], "SELECT address, finding_id, score FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY finding_id DESC) AS r FROM findings) WHERE r = 1"),
)
register(
    "best_threat_model",
    lambda s, d: triage.best_model(s.read.parquet(f"{d}/part.parquet").selectExpr("p_brand AS target", "p_partkey AS ordinal", "p_size % 13 AS items"), "target").withColumn("confidence", r6("confidence")),
    "SELECT target, ordinal, round(confidence, 6) AS confidence FROM (SELECT p_brand AS target, p_partkey AS ordinal, least(1.0, p_size % 13 / 10) AS confidence, row_number() OVER (PARTITION BY p_brand ORDER BY least(1.0, p_size % 13 / 10) DESC, p_partkey) AS r FROM part) WHERE r = 1",
)
register(
    "action_plan",
    lambda s, d: enrich.action_plan(domain(s, d, "findings")),
    with_sql(["findings"], "SELECT finding_id, framework, control, severity FROM co JOIN findings USING (finding_id) WHERE status = 'non-compliant' ORDER BY CASE severity WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, finding_id, framework, control LIMIT 10", **COMPLIANCE),
)
register("prioritized_order", lambda s, d: _prioritized(s, d).withColumn("priority", r6("priority")).orderBy(F.desc("priority"), "finding_id").limit(50).select("finding_id", "priority"), with_sql(["findings", "intel"], "SELECT finding_id, round(priority, 6) AS priority FROM bd ORDER BY round(priority, 6) DESC, finding_id LIMIT 50", **PRIORITY))


def _bound(s, d):
    f = domain(s, d, "findings").select("finding_id", F.translate("bug_class", "_", "-").alias("bug_class"), F.when(F.col("finding_id") % 5 == 0, F.array(F.lit("T1"), F.col("cwe_id"))).when(F.col("finding_id") % 5 == 1, F.array().cast("array<string>")).alias("attack_ids"))
    return enrich.agent_bindings(f).select("finding_id", *(F.concat_ws(",", c).alias(c) for c in ("analytics", "defences", "attacks")))


_case = lambda table, default: "CASE translate(bug_class, '_', '-') " + " ".join(f"WHEN '{k}' THEN '{','.join(v)}'" for k, v in table.items()) + f" ELSE '{','.join(default)}' END"
register(
    "agent_bindings",
    _bound,
    with_sql(["findings"], f"SELECT finding_id, {_case(AGENT_ANALYTICS, AGENT_DEFAULTS[0])} AS analytics, {_case(AGENT_DEFENCES, AGENT_DEFAULTS[1])} AS defences, CASE WHEN finding_id % 5 = 0 THEN 'T1,' || cwe_id ELSE {_case(AGENT_ATTACKS, AGENT_DEFAULTS[2])} END AS attacks FROM findings"),
)
