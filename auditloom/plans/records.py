"""Controls, verification, models, paths, estimates."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import CWE_D3FEND, THREAT_CLASS, listed, values_sql
from auditloom.operators import knowledge as kn
from auditloom.operators import scan
from auditloom.plans.registry import register
from auditloom.sources.bindings import cases, domain, with_sql

joined = lambda c: F.concat_ws(",", c).alias(c)

register("cci_controls", lambda s, d: kn.controls_of(domain(s, d, "controls")).withColumn("controls", joined("controls")), with_sql(["controls"], "SELECT technique_id, array_to_string(list_sort(list(DISTINCT control)), ',') AS controls FROM controls GROUP BY 1"))
register("control_coverage", lambda s, d: kn.control_coverage(domain(s, d, "controls")), with_sql(["controls"], "SELECT count(*) AS total, count(DISTINCT control) AS controls, count(DISTINCT technique_id) AS techniques FROM controls"))
register(
    "suggest_techniques",
    lambda s, d: kn.suggest_techniques(domain(s, d, "targets"), domain(s, d, "controls")),
    with_sql(
        ["targets", "controls"],
        "SELECT DISTINCT requirement, technique_id FROM a JOIN c USING (word) WHERE length(word) > 5",
        a="SELECT requirement, unnest(regexp_split_to_array(lower(requirement), '[^a-z]+')) AS word FROM (SELECT DISTINCT requirement FROM targets)",
        c="SELECT technique_id, unnest(regexp_split_to_array(lower(name || ' ' || definition), '[^a-z]+')) AS word FROM controls",
    ),
)
register(
    "verification_report",
    lambda s, d: kn.verification_report(domain(s, d, "targets")),
    with_sql(["targets"], "SELECT property, method, " + ", ".join(f"count(*) FILTER (status = '{x}') AS {x}" for x in ("verified", "violated", "unknown", "timeout")) + " FROM targets GROUP BY 1, 2"),
)
TIER = cases("event_id", ["frontier", "balanced", "distilled"])
register(
    "choose_model",
    lambda s, d: kn.choose_model(s.read.parquet(f"{d}/events.parquet").selectExpr("event_id AS task_id", f"{TIER} AS tier"), domain(s, d, "models"), 3.0),
    with_sql(["models"], f"SELECT event_id AS task_id, coalesce((SELECT min(model_id) FROM models m WHERE m.tier = {TIER} AND price * 2 <= 3.0 AND has_code), (SELECT arg_min(model_id, (price, model_id)) FROM models)) AS model_id FROM events"),
)
register("pool_metrics", lambda s, d: kn.pool_metrics(domain(s, d, "agents")), with_sql(["agents"], "SELECT stage, count(*) AS agents, CAST(sum(load) AS BIGINT) AS load, count(*) FILTER (load = 0) AS idle FROM agents GROUP BY 1"))
register(
    "system_of_path",
    lambda s, d: domain(s, d, "paths").select("path_id", kn.normal_path(F.col("path")).alias("path"), kn.system_of(F.col("path")).alias("system")),
    with_sql(
        ["paths"],
        "SELECT path_id, p AS path, CASE " + " ".join("WHEN " + " OR ".join(f"starts_with(p, '{x}')" for x in ps) + f" THEN '{n}'" for n, ps in kn.SYSTEM_PREFIXES) + " ELSE 'unknown' END AS system FROM (SELECT path_id, lower(replace(path, chr(92), '/')) AS p FROM paths)",
    ),
)
register(
    "invariant_domain",
    lambda s, d: domain(s, d, "notes").select("note_id", kn.domain_of(F.col("content")).alias("domain"), kn.formal_expressions(F.col("content")).alias("formal")),
    with_sql(
        ["notes"],
        "SELECT note_id, CASE WHEN b.n > 0 THEN b.d ELSE 'general' END AS domain, array_to_string(list_concat(list_concat(list_concat(regexp_extract_all(content, '[<>]=?\\s*\\d+'), regexp_extract_all(content, '(?i)[a-z_]\\w*\\s*[<>!=]=\\s*[a-z_]\\w*')), regexp_extract_all(content, '(?i)\\b(?:true|false|null|undefined)\\b')), regexp_extract_all(content, '(?i)\\b(?:and|or|not|if|then|else)\\b')), ', ') AS formal FROM (SELECT *, list_max(["
        + ", ".join("{'n': " + " + ".join(f"CAST(contains(lower(content), '{w}') AS INT)" for w in ws) + f", 'o': {-i}, 'd': '{k}'}}" for i, (k, ws) in enumerate(kn.DOMAINS.items()))
        + "]) AS b FROM notes)",
    ),
)
register(
    "line_context",
    lambda s, d: domain(s, d, "code").select("file_id", kn.line_context(F.col("content"), F.lit(2), 1).alias("context")),
    with_sql(["code"], "SELECT file_id, array_to_string(string_split(content, chr(10))[1:3], chr(10)) AS context FROM code"),
)
register(
    "cost_estimates",
    lambda s, d: kn.estimates(domain(s, d, "answers")),
    with_sql(["answers"], "SELECT conv_id, turn, CAST(len(list_filter(regexp_split_to_array(coalesce(response, ''), '\\s+'), lambda w: w <> '')) AS BIGINT) AS scan_millionths, CAST(floor(length(coalesce(response, '')) / 4 / 1000 * 100) AS BIGINT) AS embed_millionths FROM answers"),
)
THREAT = cases("seq", [*[k.upper() for k in THREAT_CLASS], "odd"])
register(
    "threat_class_map",
    lambda s, d: domain(s, d, "costs").groupBy(scan.class_of_threat(F.expr(THREAT)).alias("bug_class")).agg(F.count("*").alias("n")),
    with_sql(["costs"], f"SELECT coalesce(c.v, 'logic_error') AS bug_class, count(*) AS n FROM costs LEFT JOIN {values_sql(list(THREAT_CLASS.items()), 'k, v')} ON lower({THREAT}) = c.k GROUP BY 1"),
)
register(
    "cwe_coverage",
    lambda s, d: domain(s, d, "findings").groupBy("cwe_id").count().join(F.broadcast(s.createDataFrame([(k, ",".join(v)) for k, v in CWE_D3FEND.items()], "cwe_id string, techniques string")), "cwe_id", "left").select("cwe_id", F.col("count").alias("n"), "techniques"),
    with_sql(["findings"], f"SELECT f.cwe_id, n, t AS techniques FROM (SELECT cwe_id, count(*) AS n FROM findings GROUP BY 1) f LEFT JOIN (SELECT k, string_agg(v, ',' ORDER BY o) AS t FROM {values_sql(listed(CWE_D3FEND), 'k, o, v')} GROUP BY k) x ON x.k = f.cwe_id"),
)
register(
    "truth_lookup",
    lambda s, d: domain(s, d, "ground_truth").filter(F.col("location").startswith("src/kernel/") & F.regexp_extract("location", r":(\d+)$", 1).try_cast("int").between(100, 300)).select("vuln_id", "location"),
    with_sql(["ground_truth"], r"SELECT vuln_id, location FROM ground_truth WHERE starts_with(location, 'src/kernel/') AND try_cast(regexp_extract(location, ':(\d+)$', 1) AS INT) BETWEEN 100 AND 300"),
)
register(
    "cheat_sheets",
    lambda s, d: kn.recommendations(domain(s, d, "findings"), domain(s, d, "sheets")),
    with_sql(
        ["findings", "sheets"],
        "SELECT finding_id, name, priority, CAST(row_number() OVER (PARTITION BY finding_id ORDER BY CASE priority WHEN 'critical' THEN 0 WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END, step, o, name) AS INT) AS place FROM h",
        a="SELECT finding_id, 'class' AS kind, bug_class AS value, 0 AS step FROM findings UNION ALL SELECT finding_id, 'cwe', cwe_id, 1 FROM findings",
        h="SELECT finding_id, name, priority, min(step) AS step, min(step * 1000 + ordinal) % 1000 AS o FROM a JOIN sheets USING (kind, value) GROUP BY 1, 2, 3",
    ),
)
TECHNIQUES = "CASE n_regionkey WHEN 0 THEN 'D3-MFA,D3-AH' WHEN 1 THEN 'D3-CP' WHEN 2 THEN 'D3-FE,D3-MENCR' ELSE 'D3-AH,D3-CP' END"
register(
    "technique_union",
    lambda s, d: kn.technique_union(s.read.parquet(f"{d}/nation.parquet").select("n_nationkey", F.split(F.expr(TECHNIQUES), ",").alias("techniques")), F.col("n_nationkey") % 3 < 2).select(F.concat_ws(",", "techniques").alias("techniques")),
    f"SELECT string_agg(t, ',' ORDER BY t) AS techniques FROM (SELECT DISTINCT unnest(string_split({TECHNIQUES}, ',')) AS t FROM nation WHERE n_nationkey % 3 < 2)",
)
