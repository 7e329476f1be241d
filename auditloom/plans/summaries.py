"""Short summaries and selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.code_patterns import FIX_PATTERNS
from auditloom.operators import boundaries, evaluate, feedback
from auditloom.operators import summaries as su
from auditloom.plans.code import LINES
from auditloom.plans.labelled import MISSED_BY_PATH
from auditloom.plans.registry import register
from auditloom.sources.bindings import cases, domain, table, with_sql

RESULT = "SELECT l_orderkey + l_linenumber % 2 AS target_id, CASE l_returnflag WHEN 'N' THEN 'verified' WHEN 'A' THEN 'violated' ELSE 'unknown' END AS status FROM lineitem"
FIRST = "l_orderkey % 500 AS target_id, l_linenumber * 1000000 + l_orderkey AS ordinal, " + cases("l_partkey", ["memory_safety", "thread_safety", "arithmetic"]) + " AS property"
register(
    "results_by_property",
    lambda s, d: su.results_by_property(table(s, d, "lineitem").selectExpr("l_orderkey + l_linenumber % 2 AS target_id", "CASE l_returnflag WHEN 'N' THEN 'verified' WHEN 'A' THEN 'violated' ELSE 'unknown' END AS status"), table(s, d, "lineitem").selectExpr(*FIRST.split(", ", 2)[:2], FIRST.split(", ", 2)[2])),
    f"WITH r AS ({RESULT}), t AS (SELECT target_id, arg_min(property, (ordinal, property)) AS property FROM (SELECT {FIRST} FROM lineitem) GROUP BY 1) SELECT property, status, count(*) AS n FROM r JOIN t USING (target_id) GROUP BY 1, 2",
)
TARGET = cases("o_orderkey", ["live-host", "c-cpp-source", "network-range-own-assets", "rust-source"])
register("network_facing", lambda s, d: table(s, d, "orders").selectExpr("o_orderkey AS target_id", f"{TARGET} AS kind").select("target_id", su.network_facing(F.col("kind")).alias("facing")), f"SELECT o_orderkey AS target_id, {TARGET} IN ('live-host', 'network-range-own-assets') AS facing FROM orders")
register(
    "cheat_sheet_stats",
    lambda s, d: su.sheet_stats(domain(s, d, "sheets")),
    with_sql(["sheets"], "SELECT count(DISTINCT name) AS sheets, count(DISTINCT value) FILTER (kind = 'class') AS classes, count(DISTINCT value) FILTER (kind = 'cwe') AS cwes, " + ", ".join(f"count(DISTINCT name) FILTER (priority = '{p}') AS {p}" for p in ("critical", "high", "medium", "low")) + " FROM sheets"),
)
register(
    "capped_list",
    lambda s, d: su.capped_list(domain(s, d, "findings"), "bug_class", "finding_id"),
    with_sql(["findings"], "SELECT bug_class, string_agg('- ' || finding_id, chr(10) ORDER BY r) FILTER (r <= 20) || CASE WHEN count(*) > 20 THEN chr(10) || '... and ' || (count(*) - 20) || ' more' ELSE '' END AS text FROM (SELECT *, row_number() OVER (PARTITION BY bug_class ORDER BY finding_id) AS r FROM findings) GROUP BY 1"),
)
register("patterns_above", lambda s, d: su.patterns_above(domain(s, d, "findings").selectExpr("finding_id AS id", "score")), with_sql(["findings"], "SELECT finding_id AS id, score FROM findings WHERE score >= 0.65 ORDER BY score DESC, id LIMIT 50"))
register("embedding_text", lambda s, d: domain(s, d, "findings").select("finding_id", su.embedding_text(F.col("bug_class"), F.col("location"), F.col("cwe_id")).alias("text")), with_sql(["findings"], "SELECT finding_id, bug_class || ' at ' || location || ': ' || cwe_id AS text FROM findings"))
register("feedback_ids", lambda s, d: table(s, d, "events").select("event_id", su.feedback_id(F.col("ts")).alias("id")), "SELECT event_id, 'feedback-' || strftime(ts, '%Y%m%d-%H%M%S') AS id FROM events")


def _missed(s, d):
    truth = domain(s, d, "ground_truth")
    return feedback.missed(truth, evaluate.labels_met(domain(s, d, "findings"), truth, same_path=True))


register(
    "context_metrics",
    lambda s, d: su.context_metrics(_missed(s, d)).select("agent_id", "category", "missed_count", F.round("share", 6).alias("share"), F.concat_ws(",", F.transform("examples", lambda x: x.cast("string"))).alias("examples")),
    with_sql(["findings", "ground_truth"], "SELECT agent_id, category, count(*) AS missed_count, round(count(*) / sum(count(*)) OVER (PARTITION BY agent_id), 6) AS share, string_agg(vuln_id, ',' ORDER BY vuln_id) FILTER (r <= 3) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY agent_id, category ORDER BY vuln_id) AS r FROM mi) GROUP BY 1, 2", **MISSED_BY_PATH),
)
PATCH = cases("vuln_id", ["ffi_boundary", "wasm_runtime", "race_condition", "solidity_native", "cross_language"])
SPOKEN = "CASE WHEN vuln_id % 3 = 0 THEN '' ELSE lang END"
register(
    "target_agents",
    lambda s, d: domain(s, d, "ground_truth").selectExpr("vuln_id", f"{SPOKEN} AS lang", f"{PATCH} AS kind").select("vuln_id", F.concat_ws(",", su.target_agents(F.col("lang"), F.col("kind"))).alias("agents")),
    with_sql(["ground_truth"], f"SELECT vuln_id, coalesce(nullif(concat_ws(',', CASE WHEN lang <> '' THEN 'scanner_' || lang END, CASE WHEN kind IN ('ffi_boundary', 'cross_language') THEN 'scanner_cross_language' END, CASE kind WHEN 'wasm_runtime' THEN 'scanner_wasm' WHEN 'solidity_native' THEN 'scanner_solidity' END), ''), 'scanner_default') AS agents FROM (SELECT vuln_id, {SPOKEN} AS lang, {PATCH} AS kind FROM ground_truth)"),
)
register(
    "top_invariants_split",
    lambda s, d: su.split_by_kind(boundaries.top_invariants(boundaries.invariants(domain(s, d, "notes")))),
    with_sql(["notes"], "SELECT kind, string_agg(note_id || ':' || line, ',' ORDER BY relevance_tenths DESC, note_id, line) AS notes FROM (SELECT * FROM iv WHERE kind <> '' ORDER BY relevance_tenths DESC, note_id, line, kind LIMIT 20) GROUP BY 1", **LINES),
)
PATCHED = "concat(" + cases("o_orderkey", ["Add null check", "add bounds and length check", "use safe function", "Add lock", "change the size", "remove unsafe block", "initialize variable", "tidy"]) + ", ' in ', " + cases("o_custkey", ["parser", "sanitizer; add sanitize step", "driver"]) + ")"
register(
    "fix_patterns",
    lambda s, d: table(s, d, "orders").selectExpr("o_orderkey AS patch_id", f"{PATCHED} AS text").select("patch_id", F.concat_ws(";", su.fix_patterns(F.col("text"))).alias("fixes")),
    "SELECT patch_id, concat_ws(';', " + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{x}' END" for p, x in FIX_PATTERNS) + f") AS fixes FROM (SELECT o_orderkey AS patch_id, {PATCHED} AS text FROM orders)",
)
register(
    "host_facets",
    lambda s, d: su.host_facets(domain(s, d, "hosts")),
    with_sql(["hosts"], " UNION ALL ".join(f"SELECT '{c}' AS facet, {c} AS value, count(*) AS n FROM hosts GROUP BY 2" for c in ("service", "country", "vuln")) + " UNION ALL SELECT 'all', '*', count(*) FROM hosts"),
)
EVENTS = "event_id, user_id AS agent_id, ts, CASE WHEN event_id % 4 <> 0 THEN event_type END AS evidence"
register(
    "investigation_timeline",
    lambda s, d: su.timeline(table(s, d, "events").selectExpr("event_id", "user_id AS agent_id", "ts", "CASE WHEN event_id % 4 <> 0 THEN event_type END AS evidence")),
    f"WITH k AS (SELECT *, row_number() OVER w AS place, coalesce(lag(ts) OVER w < ts - INTERVAL 60 MINUTE, true) AS fresh FROM (SELECT {EVENTS} FROM events) WHERE evidence IS NOT NULL WINDOW w AS (PARTITION BY agent_id ORDER BY ts, event_id)) SELECT event_id, agent_id, place, CAST(sum(fresh::INT) OVER (PARTITION BY agent_id ORDER BY ts, event_id) AS BIGINT) AS incident FROM k",
)
register("agents_for", lambda s, d: su.agents_for(domain(s, d, "agents"), "view", "race_condition", 8), with_sql(["agents"], "SELECT agent_id, load FROM agents WHERE stage = 'view' AND bug_class = 'race_condition' AND load < 8"))
KNOWN = "SELECT c_custkey AS address, cast(c_custkey % 101 as double) AS exposure FROM customer WHERE c_custkey % 3 > 0"
register(
    "average_exposure",
    lambda s, d: su.average_exposure(domain(s, d, "findings").selectExpr("bug_class AS group", "address"), table(s, d, "customer").filter("c_custkey % 3 > 0").selectExpr("c_custkey AS address", "cast(c_custkey % 101 as double) AS exposure")).select(F.col("group").alias("bug_class"), F.round("average", 6).alias("average")),
    with_sql(["findings"], f"SELECT bug_class, round(sum(coalesce(exposure, 0)) / count(*), 6) AS average FROM findings LEFT JOIN ({KNOWN}) USING (address) GROUP BY 1"),
)
