"""Findings, votes and their clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import REASONING_WORDS, RISK_CLASS, values_sql
from auditloom.operators import dedup, merging, scan, votes
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, table, with_sql

r6 = lambda c: F.round(c, 6)

register(
    "finding_id",
    lambda s, d: domain(s, d, "findings").select("finding_id", scan.finding_hash(F.col("bug_class"), F.col("location")).alias("hash")),
    with_sql(["findings"], "SELECT finding_id, substr(sha256(bug_class || ':' || location), 1, 16) AS hash FROM findings"),
)
register(
    "filter_score",
    lambda s, d: scan.above(domain(s, d, "findings")).select("finding_id", "score"),
    with_sql(["findings"], "SELECT finding_id, score FROM findings WHERE score >= 0.5"),
)
register(
    "collector_summary",
    lambda s, d: scan.collector_summary(domain(s, d, "findings")).withColumn("avg_score", r6("avg_score")),
    with_sql(["findings"], "SELECT count(*) AS total, round(coalesce(avg(score), 0), 6) AS avg_score, coalesce(max(score), 0) AS max_score, coalesce(min(score), 0) AS min_score FROM findings"),
)
register("class_counts", lambda s, d: scan.class_counts(domain(s, d, "findings")), with_sql(["findings"], "SELECT bug_class, count(*) AS n FROM findings GROUP BY bug_class"))
register(
    "best_per_location",
    lambda s, d: scan.best_per_location(domain(s, d, "findings")).select("location", "finding_id", "score", "first_seen"),
    with_sql(["findings"], "SELECT location, finding_id, score, first_seen FROM (SELECT *, min(finding_id) OVER (PARTITION BY location) AS first_seen, row_number() OVER (PARTITION BY location ORDER BY score DESC, finding_id) AS r FROM findings) WHERE r = 1"),
)
register("sort_score_topk", lambda s, d: scan.top(domain(s, d, "findings"), 25).select("finding_id", "score"), with_sql(["findings"], "SELECT finding_id, score FROM findings ORDER BY score DESC, finding_id LIMIT 25"))
register(
    "risk_class_map",
    lambda s, d: domain(s, d, "costs").groupBy(scan.class_of_risk(F.element_at(F.array(*map(F.lit, [*RISK_CLASS, "other"])), (F.col("seq") % 10 + 1).cast("int"))).alias("bug_class")).agg(F.count("*").alias("n")),
    with_sql(["costs"], "SELECT coalesce(c.v, 'logic_error') AS bug_class, count(*) AS n FROM costs LEFT JOIN " + values_sql([(i, v) for i, v in enumerate(RISK_CLASS.values())], "i, v") + " ON seq % 10 = c.i GROUP BY 1"),
)
register(
    "primary_language",
    lambda s, d: scan.primary_language(domain(s, d, "files")),
    with_sql(["files"], r"SELECT regexp_extract(path, '(\.[^./]+)$', 1) AS ext, count(*) AS n FROM files GROUP BY 1 ORDER BY n DESC, ext LIMIT 1"),
)
register(
    "dedup_by_key",
    lambda s, d: scan.first_per_key(domain(s, d, "findings")),
    with_sql(["findings"], "SELECT bug_class || ':' || substr(location, 1, 50) AS key, min(finding_id) AS finding_id, count(*) AS n FROM findings GROUP BY 1"),
)
register(
    "merge_by_location",
    lambda s, d: scan.location_clusters(domain(s, d, "findings")),
    with_sql(["findings"], "SELECT location, arg_max(finding_id, (score, -finding_id)) AS representative, count(*) AS n, min(finding_id) AS first_seen, row_number() OVER (ORDER BY min(finding_id)) - 1 AS cluster_id FROM findings GROUP BY location"),
)
register(
    "validated_top",
    lambda s, d: scan.top(scan.best_per_location(domain(s, d, "findings").join(votes.status(domain(s, d, "votes")).select("finding_id", "status", r6("confidence").alias("confidence")), "finding_id").filter("status <> 'false_positive'")), 20).select("finding_id", "location", "bug_class", "score", "status", "confidence"),
    with_sql(
        ["findings", "votes"],
        "SELECT finding_id, location, bug_class, score, status, round(confidence, 6) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY location ORDER BY score DESC, finding_id) AS r FROM findings JOIN st USING (finding_id) WHERE status <> 'false_positive') WHERE r = 1 ORDER BY score DESC, finding_id LIMIT 20",
        sh="SELECT finding_id, avg(CASE WHEN vote THEN 1.0 ELSE 0.0 END) AS share FROM votes GROUP BY finding_id",
        st="SELECT finding_id, CASE WHEN share >= 0.67 THEN share ELSE 1 - share END AS confidence, CASE WHEN share >= 0.67 THEN 'validated' WHEN 1 - share >= 0.67 THEN 'false_positive' ELSE 'unconfirmed' END AS status FROM sh",
    ),
)
register(
    "vote_aggregate",
    lambda s, d: votes.aggregate(domain(s, d, "votes")).withColumn("confidence", r6("confidence")),
    with_sql(["votes"], "SELECT finding_id, n, n_true, n_true > n - n_true AS result, round(greatest(n_true, n - n_true) / n, 6) AS confidence, greatest(n_true, n - n_true) / n >= 0.67 AS consensus FROM (SELECT finding_id, count(*) AS n, count(*) FILTER (vote) AS n_true FROM votes GROUP BY finding_id)"),
)
register(
    "weighted_vote",
    lambda s, d: votes.weighted(domain(s, d, "votes")).withColumn("confidence", r6("confidence")),
    with_sql(["votes"], "SELECT finding_id, w_true, w_false, w_true > w_false AS result, round(greatest(w_true, w_false) / nullif(w_true + w_false, 0), 6) AS confidence FROM (SELECT finding_id, CAST(coalesce(sum(weight) FILTER (vote), 0) AS BIGINT) AS w_true, CAST(coalesce(sum(weight) FILTER (NOT vote), 0) AS BIGINT) AS w_false FROM votes GROUP BY finding_id)"),
)
register("persona_breakdown", lambda s, d: votes.personas(domain(s, d, "votes")), with_sql(["votes"], "SELECT persona, count(*) AS total, count(*) FILTER (vote) AS n_true, count(*) FILTER (NOT vote) AS n_false FROM votes GROUP BY persona"))
register(
    "debate_status",
    lambda s, d: votes.status(domain(s, d, "votes")).select("finding_id", r6("share").alias("share"), "result", r6("confidence").alias("confidence"), "status"),
    with_sql(
        ["votes"],
        "SELECT finding_id, round(share, 6) AS share, share >= 0.67 AS result, round(CASE WHEN share >= 0.67 THEN share ELSE 1 - share END, 6) AS confidence, CASE WHEN share >= 0.67 THEN 'validated' WHEN 1 - share >= 0.67 THEN 'false_positive' ELSE 'unconfirmed' END AS status FROM sh",
        sh="SELECT finding_id, avg(CASE WHEN vote THEN 1.0 ELSE 0.0 END) AS share FROM votes GROUP BY finding_id",
    ),
)
register(
    "panel_decision",
    lambda s, d: votes.panel(domain(s, d, "votes")).withColumn("ratio", r6("ratio")),
    with_sql(["votes"], "SELECT finding_id, n_for, n_against, n_abstain, round(coalesce(n_for / nullif(n_for + n_against, 0), 0), 6) AS ratio, coalesce(n_for / nullif(n_for + n_against, 0) >= 0.67, false) AS validated FROM (SELECT finding_id, count(*) FILTER (stance = 'FOR') AS n_for, count(*) FILTER (stance = 'AGAINST') AS n_against, count(*) FILTER (stance = 'ABSTAIN') AS n_abstain FROM votes GROUP BY finding_id)"),
)
register(
    "two_round_panel",
    lambda s, d: votes.two_round(domain(s, d, "votes")),
    with_sql(["votes"], "SELECT *, coalesce(n_for / nullif(n_panel, 0), 0) >= 0.67 AND coalesce(judge_for, 0) = 1 AS validated FROM (SELECT finding_id, count(*) FILTER (line <> 1 AND stance = 'FOR') AS n_for, count(*) FILTER (line <> 1) AS n_panel, max(CASE WHEN line = 1 THEN CASE WHEN stance = 'FOR' THEN 1 ELSE 0 END END) AS judge_for FROM votes GROUP BY finding_id)"),
)
register(
    "vote_consistency",
    lambda s, d: votes.consistency(domain(s, d, "votes")).withColumn("consistency", r6("consistency")),
    with_sql(["votes"], "SELECT finding_id, round(greatest(count(*) FILTER (vote), count(*) FILTER (NOT vote)) / count(*), 6) AS consistency FROM votes GROUP BY finding_id"),
)
register(
    "debate_quality",
    lambda s, d: votes.quality(table(s, d, "conversations").selectExpr("conv_id", "text AS response"), "conv_id").withColumn("quality", r6("quality")),
    "SELECT conv_id, count(*) AS n, round(avg((least(1.0, length(coalesce(text, '')) / 500) + least(1.0, len(list_filter([" + ", ".join(f"'{w}'" for w in REASONING_WORDS) + "], lambda w: contains(lower(coalesce(text, '')), w))) / 3)) / 2), 6) AS quality FROM conversations GROUP BY conv_id",
)


def _parsed(s, d):
    a = domain(s, d, "answers")
    vote, confidence, reasoning = votes.parse_vote(F.col("response"))
    return a.select("conv_id", "turn", vote.alias("vote"), confidence.alias("confidence"), F.md5(reasoning).alias("reasoning"))


register(
    "parse_vote_text",
    _parsed,
    with_sql(
        ["answers"],
        "SELECT conv_id, turn, coalesce(list_filter(list_transform(list_filter(l, lambda x: starts_with(x, 'VOTE:')), lambda x: upper(trim(substr(x, 6)))), lambda v: v IN ('FOR', 'AGAINST', 'ABSTAIN'))[-1], 'ABSTAIN') AS vote, coalesce(greatest(0.0, least(1.0, list_filter(list_transform(list_filter(l, lambda x: starts_with(x, 'CONFIDENCE:')), lambda x: try_cast(trim(substr(x, 12)) AS DOUBLE)), lambda c: c IS NOT NULL)[-1])), 0.5) AS confidence, md5(coalesce(list_transform(list_filter(l, lambda x: starts_with(x, 'REASONING:')), lambda x: trim(substr(x, 11)))[-1], response)) AS reasoning FROM li",
        li="SELECT *, list_transform(string_split(response, chr(10)), lambda x: trim(x)) AS l FROM answers",
    ),
)

EPS = 0.6
PAIRS = "SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.e, b.e) AS sim FROM v a JOIN v b ON a.vec_id < b.vec_id"
VECTORS = "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings"
register(
    "cosine_pairs",
    lambda s, d: dedup.cosine_pairs(table(s, d, "embeddings"), 0.4).withColumn("sim", r6("sim")),
    f"WITH v AS ({VECTORS}), p AS ({PAIRS}) SELECT i, j, round(sim, 6) AS sim FROM p WHERE sim >= 0.4",
)
COMPONENTS = f"WITH RECURSIVE v AS ({VECTORS}), p AS ({PAIRS}), e AS MATERIALIZED (SELECT i AS a, j AS b FROM p WHERE sim >= 0.4 UNION SELECT j, i FROM p WHERE sim >= 0.4), r AS (SELECT a AS n, b AS m FROM e UNION SELECT r.n, e.b FROM r JOIN e ON r.m = e.a), lab AS (SELECT vec_id, (SELECT CASE WHEN min(m) IS NULL THEN NULL ELSE least(min(m), vec_id) END FROM r WHERE r.n = vec_id) AS root FROM embeddings) "
register("dbscan_components", lambda s, d: dedup.dbscan(table(s, d, "embeddings"), EPS), COMPONENTS + "SELECT vec_id, root FROM lab")
register("cluster_merge", lambda s, d: dedup.cluster_sizes(dedup.dbscan(table(s, d, "embeddings"), EPS)), COMPONENTS + "SELECT root, count(*) AS n FROM lab GROUP BY root")
register(
    "cluster_members",
    lambda s, d: dedup.merged(table(s, d, "embeddings").selectExpr("vec_id AS finding_id", "cast(vec_id * 37 % 101 as double) / 100 AS confidence"), dedup.dbscan(table(s, d, "embeddings"), EPS).withColumnRenamed("vec_id", "finding_id")),
    COMPONENTS + ", h AS (SELECT coalesce(CAST(root AS VARCHAR), 'noise-' || vec_id) AS cluster_id, vec_id AS finding_id, CAST(vec_id * 37 % 101 AS DOUBLE) / 100 AS score FROM lab) SELECT 'D-' || min(finding_id) OVER w AS merged_id, cluster_id, count(*) OVER w AS size, finding_id, score, finding_id = min(finding_id) OVER w AS representative FROM h WINDOW w AS (PARTITION BY cluster_id)",
)
LINKED = """WITH RECURSIVE v AS (SELECT CAST(vec_id // 200 AS INT) AS report, vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT report, count(*) - greatest(1, CAST(floor(count(*) * (1 - 0.85::DOUBLE)) AS BIGINT)) AS need FROM v GROUP BY report),
c AS (
    SELECT report, id, 1 AS n, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS m, [id] AS members, need FROM v JOIN s USING (report)
    UNION ALL
    SELECT l.report, l.id, l.n + coalesce(o.n, 0), CASE WHEN o.id IS NULL THEN l.m ELSE list_transform(list_zip(l.m, o.m), lambda z: (z[1] * l.n + z[2] * o.n) / (l.n + o.n)) END, list_concat(l.members, coalesce(o.members, [])), l.need - 1
    FROM c l JOIN (SELECT a.report, arg_min({'a': a.id, 'b': b.id}, {'d': round(1 - list_dot_product(a.m, b.m), 10), 'a': a.id, 'b': b.id}) AS p FROM c a JOIN c b ON a.report = b.report AND a.id < b.id WHERE a.need > 0 GROUP BY a.report) x ON x.report = l.report
    LEFT JOIN c o ON o.report = l.report AND l.id = x.p.a AND o.id = x.p.b WHERE l.need > 0 AND l.id <> x.p.b
) SELECT report, unnest(members) AS vec_id, CAST(cluster AS INT) AS cluster FROM (SELECT report, members, dense_rank() OVER (PARTITION BY report ORDER BY list_min(members)) - 1 AS cluster FROM c WHERE need = 0)"""
register("agglomerative", lambda s, d: dedup.agglomerative(table(s, d, "embeddings").selectExpr("vec_id", "embedding", "cast(vec_id div 200 as int) AS report"), "report"), LINKED)


def _jaccard(s, d):
    t = table(s, d, "conversations").selectExpr("conv_id", "turn", "text")
    a, b = t.filter("turn % 2 = 0"), t.filter("turn % 2 = 1").selectExpr("conv_id", "turn - 1 AS turn", "text AS other")
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", F.round(dedup.jaccard(F.col("text"), F.col("other")), 6).alias("jaccard"))


register(
    "jaccard_pairs",
    _jaccard,
    r"WITH w AS (SELECT conv_id, turn, list_distinct(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '')) AS l FROM conversations) SELECT a.conv_id, a.turn, round(CASE WHEN len(a.l) = 0 AND len(b.l) = 0 THEN 1.0 WHEN len(a.l) = 0 OR len(b.l) = 0 THEN 0.0 ELSE len(list_intersect(a.l, b.l)) / len(list_distinct(list_concat(a.l, b.l))) END, 6) AS jaccard FROM w a JOIN w b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.turn % 2 = 0",
)


def _components_sql(name: str, source: str, rules: list[str]) -> dict[str, str]:
    """Least reachable findings over the links of the rules."""
    stars = " UNION ".join(f"SELECT finding_id AS a, min(finding_id) OVER (PARTITION BY {r}) AS b FROM {source}" for r in rules)
    return {f"{name}_e": f"SELECT a, b FROM ({stars}) UNION SELECT b, a FROM ({stars})", f"{name}_r": f"SELECT a AS n, b AS m FROM {name}_e UNION SELECT r.n, e.b FROM {name}_r r JOIN {name}_e e ON r.m = e.a", name: f"SELECT n AS finding_id, min(m) AS cluster FROM {name}_r GROUP BY n"}


register(
    "merge_rules",
    lambda s, d: merging.merge_findings(domain(s, d, "mergeable")),
    with_sql(
        ["mergeable"],
        "SELECT finding_id, cluster, false AS settled FROM one WHERE cluster NOT IN (SELECT cluster FROM odd) UNION ALL SELECT finding_id, cluster, true FROM two",
        **_components_sql("one", "mergeable", ["bug_class, function", "cwe_id, pattern"]),
        odd="SELECT DISTINCT cluster FROM one JOIN mergeable USING (finding_id) GROUP BY cluster, location HAVING count(DISTINCT bug_class) > 1",
        again="SELECT m.* FROM mergeable m JOIN one USING (finding_id) WHERE cluster IN (SELECT cluster FROM odd)",
        **_components_sql("two", "again", ["bug_class, function", "bug_class, cwe_id, pattern"]),
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
