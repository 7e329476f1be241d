"""Evaluation against labels, and feedback on what was missed."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.operators import evaluate, feedback
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, table, with_sql

r6 = lambda c: F.round(c, 6)

PLACED = {
    "pf": "SELECT *, regexp_extract(location, '^(.*):(.*)$', 1) AS file, try_cast(regexp_extract(location, '^(.*):(.*)$', 2) AS INT) AS line FROM findings",
    "pt": "SELECT *, regexp_extract(location, '^(.*):(.*)$', 1) AS file, try_cast(regexp_extract(location, '^(.*):(.*)$', 2) AS INT) AS line FROM ground_truth",
}
NAME = "ends_with(pf.file, regexp_extract(pt.file, '[^/]*$'))"
register(
    "band_join",
    lambda s, d: evaluate.band_join(domain(s, d, "findings"), domain(s, d, "ground_truth"), same_path=True),
    with_sql(["findings", "ground_truth"], "SELECT finding_id, vuln_id, pf.line - pt.line AS \"offset\" FROM pf JOIN pt ON pf.file = pt.file AND abs(pf.line - pt.line) <= 5", **PLACED),
)
register(
    "band_join_by_name",
    lambda s, d: evaluate.band_join(domain(s, d, "findings"), domain(s, d, "ground_truth")),
    with_sql(["findings", "ground_truth"], f"SELECT finding_id, vuln_id, pf.line - pt.line AS \"offset\" FROM pf JOIN pt ON {NAME} AND abs(pf.line - pt.line) <= 5", **PLACED),
)
PAIRS = {
    "sp": "SELECT finding_id, vuln_id, CASE WHEN pf.location = pt.location THEN 5 WHEN pf.file = pt.file AND abs(pf.line - pt.line) <= 5 THEN 3 ELSE 0 END AS place, CASE WHEN upper(pf.cwe_id) = upper(pt.cwe_id) THEN 3 ELSE 0 END AS c, CASE WHEN contains(replace(bug_class, '_', ''), replace(category, '_', '')) OR contains(replace(category, '_', ''), replace(bug_class, '_', '')) THEN 2 ELSE 0 END AS b FROM pf JOIN pt ON pf.location = pt.location OR (pf.file = pt.file AND abs(pf.line - pt.line) <= 5) OR pf.cwe_id = pt.cwe_id",
}


def _ids_long(df):
    """ids as BIGINT, as the SQL casts it: what passes 64 bits is an error here and there."""
    return df.withColumn("ids", F.col("ids").cast("long"))


register(
    "match_pairs",
    lambda s, d: _ids_long(evaluate.match_summary(domain(s, d, "findings"), domain(s, d, "ground_truth"), same_path=True)),
    with_sql(["findings", "ground_truth"], "SELECT CASE WHEN place > 0 AND place + c + b >= 8 THEN 'exact' WHEN place > 0 THEN 'fuzzy' ELSE 'cwe_only' END AS match_type, place + c + b AS points, count(*) AS n, CAST(sum(finding_id) AS BIGINT) AS ids FROM sp WHERE place + c + b >= 5 GROUP BY 1, 2", **PLACED, **PAIRS),
)
SCORED = {
    "near": f"SELECT finding_id, vuln_id FROM pf JOIN pt ON {NAME} AND pf.line BETWEEN pt.line - 5 AND pt.line + 5 UNION SELECT finding_id, vuln_id FROM pf JOIN pt ON pf.location = pt.location UNION SELECT finding_id, vuln_id FROM pf JOIN pt ON upper(pf.cwe_id) = upper(pt.cwe_id)",
    "sp": f"SELECT finding_id, vuln_id, CASE WHEN pf.location = pt.location THEN 5 WHEN {NAME} AND abs(pf.line - pt.line) <= 5 THEN 3 ELSE 0 END AS place, CASE WHEN upper(pf.cwe_id) = upper(pt.cwe_id) THEN 3 ELSE 0 END AS c, CASE WHEN contains(replace(bug_class, '_', ''), replace(category, '_', '')) OR contains(replace(category, '_', ''), replace(bug_class, '_', '')) THEN 2 ELSE 0 END AS b FROM near JOIN pf USING (finding_id) JOIN pt USING (vuln_id)",
}
register(
    "match_pairs_by_name",
    lambda s, d: _ids_long(evaluate.match_summary(domain(s, d, "findings"), domain(s, d, "ground_truth"))),
    with_sql(["findings", "ground_truth"], "SELECT CASE WHEN place > 0 AND place + c + b >= 8 THEN 'exact' WHEN place > 0 THEN 'fuzzy' ELSE 'cwe_only' END AS match_type, place + c + b AS points, count(*) AS n, CAST(sum(finding_id) AS BIGINT) AS ids FROM sp WHERE place + c + b >= 5 GROUP BY 1, 2", **PLACED, **SCORED),
)
register("greedy_match", lambda s, d: evaluate.greedy_assignment(domain(s, d, "findings"), domain(s, d, "ground_truth")))
GUESS = "length(text) % 3 = 0"


def _labelled(s, d):
    return table(s, d, "labels").join(table(s, d, "documents").selectExpr("doc_id", "source", "n_chars", f"{GUESS} AS guess"), "doc_id").withColumn("truth", F.col("quality") == 1)


LABELLED = f"SELECT l.*, source, n_chars, {GUESS} AS guess, quality = 1 AS truth FROM labels l JOIN documents USING (doc_id)"
METRICS = "count(*) FILTER (truth AND guess) AS tp, count(*) FILTER (NOT truth AND guess) AS fp, count(*) FILTER (truth AND NOT guess) AS fn"
RATES = "round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce(fp / nullif(tp + fp, 0), 0), 6) AS fdr"


def _rounded(df):
    return df.withColumns({c: r6(c) for c in ("precision", "recall", "f1", "fdr")})


register("confusion_metrics", lambda s, d: _rounded(evaluate.confusion(_labelled(s, d))), f"WITH l AS ({LABELLED}) SELECT tp, fp, fn, {RATES} FROM (SELECT {METRICS} FROM l)")
register(
    "recall_at_k",
    lambda s, d: evaluate.recall_at(_labelled(s, d).selectExpr("source", "n_chars AS score", "doc_id AS id", "truth AS relevant"), 5, "source").withColumn("recall", r6("recall")),
    f"WITH l AS ({LABELLED}) SELECT source, count(*) FILTER (truth) AS relevant, count(*) FILTER (truth AND r <= 5) AS hits, round(coalesce(count(*) FILTER (truth AND r <= 5) / nullif(count(*) FILTER (truth), 0), 0), 6) AS recall FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM l) GROUP BY 1",
)


def _ab(s, d):
    labelled = _labelled(s, d)
    parts = [_rounded(evaluate.confusion(labelled.withColumn("guess", g))).withColumn("run", F.lit(name)) for name, g in (("a", F.col("guess")), ("b", F.col("n_chars") > 2000))]
    both = parts[0].unionByName(parts[1])
    return both.join(F.broadcast(both.agg(F.max("f1").alias("top"))), F.lit(True)).withColumn("best", F.col("f1") == F.col("top")).drop("top")  # one row


register(
    "ab_compare",
    _ab,
    f"WITH l AS ({LABELLED}), x AS (SELECT 'a' AS run, {METRICS} FROM l UNION ALL SELECT 'b', {METRICS.replace('guess', '(n_chars > 2000)')} FROM l), y AS (SELECT run, tp, fp, fn, {RATES} FROM x) SELECT *, f1 = (SELECT max(f1) FROM y) AS best FROM y",
)
register(
    "mean_interval",
    lambda s, d: evaluate.mean_interval(table(s, d, "events").selectExpr("event_type", "value"), "event_type").select("event_type", "n", *[F.round(c, 4).alias(c) for c in ("mean", "low", "high")]),
    "SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(*)), 4) AS low, round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(*)), 4) AS high FROM events GROUP BY 1",
)
CHANCE = "power(cast((event_id * 7919 % 10007) + 1 as double) / 10007, 3)"
TESTS = f"SELECT event_id AS id, {CHANCE} AS p FROM events"
register(
    "false_discovery",
    lambda s, d: evaluate.false_discovery(table(s, d, "events").selectExpr("event_id AS id", f"{CHANCE} AS p")).withColumn("adjusted", r6("adjusted")),
    f"WITH t AS ({TESTS}), r AS (SELECT *, row_number() OVER (ORDER BY p, id) AS rank, count(*) OVER () AS n FROM t), a AS (SELECT *, least(1.0, min(p * n / rank) OVER (ORDER BY p DESC, id DESC)) AS adj FROM r) SELECT id, p, rank, round(adj, 6) AS adjusted, adj <= 0.05 AS rejected FROM a",
)
both = ["findings", "ground_truth"]


def _missed_sql(rule: str) -> tuple[dict[str, str], dict[str, str]]:
    found = {**PLACED, "fo": f"SELECT DISTINCT vuln_id FROM pf JOIN pt ON {rule} AND abs(pf.line - pt.line) <= 5"}
    return found, {**found, "mi": "SELECT * FROM ground_truth WHERE vuln_id NOT IN (SELECT vuln_id FROM fo)"}


BY_PATH = "pf.file = pt.file"
MISSED_BY_PATH = _missed_sql(BY_PATH)[1]


def _readers(suffix: str, same_path: bool, rule: str) -> None:
    """Queries over what was found and missed, places being matched by equal paths or by base names."""
    FOUND, MISSED = _missed_sql(rule)
    found = lambda s, d: evaluate.labels_met(domain(s, d, "findings"), domain(s, d, "ground_truth"), same_path=same_path)
    missed = lambda s, d: feedback.missed(domain(s, d, "ground_truth"), found(s, d))
    register(
        "category_breakdown" + suffix,
        lambda s, d: evaluate.category_breakdown(domain(s, d, "ground_truth"), found(s, d)),
        with_sql(["findings", "ground_truth"], "SELECT category, count(*) AS total, count(fo.vuln_id) AS tp, count(*) - count(fo.vuln_id) AS fn FROM ground_truth LEFT JOIN fo USING (vuln_id) GROUP BY 1", **FOUND),
    )

    register("missed_anti" + suffix, lambda s, d: missed(s, d).select("vuln_id", "category"), with_sql(both, "SELECT vuln_id, category FROM mi", **MISSED))
    register("missed_grouping_sets" + suffix, lambda s, d: feedback.frequencies(missed(s, d)), with_sql(both, "SELECT coalesce(category, '*') AS category, coalesce(lang, '*') AS lang, coalesce(stage, '*') AS stage, count(*) AS n FROM mi GROUP BY GROUPING SETS ((category), (lang), (stage), ())", **MISSED))
    register("trending_topn" + suffix, lambda s, d: feedback.trending(missed(s, d)), with_sql(both, "SELECT category, count(*) AS n, min(vuln_id) AS first_seen FROM mi GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 5", **MISSED))
    register("last_k_per_agent" + suffix, lambda s, d: feedback.last_of_each(missed(s, d)), with_sql(both, "SELECT agent_id, vuln_id, CAST(r AS INT) AS r FROM (SELECT agent_id, vuln_id, row_number() OVER (PARTITION BY agent_id ORDER BY vuln_id DESC) AS r FROM mi) WHERE r <= 5", **MISSED))
    register(
        "patterns_having" + suffix,
        lambda s, d: feedback.patterns(missed(s, d)).withColumn("examples", F.concat_ws(",", F.transform("examples", lambda x: x.cast("string")))),
        with_sql(both, "SELECT category, count(*) AS n, string_agg(vuln_id, ',' ORDER BY vuln_id) FILTER (r <= 3) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY vuln_id) AS r FROM mi) GROUP BY 1 HAVING count(*) >= 3", **MISSED),
    )
    register(
        "agent_profile" + suffix,
        lambda s, d: feedback.agent_profile(missed(s, d)).select("agent_id", "total", F.concat_ws(",", "classes").alias("classes"), F.concat_ws(",", "languages").alias("languages")),
        with_sql(both, "SELECT agent_id, count(*) AS total, array_to_string(list_sort(list(DISTINCT category)), ',') AS classes, array_to_string(list_sort(list(DISTINCT lang)), ',') AS languages FROM mi GROUP BY 1", **MISSED),
    )
    register("recommendations" + suffix, lambda s, d: feedback.recommendations(missed(s, d)), with_sql(both, "SELECT 'Improve ' || lang || ' analysis: ' || count(*) || ' missed' AS text FROM mi GROUP BY lang HAVING count(*) >= 3", **MISSED))


_readers("", True, BY_PATH)
_readers("_by_name", False, NAME)
register(
    "category_metrics_by_name",
    lambda s, d: evaluate.category_metrics(*(tables := (domain(s, d, "findings"), domain(s, d, "ground_truth"))), evaluate.labels_met(*tables), evaluate.findings_met(*tables)).withColumns({c: r6(c) for c in ("precision", "recall")}),
    with_sql(
        both,
        "SELECT category, total, tp, total - tp AS fn, fp, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(tp / total, 6) AS recall FROM (SELECT category, count(*) AS total, count(*) FILTER (vuln_id IN (SELECT vuln_id FROM ma)) AS tp FROM ground_truth GROUP BY 1) JOIN (SELECT category, count(finding_id) AS fp FROM (SELECT DISTINCT category, cwe_id FROM ground_truth) g LEFT JOIN (SELECT * FROM findings WHERE finding_id NOT IN (SELECT finding_id FROM ma)) f ON f.cwe_id = g.cwe_id GROUP BY 1) USING (category)",
        **PLACED,
        ma=f"SELECT finding_id, vuln_id FROM pf JOIN pt ON {NAME} AND abs(pf.line - pt.line) <= 5",
    ),
)
POISSON = "CASE WHEN u < 0.367879 THEN 0 WHEN u < 0.735759 THEN 1 WHEN u < 0.919699 THEN 2 WHEN u < 0.981012 THEN 3 WHEN u < 0.996340 THEN 4 ELSE 5 END"
WEIGHED = f"SELECT draw, d, {POISSON} AS w FROM (SELECT draw, d, (y * 69621 % 2147483647 + y * y % 2147483647) % 2147483647 / 2147483647 AS u FROM (SELECT i AS draw, d, (id % 2147483647 * 16807 + (i * 48271 + 12345) % 2147483647) % 2147483647 AS y FROM l, range(1, {{n}}) t(i)))"
DRAWN = "SELECT CAST(draw AS INT) AS draw, coalesce(sum(w * d) / nullif(sum(w), 0), 0) AS difference FROM w GROUP BY 1"
register(
    "paired_bootstrap",
    lambda s, d: evaluate.bootstrap(_labelled(s, d).selectExpr("doc_id AS id", "cast(truth = guess AS double) AS a", "cast(truth = (n_chars > 2000) AS double) AS b"), 200),
    f"WITH l0 AS ({LABELLED}), l AS (SELECT doc_id AS id, CAST(truth = guess AS INT) - CAST(truth = (n_chars > 2000) AS INT) AS d FROM l0), w AS ({WEIGHED.format(n=201)}) " + DRAWN,
)
RUNS = "SELECT event_id AS id, value AS a, value * (0.9 + cast(event_id % 7 AS double) / 40) AS b FROM events"
register(
    "bootstrap_interval",
    lambda s, d: evaluate.bootstrap_interval(table(s, d, "events").selectExpr("event_id AS id", "value AS a", "value * (0.9 + cast(event_id % 7 AS double) / 40) AS b")).select("n", *(r6(c).alias(c) for c in ("difference", "low", "high", "effect"))),
    f"WITH r AS ({RUNS}), l AS (SELECT id, a - b AS d FROM r), w AS ({WEIGHED.format(n=10_001)}), x AS ({DRAWN}) "
    "SELECT count(*) AS n, round(avg(a) - avg(b), 6) AS difference, round((SELECT quantile_cont(difference, 0.025) FROM x), 6) AS low, round((SELECT quantile_cont(difference, 0.975) FROM x), 6) AS high, round((avg(a) - avg(b)) / sqrt((var_samp(a) + var_samp(b)) / 2), 6) AS effect FROM r",
)
