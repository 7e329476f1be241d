"""What files, commits and answers say."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import COMMIT_WORDS, FLOW_CLASS, PATCH_WORDS, SANITIZERS, SENSITIVE, TAINT_SINKS, TAINT_SOURCES, values_sql
from auditloom.functions.text import matches, window
from auditloom.functions import taint_rules
from auditloom.operators import extract, taint
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, table, with_sql

# Words of the synthetic prose, so that the text operators have something to find.
PROSE_SOURCES = {"user_input": ["tion", "ing"], "file": ["oux"]}
PROSE_SINKS = {"sql_query": ["erehe"], "code_eval": ["ouble", "leaux"]}
LINT = [("shout", "[A-Z]{3,}"), ("assign", r"\w+\s*=\s*\S"), ("todo", "todo|fixme"), ("trailing", r"[,;]$")]


def hits_sql(source: str, text: str, key: str, rules: str) -> str:
    """key, rule columns, start, end, match of every match of rules (a FROM item with a column pattern), by pieces between matches."""
    return (
        f"SELECT * EXCLUDE (b, i, before), CAST(before + sum(length(b)) OVER w + coalesce(sum(length(match)) OVER (PARTITION BY {key}, pattern ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS start "
        f"FROM (SELECT {key}, r.*, 0 AS before, unnest(regexp_extract_all({text}, r.pattern)) AS match, unnest(string_split_regex({text}, r.pattern)[1:len(regexp_extract_all({text}, r.pattern))]) AS b, unnest(range(1, len(regexp_extract_all({text}, r.pattern)) + 1)) AS i FROM {source} CROSS JOIN {rules}) WINDOW w AS (PARTITION BY {key}, pattern ORDER BY i)"
    )


sensitive = values_sql(SENSITIVE, "data_type, description, pattern", "r")
register(
    "secret_pii_scan",
    lambda s, d: extract.sensitive_data(domain(s, d, "files")).select("file_id", "data_type", "description", "start", "end", "match", "severity", "line"),
    with_sql(
        ["files"],
        "SELECT file_id, data_type, description, start, CAST(start + length(match) AS INT) AS \"end\", match, CASE data_type WHEN 'credentials' THEN 'critical' ELSE 'high' END AS severity, CAST(length(substr(content, 1, start)) - length(replace(substr(content, 1, start), chr(10), '')) + 1 AS INT) AS line FROM h JOIN files USING (file_id)",
        h=hits_sql("files", "content", "file_id", sensitive),
    ),
)


def _offsets(s, d):
    f = domain(s, d, "files")
    m = f.select("file_id", "content", F.explode(matches(F.col("content"), r"[0-9]{3,}")).alias("m"))
    return m.select("file_id", F.col("m.start").alias("start"), F.col("m.end").alias("end"), window(F.col("content"), F.col("m.start"), F.col("m.end"), 10).alias("context"))


register(
    "match_offsets",
    _offsets,
    with_sql(["files"], "SELECT file_id, start, CAST(start + length(match) AS INT) AS \"end\", substr(content, greatest(0, start - 10) + 1, start + length(match) + 10 - greatest(0, start - 10)) AS context FROM h JOIN files USING (file_id)", h=hits_sql("files", "content", "file_id", "(VALUES ('[0-9]{3,}')) r(pattern)")),
)


def flow_sql(sources: dict, sinks: dict, classes: dict) -> dict[str, str]:
    rows = lambda c: values_sql([(k, p) for k, ps in c.items() for p in ps], "kind, pattern", "r")
    return {
        "so": hits_sql("files", "content", "file_id", rows(sources)),
        "si": hits_sql("files", "content", "file_id", rows(sinks)),
        "fl": "SELECT so.file_id, so.kind AS source, si.kind AS sink, so.start AS source_at, si.start AS sink_at, coalesce(c.v, 'Unsanitized Data Flow') AS vulnerability FROM so JOIN si ON so.file_id = si.file_id AND si.start > so.start JOIN files f ON f.file_id = so.file_id LEFT JOIN "
        + values_sql([(a, b, v) for (a, b), v in classes.items()], "a, b, v")
        + " ON c.a = so.kind AND c.b = si.kind WHERE NOT regexp_matches(substr(f.content, so.start + 1, si.start - so.start), '(?i)" + "|".join(SANITIZERS) + "')",
    }


def _program_flows(s, d):
    return taint.flows(domain(s, d, "programs")).withColumn("confidence", F.round("confidence", 6))


def program_hits(rules: dict) -> str:
    """Hits of a language's own rules. A pattern may stand under several kinds."""
    rows = values_sql([(lang, k, p) for lang, kinds in rules.items() for k, ps in kinds.items() for p in ps], "rl, kind, pattern", "r")
    return "SELECT h.file_id, lang, kind, h.start, content, CAST(length(substr(content, 1, h.start)) - length(replace(substr(content, 1, h.start), chr(10), '')) + 1 AS INT) AS line FROM (" + hits_sql("programs", "content", "file_id", rows).replace("PARTITION BY file_id, pattern", "PARTITION BY file_id, rl, kind, pattern") + ") h JOIN programs p ON p.file_id = h.file_id AND lang = rl"


PROGRAMS = {
    "so": program_hits(taint_rules.SOURCES),
    "si": program_hits(taint_rules.SINKS),
    "pf": "SELECT so.file_id, so.lang, so.kind AS source, si.kind AS sink, so.start AS source_at, si.start AS sink_at, so.line AS source_line, si.line AS sink_line, CASE "
    + " ".join(f"WHEN so.lang = '{lang}' AND regexp_matches(so.content, '{'|'.join(ps)}') THEN '{taint_rules.EXTENSION[lang]}->native'" for lang, ps in taint_rules.NATIVE.items())
    + " ELSE 'none' END AS boundary, coalesce(c.v, 'Unsanitized Data Flow') AS vulnerability, round(least(1.0, greatest(0.3, 1 - (si.start - so.start) / 1000)), 6) AS confidence "
    + "FROM so JOIN si ON so.file_id = si.file_id AND si.start > so.start LEFT JOIN "
    + values_sql([(a, b, v) for (a, b), v in taint_rules.FLOW_CLASSES.items()], "a, b, v")
    + " ON c.a = so.kind AND c.b = si.kind WHERE NOT regexp_matches(substr(so.content, so.start + 1, si.start - so.start), '(?i)" + "|".join(SANITIZERS) + "')",
}
register("taint_flows", _program_flows, with_sql(["programs"], "SELECT * FROM pf", **PROGRAMS))
register(
    "taint_summary",
    lambda s, d: taint.flow_summary(taint.flows(domain(s, d, "programs"))),
    with_sql(["programs"], "SELECT coalesce(boundary, '*') AS boundary, coalesce(vulnerability, '*') AS vulnerability, count(*) AS n, count(*) FILTER (confidence >= 0.7) AS high, count(*) FILTER (boundary <> 'none') AS crossing FROM pf GROUP BY GROUPING SETS ((boundary), (vulnerability), ())", **PROGRAMS),
)


def _pages_as_files(s, d):
    return table(s, d, "pages").selectExpr("page_id AS file_id", "concat('import os\nopen (\"', url, '\")\n', CASE page_id % 3 WHEN 0 THEN 'x.strip ()' ELSE '' END, '\nos.system(cmd)\neval (', html, ')\ncursor.execute (q)') AS content")


PAGES = {"files": "SELECT page_id AS file_id, concat('import os' || chr(10) || 'open (\"', url, '\")' || chr(10), CASE page_id % 3 WHEN 0 THEN 'x.strip ()' ELSE '' END, chr(10) || 'os.system(cmd)' || chr(10) || 'eval (', html, ')' || chr(10) || 'cursor.execute (q)') AS content FROM pages"}
register("taint_flows_pages", lambda s, d: extract.taint_flows(_pages_as_files(s, d)), "WITH " + ", ".join(f"{k} AS ({v})" for k, v in (PAGES | flow_sql(TAINT_SOURCES, TAINT_SINKS, FLOW_CLASS)).items()) + " SELECT * FROM fl")
register(
    "flow_totals",
    lambda s, d: extract.flow_totals(extract.taint_flows(_pages_as_files(s, d))),
    "WITH " + ", ".join(f"{k} AS ({v})" for k, v in (PAGES | flow_sql(TAINT_SOURCES, TAINT_SINKS, FLOW_CLASS)).items()) + " SELECT coalesce(source, '*') AS source, coalesce(vulnerability, '*') AS vulnerability, count(*) AS n FROM fl GROUP BY GROUPING SETS ((source), (vulnerability), ())",
)
words = "[" + ", ".join(f"'{w}'" for w in COMMIT_WORDS) + "]"
register(
    "security_commits",
    lambda s, d: extract.security_commits(domain(s, d, "commits")).select("commit_id", F.concat_ws(",", "words").alias("words")),
    with_sql(["commits"], f"SELECT commit_id, array_to_string(w, ',') AS words FROM (SELECT commit_id, list_filter({words}, lambda w: contains(lower(message), w)) AS w FROM commits) WHERE len(w) > 0"),
)
register(
    "cve_ids",
    lambda s, d: extract.cve_ids(domain(s, d, "commits")),
    with_sql(["commits"], r"SELECT commit_id, CAST(i - 1 AS INT) AS ordinal, cve_id FROM (SELECT commit_id, unnest(x) AS cve_id, unnest(range(1, len(x) + 1)) AS i FROM (SELECT commit_id, regexp_extract_all(message, '(?i)CVE-\d{4}-\d{4,}') AS x FROM commits))"),
)
register(
    "patch_types",
    lambda s, d: extract.patch_types(domain(s, d, "commits")),
    with_sql(["commits"], " UNION ALL ".join(f"SELECT '{k}' AS bug_type, count(*) AS n FROM commits WHERE " + " OR ".join(f"contains(lower(message), '{w}')" for w in ws) + " HAVING count(*) > 0" for k, ws in PATCH_WORDS.items())),
)
register(
    "keyword_extract",
    lambda s, d: domain(s, d, "commits").select("commit_id", F.concat_ws(" ", extract.keywords(F.col("message"))).alias("keywords")),
    with_sql(["commits"], r"""SELECT commit_id, coalesce((SELECT string_agg(w, ' ' ORDER BY i) FROM (SELECT w, min(i) AS i FROM (SELECT trim(unnest(l), '.,;:"''') AS w, unnest(range(len(l))) AS i) WHERE length(w) >= 4 GROUP BY w)), '') AS keywords FROM (SELECT commit_id, regexp_split_to_array(lower(message), '\s+') AS l FROM commits)"""),
)


def _diff(s, d):
    removed, added = extract.diff_lines(F.concat(F.lit("--- a\n+++ b\n-"), F.replace("text", F.lit(". "), F.lit("\n+"))))
    return table(s, d, "conversations").select("conv_id", "turn", F.size(removed).alias("removed"), F.size(added).alias("added"), F.md5(F.concat_ws("|", added)).alias("md5"))


register(
    "diff_split",
    _diff,
    "WITH l AS (SELECT conv_id, turn, string_split('--- a' || chr(10) || '+++ b' || chr(10) || '-' || replace(text, '. ', chr(10) || '+'), chr(10)) AS x FROM conversations) SELECT conv_id, turn, CAST(len(list_filter(x, lambda y: starts_with(y, '-') AND NOT starts_with(y, '---'))) AS INT) AS removed, CAST(len(list_filter(x, lambda y: starts_with(y, '+') AND NOT starts_with(y, '+++'))) AS INT) AS added, md5(array_to_string(list_filter(x, lambda y: starts_with(y, '+') AND NOT starts_with(y, '+++')), '|')) AS md5 FROM l",
)


register(
    "line_lint",
    lambda s, d: extract.line_lint(domain(s, d, "files"), LINT),
    with_sql(["files"], "SELECT file_id, CAST(i AS INT) AS line, rule FROM (SELECT file_id, unnest(x) AS t, unnest(range(1, len(x) + 1)) AS i FROM (SELECT file_id, string_split(content, chr(10)) AS x FROM files)) CROSS JOIN " + values_sql([(r, "(?i)" + p) for r, p in LINT], "rule, pattern", "r") + " WHERE regexp_matches(t, pattern)"),
)
JSON_TEXT = "CASE event_id % 3 WHEN 0 THEN concat('answer: {\"vulnerabilities\":[{\"location\":\"a.c:', cast(event_id as string), '\",\"bug_class\":\"xss\",\"confidence\":0.5},{\"location\":\"b.c:1\"}]} end') WHEN 1 THEN concat('no json ', event_type) ELSE '{broken' END"


def _json(s, d):
    a = table(s, d, "events").selectExpr("event_id", f"{JSON_TEXT} AS response")
    return extract.json_answers(a).select("event_id", "location", "bug_class", "confidence", "evidence")


register(
    "json_extract",
    _json,
    f"WITH a AS (SELECT event_id, {JSON_TEXT} AS response FROM events) SELECT event_id, v.location AS location, coalesce(v.bug_class, 'unknown') AS bug_class, coalesce(v.confidence, 0.3) AS confidence, CAST(NULL AS VARCHAR) AS evidence FROM (SELECT event_id, unnest(from_json(regexp_extract(response, '(?s)\\{{.*\\}}'), '{{\"vulnerabilities\":[{{\"location\":\"VARCHAR\",\"bug_class\":\"VARCHAR\",\"confidence\":\"DOUBLE\"}}]}}').vulnerabilities) AS v FROM a WHERE event_id % 3 = 0) UNION ALL SELECT event_id, NULL, 'unknown', 0.3, substr(response, 1, 500) FROM a WHERE event_id % 3 <> 0",
)
PYTHON = "concat('import os, json\\nclass C', event_type, ':\\n  def f(self):\\n    return os.path.join(str(', cast(event_id as string), '))\\n')"
# The symbols of the texts above, written out by hand.
SYMBOLS = "('import', 'os', 1), ('import', 'json', 1), ('class', 'C' || event_type, 2), ('function', 'f', 3), ('call', 'os.path.join', 4), ('call', 'str', 4)"
register(
    "python_symbols",
    lambda s, d: extract.python_symbols(table(s, d, "events").selectExpr("event_id AS file_id", f"{PYTHON} AS content")),
    f"SELECT event_id AS file_id, kind, name, line FROM events, LATERAL (VALUES {SYMBOLS}) v(kind, name, line)",
)
JS = "concat('import { a } from \"m', cast(page_id % 7 as string), '\"; function f', cast(page_id as string), '() {} const g = async (x) => 1; class K', cast(page_id % 3 as string), ' {} const h = (y)')"
register(
    "js_symbols",
    lambda s, d: extract.js_symbols(table(s, d, "pages").selectExpr("page_id AS file_id", f"{JS} AS content")),
    f"WITH f AS (SELECT page_id AS file_id, {JS} AS content FROM pages) "
    + " UNION ALL ".join(f"SELECT file_id, '{k}' AS kind, CAST(unnest(range(len(regexp_extract_all(content, '{q}', 1)))) AS INT) AS ordinal, unnest(regexp_extract_all(content, '{q}', 1)) AS name FROM f" for k, q in ((k, p.replace("'", "''")) for k, p in extract.JS_SYMBOLS.items())),
)
DIFF = "concat('--- a/x', CASE page_id % 4 WHEN 0 THEN '.cpp' WHEN 1 THEN '.py' WHEN 2 THEN '.rs' ELSE '.sol' END, ' b/y.go b/z.py')"
register(
    "language_vote",
    lambda s, d: extract.language_vote(table(s, d, "pages").selectExpr("page_id AS diff_id", f"{DIFF} AS content")),
    f"WITH e AS (SELECT page_id AS diff_id, unnest(regexp_extract_all({DIFF}, '\\.(" + "|".join(extract.EXTENSIONS) + ")', 1)) AS ext FROM pages), v AS (SELECT diff_id, l AS language, count(*) AS n FROM e JOIN "
    + values_sql(list(extract.EXTENSIONS.items()), "x, l")
    + " ON ext = x GROUP BY 1, 2) SELECT diff_id, arg_min(language, (-n, language)) AS language, max(n) AS n FROM v GROUP BY 1",
)
