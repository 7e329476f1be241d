"""Boundaries, invariants, tool output, uploads, certificates, routing and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions import code_patterns as cp
from auditloom.functions.catalogs import frame, values_sql
from auditloom.operators import boundaries, extract, scan
from auditloom.operators import knowledge as kn
from auditloom.plans.registry import register
from auditloom.plans.texts import hits_sql
from auditloom.sources.bindings import cases, domain, with_sql
from auditloom.sources.files import report

_best = "list_max([" + ", ".join("{'n': " + " + ".join(f"CAST(contains(lower(text), '{w}') AS INT)" for w in ws) + f", 'o': {-i}, 'd': '{k}'}}" for i, (k, ws) in enumerate(kn.DOMAINS.items())) + "])"
DOMAIN_SQL = f"CASE WHEN ({_best}).n > 0 THEN ({_best}).d ELSE 'general' END"
FORMAL_SQL = "array_to_string(list_concat(list_concat(list_concat(regexp_extract_all(text, '[<>]=?\\s*\\d+'), regexp_extract_all(text, '(?i)[a-z_]\\w*\\s*[<>!=]=\\s*[a-z_]\\w*')), regexp_extract_all(text, '(?i)\\b(?:true|false|null|undefined)\\b')), regexp_extract_all(text, '(?i)\\b(?:and|or|not|if|then|else)\\b')), ', ')"
joined = lambda c: F.concat_ws(",", c).alias(c)


def risks_sql(risks: dict, text: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches({text}, '(?i)" + "|".join(f"(?:{p})" for p in ps).replace("'", "''") + f"') THEN '{k}' END" for k, ps in risks.items()) + "], lambda x: x IS NOT NULL), ',')"


def boundary_sql(patterns: dict, risks: dict, around: int) -> dict[str, str]:
    rules = values_sql([(lang, k, p) for lang, ps in patterns.items() for k, p in ps.items()], "rl, boundary, pattern", "r")
    return {
        "h": hits_sql("code", "content", "file_id", rules),
        "bo": f"SELECT h.file_id, lang, boundary, start, CAST(length(substr(content, 1, start)) - length(replace(substr(content, 1, start), chr(10), '')) + 1 AS INT) AS line, {risks_sql(risks, f'substr(content, greatest(0, start - {around}) + 1, start + length(match) + {around} - greatest(0, start - {around}))')} AS risks FROM h JOIN code USING (file_id) WHERE rl = lang",
    }


for name, patterns, risks, around in (("ffi", cp.FFI, cp.FFI_RISKS, 500), ("contract", cp.CONTRACT, cp.CONTRACT_RISKS, 300), ("wasm", cp.WASM, cp.WASM_RISKS, 200)):
    found = lambda s, d, p=patterns, r=risks, a=around: boundaries.boundaries(domain(s, d, "code"), p, r, a)
    sql = boundary_sql(patterns, risks, around)
    register(f"boundary_scan_{name}", lambda s, d, f=found: f(s, d).withColumn("risks", joined("risks")), with_sql(["code"], "SELECT * FROM bo", **sql))
    register(f"boundary_totals_{name}", lambda s, d, f=found: boundaries.boundary_totals(f(s, d)), with_sql(["code"], "SELECT coalesce(lang, '*') AS lang, coalesce(boundary, '*') AS boundary, count(*) AS n, count(*) FILTER (contains(risks, ',')) AS high FROM bo GROUP BY GROUPING SETS ((lang), (boundary), ())", **sql))
    register(f"risk_frequency_{name}", lambda s, d, f=found: boundaries.risk_frequency(f(s, d)), with_sql(["code"], "SELECT risk, count(*) AS n FROM (SELECT unnest(string_split(risks, ',')) AS risk FROM bo WHERE risks <> '') GROUP BY 1", **sql))

one = lambda p: values_sql([("x", p)], "z, pattern", "r")
register(
    "reentrancy_asof",
    lambda s, d: boundaries.reentrancy(domain(s, d, "code")),
    with_sql(
        ["code"],
        "SELECT file_id, CAST(length(substr(content, 1, c)) - length(replace(substr(content, 1, c), chr(10), '')) + 1 AS INT) AS line, c AS call_at, call, arg_min(w_match, w) AS write FROM p GROUP BY file_id, content, c, call",
        ca=hits_sql("code", "content", "file_id", one(cp.EXTERNAL_CALL)),
        wr=hits_sql("code", "content", "file_id", one(cp.STATE_WRITE)),
        p="SELECT ca.file_id, content, ca.start AS c, ca.match AS call, wr.start AS w, wr.match AS w_match FROM ca JOIN wr ON ca.file_id = wr.file_id AND wr.start > ca.start JOIN code ON code.file_id = ca.file_id WHERE NOT contains(substr(content, ca.start + 1, wr.start - ca.start), 'require') AND NOT contains(substr(content, ca.start + 1, wr.start - ca.start), 'if')",
    ),
)
# A statement end that white space and `require` do not follow, without a look-ahead: the next word leaves `require` at some letter.
LEAVES = "|".join(f"{'require'[:i]}(?:\\z|[^{'require'[i]}" + ("\\s" if i == 0 else "") + "])" for i in range(7))
register(
    "unchecked_calls",
    lambda s, d: domain(s, d, "code").select("file_id", boundaries.unchecked(F.col("content")).alias("unchecked")),
    with_sql(["code"], f"SELECT file_id, regexp_matches(content, '(?i)call\\s*\\([^)]*\\)[^;]*;\\s*(?:{LEAVES})') AS unchecked FROM code"),
)
LINES = {"li": "SELECT note_id, CAST(i AS INT) AS line, trim(t) AS text FROM (SELECT note_id, unnest(string_split(content, chr(10))) AS t, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS i FROM notes) WHERE length(trim(t)) >= 10"}
LINES["iv"] = f"SELECT note_id, line, unnest(string_split({risks_sql(cp.INVARIANTS, 'text')}, ',')) AS kind, CAST(least(10, len(list_filter([" + ", ".join(f"'{w}'" for w in cp.RELEVANT) + "], lambda w: contains(lower(text), w))) * 2) AS INT) AS relevance_tenths FROM li"
register("invariants", lambda s, d: boundaries.invariants(domain(s, d, "notes")), with_sql(["notes"], "SELECT * FROM iv WHERE kind <> ''", **LINES))
register("top_invariants", lambda s, d: boundaries.top_invariants(boundaries.invariants(domain(s, d, "notes"))), with_sql(["notes"], "SELECT * FROM iv WHERE kind <> '' ORDER BY relevance_tenths DESC, note_id, line, kind LIMIT 20", **LINES))
register(
    "entry_points",
    lambda s, d: boundaries.entry_points(domain(s, d, "code")),
    with_sql(["code"], "SELECT file_id, lang, pattern FROM (SELECT file_id, lang, CASE lang " + " ".join(f"WHEN '{k}' THEN list_filter([" + ", ".join("'" + p.replace("'", "''") + "'" for p in ps) + "], lambda p: contains(content, p))[1]" for k, ps in cp.ENTRY_POINTS.items()) + " END AS pattern FROM code) WHERE pattern IS NOT NULL"),
)
register(
    "sanitizer_output",
    lambda s, d: boundaries.sanitizer_findings(domain(s, d, "outputs")),
    with_sql(["outputs"], "SELECT run_id, sanitizer, 'Detected: ' || pattern AS message FROM outputs JOIN " + values_sql([(k, p) for k, ps in cp.SANITIZER_OUTPUT.items() for p in ps], "sanitizer, pattern") + " ON contains(lower(output), pattern)"),
)
weak = risks_sql({"hardcoded": [r"(key|secret|password)\s*=\s*[\"'].*[\"']"]} | {v: [k] for k, v in cp.WEAK_CRYPTO.items()}, "content")
register("crypto_check", lambda s, d: boundaries.crypto_check(domain(s, d, "code")), with_sql(["code"], f"SELECT file_id, w AS weak, CASE WHEN w <> '' THEN 'violated' ELSE 'verified' END AS status, CAST(CASE WHEN w <> '' THEN 0.8 ELSE 0.7 END AS DOUBLE) AS confidence FROM (SELECT file_id, {weak} AS w FROM code)"))
register(
    "upload_names",
    lambda s, d: domain(s, d, "uploads").select("upload_id", boundaries.upload_reason(F.col("name")).alias("reason")),
    with_sql(["uploads"], "SELECT upload_id, CASE WHEN contains(name, '..') OR starts_with(name, '/') THEN 'path_traversal_detected' WHEN length(name) - length(replace(name, '.', '')) > 1 AND NOT ends_with(name, '.tar.gz') AND NOT ends_with(name, '.min.js') THEN 'suspicious_extension' WHEN starts_with(name, '.') THEN 'hidden_file' END AS reason FROM uploads"),
)
register(
    "nesting_depth",
    lambda s, d: domain(s, d, "notes").select("note_id", boundaries.nesting(F.col("content")).cast("int").alias("depth")),
    with_sql(["notes"], "SELECT note_id, CAST(list_max(list_transform(string_split(content, chr(10)), lambda x: floor((length(x) - length(ltrim(x))) / 4))) AS INT) AS depth FROM notes"),
)
register(
    "certificate_issues",
    lambda s, d: boundaries.certificate_issues(domain(s, d, "certs"), F.lit("2025-01-01").cast("timestamp"), ["s1", "s2"]),
    with_sql(
        ["certs"],
        "SELECT chain_id, position, unnest(list_filter([CASE WHEN subject = issuer AND position <> last THEN 'self-signed' END, CASE WHEN regexp_matches(upper(algorithm), 'SHA1|MD5') THEN 'weak-algorithm' END, CASE WHEN key_size > 0 AND key_size < 2048 THEN 'weak-key' END, CASE WHEN CAST(not_after AS TIMESTAMP) < TIMESTAMP '2025-01-01' THEN 'expired' END, CASE WHEN position = last AND issuer NOT IN ('s1', 's2') THEN 'untrusted-root' END], lambda x: x IS NOT NULL)) AS issue FROM (SELECT *, max(position) OVER (PARTITION BY chain_id) AS last FROM certs)",
    ),
)
TASK = cases("event_id", ["memory_corruption", "race_condition", "logic_error", "reentrancy"])
register(
    "agent_routing",
    lambda s, d: boundaries.route(s.read.parquet(f"{d}/events.parquet").selectExpr("event_id AS task_id", f"{TASK} AS bug_class", "event_type AS stage"), domain(s, d, "agents")),
    with_sql(["agents"], f"SELECT t.event_id AS task_id, coalesce((SELECT arg_min(agent_id, (load, agent_id)) FROM agents a WHERE a.bug_class = {TASK}), (SELECT arg_min(agent_id, (load, agent_id)) FROM agents a WHERE a.stage = t.event_type), (SELECT arg_min(agent_id, (load, agent_id)) FROM agents)) AS agent_id FROM events t"),
)
GROUND = "event_id % 3 = 0 AS t, event_id % 5 = 0 AS m, event_id % 7 < 3 AS l, event_id % 4 AS techniques, CASE event_id % 6 WHEN 0 THEN 'low' ELSE 'high' END AS confidence"
register(
    "grounding_check",
    lambda s, d: boundaries.grounded(s.read.parquet(f"{d}/events.parquet").selectExpr("event_id", *GROUND.split(", "))),
    f"SELECT event_id, reason, CASE WHEN reason IS NULL THEN 'confirmed' ELSE 'unconfirmed' END AS state FROM (SELECT event_id, CASE WHEN NOT (t OR m OR l) THEN 'no grounding' WHEN techniques = 0 THEN 'no technique' WHEN confidence = 'low' THEN 'low confidence' END AS reason FROM (SELECT event_id, {GROUND} FROM events))",
)
QUERY_WORDS = ["overflow", "fix", "parser", "null pointer path", "build"]
register(
    "catalog_search",
    lambda s, d: boundaries.keyword_search(domain(s, d, "commits").select(F.col("commit_id").alias("entry_id"), F.explode(extract.keywords(F.col("message"))).alias("keyword")), frame(s, "query string", [(w,) for w in QUERY_WORDS])).groupBy("query").agg(F.count("*").alias("n")),
    with_sql(["commits"], "SELECT query, count(DISTINCT commit_id) AS n FROM (SELECT commit_id, trim(unnest(regexp_split_to_array(lower(message), '\\s+')), '.,;:\"''') AS keyword FROM commits) JOIN " + values_sql([(w,) for w in QUERY_WORDS], "query") + " ON length(keyword) >= 4 AND (contains(keyword, query) OR contains(query, keyword)) GROUP BY 1"),
)


def _report(s, d):
    f = domain(s, d, "findings")
    classes = scan.class_counts(f).select(F.col("bug_class").alias("o"), F.format_string("%s: %d", "bug_class", "n").alias("text"))
    best = scan.top(f, 5).select(F.format_string("%03d", (100 - F.col("score") * 100).cast("int")).alias("o"), F.concat("location", F.lit(" "), "bug_class").alias("text"))
    return report("Findings", [("By class", classes), ("Highest", best)])


register(
    "report_findings",
    _report,
    with_sql(
        ["findings"],
        "SELECT -1 AS section, '' AS o, '# Findings' AS text UNION ALL SELECT 0, '', '## By class' UNION ALL SELECT 0, '-' || bug_class, '- ' || bug_class || ': ' || count(*) FROM findings GROUP BY bug_class UNION ALL SELECT 1, '', '## Highest' UNION ALL SELECT 1, '-' || lpad(CAST(CAST(trunc(100 - score * 100) AS INT) AS VARCHAR), 3, '0'), '- ' || location || ' ' || bug_class FROM (SELECT * FROM findings ORDER BY score DESC, finding_id LIMIT 5)",
    ),
)
LINE_OF = "CAST(length(substr(content, 1, start)) - length(replace(substr(content, 1, start), chr(10), '')) + 1 AS INT)"
register(
    "verification_targets",
    lambda s, d: boundaries.verification_targets(domain(s, d, "provable")),
    with_sql(
        ["provable"],
        f"SELECT file_id, {LINE_OF} AS line, CASE lang WHEN 'c' THEN regexp_extract(match, '(\\w+)\\s*\\(', 1) WHEN 'rust' THEN 'unsafe_block' ELSE 'unknown' END AS name, CASE WHEN lang <> 'c' THEN property WHEN regexp_matches(x, 'malloc|free|alloc|pointer') THEN 'memory_safety' WHEN regexp_matches(x, 'thread|lock|mutex|atomic') THEN 'thread_safety' WHEN regexp_matches(x, '[+\\-*/]') THEN 'arithmetic_correctness' ELSE 'functional_correctness' END AS property, tenths FROM hc",
        he=hits_sql("provable", "content", "file_id", values_sql([("c", "", 6, r"(\w+)\s*\([^)]*\)\s*\{"), ("rust", "memory_safety", 9, r"unsafe\s*\{"), ("python", "memory_safety", 5, r"(del|__del__|gc\.)"), ("python", "memory_safety", 5, "(weakref|finalize)"), ("python", "thread_safety", 5, r"(threading|Thread|asyncio\.create_task)"), ("python", "thread_safety", 5, "(lock|Lock|Semaphore)")], "rl, property, tenths, pattern", "r")),
        hc="SELECT he.*, lang, content, substr(content, greatest(0, start - 200) + 1, start + length(match) + 200 - greatest(0, start - 200)) AS x FROM he JOIN provable USING (file_id) WHERE lang = rl",
    ),
)
_quote = chr(34) * 3
register(
    "comment_invariants",
    lambda s, d: boundaries.comment_invariants(domain(s, d, "annotated")).select("*", kn.domain_of(F.col("text")).alias("domain"), kn.formal_expressions(F.col("text")).alias("formal")),
    with_sql(
        ["annotated"],
        f"SELECT file_id, 'comment' AS origin, line, unnest(string_split(k, ',')) AS kind, text, 6 AS tenths, {DOMAIN_SQL} AS domain, {FORMAL_SQL} AS formal FROM sp WHERE k <> '' UNION ALL SELECT file_id, 'assertion', line, 'invariant', text, 8, {DOMAIN_SQL}, {FORMAL_SQL} FROM au",
        bl=hits_sql("annotated", "content", "file_id", values_sql([(r"/\*[\s\S]*?\*/",), (f'{_quote}[^"]*{_quote}',), ("'''[^']*'''",)], "pattern", "r")),
        bt=f"SELECT file_id, {LINE_OF} AS first, match FROM bl JOIN annotated USING (file_id)",
        li="SELECT file_id, CAST(first + i AS INT) AS line, t FROM (SELECT file_id, first, unnest(string_split(match, chr(10))) AS t, unnest(range(len(string_split(match, chr(10))))) AS i FROM bt) UNION ALL SELECT file_id, CAST(i + 1 AS INT), t FROM (SELECT file_id, unnest(string_split(content, chr(10))) AS t, unnest(range(len(string_split(content, chr(10))))) AS i FROM annotated) WHERE regexp_matches(t, '^\\s*(#|//)')",
        sp=f"SELECT file_id, line, text, {risks_sql(cp.INVARIANTS, 'text')} AS k FROM (SELECT file_id, line, trim(t) AS text FROM li) WHERE length(text) >= 10",
        as_=hits_sql("annotated", "content", "file_id", values_sql([(r"assert\s+(.+)",), (r"assertEqual\s*\((.+),\s*(.+)\)",), (r"assertTrue\s*\((.+)\)",), (r"assertFalse\s*\((.+)\)",), (r"assertRaises\s*\((.+)\)",), (r"invariant\s*\((.+)\)",), (r"assume\s*\((.+)\)",), (r"require\s*\((.+)\)",)], "pattern", "r")),
        au=f"SELECT file_id, {LINE_OF} AS line, regexp_extract(match, pattern, 1) AS text FROM as_ JOIN annotated USING (file_id)",
    ),
)
register(
    "riskiest_files",
    lambda s, d: boundaries.riskiest(boundaries.boundaries(domain(s, d, "code"), cp.FFI, cp.FFI_RISKS, 500)),
    with_sql(["code"], "SELECT file_id, CAST(sum(CASE WHEN risks = '' THEN 0 ELSE len(string_split(risks, ',')) END) AS BIGINT) AS risks FROM bo GROUP BY 1 ORDER BY risks DESC, file_id LIMIT 10", **boundary_sql(cp.FFI, cp.FFI_RISKS, 500)),
)
register(
    "plain_text",
    lambda s, d: s.read.parquet(f"{d}/pages.parquet").select("page_id", F.md5(boundaries.plain_text(F.col("html"))).alias("md5")),
    "SELECT page_id, md5(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '(?i)javascript:', '', 'g')) AS md5 FROM pages",
)
