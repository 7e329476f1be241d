"""What texts hold: sensitive data, taint flows, commits, patches, lint hits, JSON answers, symbols."""

from __future__ import annotations

import ast

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import COMMIT_WORDS, FLOW_CLASS, PATCH_WORDS, SENSITIVE, TAINT_SINKS, TAINT_SOURCES, frame
from auditloom.functions.text import any_of, line_of, matches
from auditloom.operators import taint


def pattern_hits(files: DataFrame, catalog: DataFrame) -> DataFrame:
    """files x catalog(…, pattern) -> a row a match, with offsets and line. The catalog is a constant and broadcast."""
    rules = [c for c in catalog.columns if c != "pattern"]
    hit = files.join(F.broadcast(catalog), F.expr("regexp_like(content, pattern)")).select("file_id", "content", *rules, F.explode(matches(F.col("content"), F.col("pattern"))).alias("m"))
    return hit.select("file_id", *rules, F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.col("m.text").alias("match"), line_of(F.col("content"), F.col("m.start")).alias("line"))


def sensitive_data(files: DataFrame) -> DataFrame:
    """Credentials, personal data and card numbers with severity. Classes are ASCII but for (?U)."""
    catalog = frame(files.sparkSession, "data_type string, description string, pattern string", SENSITIVE)
    hits = pattern_hits(files, catalog)
    return hits.withColumn("severity", F.when(F.col("data_type") == "credentials", "critical").otherwise("high"))


def taint_flows(files: DataFrame) -> DataFrame:
    """Sources and later sinks of one file with no sanitizer between them, and the class of the flow, by one set of rules
    (see taint.flows for those of four languages)."""
    found = taint.open_flows(files.select("file_id", F.lit("any").alias("lang"), "content"), {"any": TAINT_SOURCES}, {"any": TAINT_SINKS})
    classes = frame(files.sparkSession, "source string, sink string, vulnerability string", [(a, b, v) for (a, b), v in FLOW_CLASS.items()])
    flows = found.join(F.broadcast(classes), ["source", "sink"], "left")
    return flows.select("file_id", "source", "sink", "source_at", "sink_at", F.coalesce("vulnerability", F.lit("Unsanitized Data Flow")).alias("vulnerability"))


def flow_totals(flows: DataFrame) -> DataFrame:
    """Counts by source kind, by class, and in all, in one pass."""
    source, kind = F.col("source"), F.col("vulnerability")
    sums = flows.groupingSets([[source], [kind], []], source, kind).agg(F.count("*").alias("n"))
    return sums.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in ("source", "vulnerability")], "n")


def security_commits(commits: DataFrame) -> DataFrame:
    found = any_of(F.col("message"), COMMIT_WORDS)
    return commits.withColumn("words", found).filter(F.size("words") > 0)


def cve_ids(commits: DataFrame) -> DataFrame:
    ids = F.regexp_extract_all("message", F.lit(r"(?i)CVE-\d{4}-\d{4,}"), F.lit(0))
    return commits.select("commit_id", F.posexplode(ids).alias("ordinal", "cve_id"))


def patch_types(commits: DataFrame) -> DataFrame:
    tests = [F.when(F.array_contains(F.transform(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.lower("message"), w)), True), kind) for kind, words in PATCH_WORDS.items()]
    return commits.select(F.explode(F.array_compact(F.array(*tests))).alias("bug_type")).groupBy("bug_type").agg(F.count("*").alias("n"))


def keywords(text: Column) -> Column:
    """Distinct words of four letters or more, in order, without punctuation around them."""
    words = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.btrim(w, F.lit(".,;:\"'")))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) >= 4))


def diff_lines(text: Column) -> tuple[Column, Column]:
    """Removed and added lines of a diff, without the file headers."""
    lines = F.split(text, "\n", -1)
    pick = lambda sign: F.filter(lines, lambda x: x.startswith(sign) & ~x.startswith(sign * 3))
    return pick("-"), pick("+")


def class_scores(text: Column, catalog: dict[str, list[str]]) -> Column:
    """Matches of each class's patterns added up, as a struct of the first class with the most of them."""
    scores = F.array(*[F.struct(sum((F.regexp_count(text, F.lit(p)) for p in ps), F.lit(0)).alias("score"), F.lit(-i).alias("o"), F.lit(k).alias("bug_class")) for i, (k, ps) in enumerate(catalog.items())])
    return F.array_max(scores)


def line_lint(files: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """rule, pattern -> file_id, line, rule; every line against every rule, ignoring case."""
    catalog = frame(files.sparkSession, "rule string, pattern string", [(r, "(?i)" + p) for r, p in rules])
    lines = files.select("file_id", F.posexplode(F.split("content", "\n", -1)).alias("at", "text"))
    return lines.join(F.broadcast(catalog), F.expr("regexp_like(text, pattern)")).select("file_id", (F.col("at") + 1).alias("line"), "rule")


ANSWER = "struct<vulnerabilities:array<struct<location:string,bug_class:string,confidence:double>>>"


def json_answers(answers: DataFrame) -> DataFrame:
    """The vulnerabilities in the outermost braces of an answer; else one row with the answer's start and confidence .3."""
    body = F.regexp_extract("response", r"(?s)\{.*\}", 0)
    found = F.from_json(body, ANSWER)["vulnerabilities"]
    some = F.when(F.size(F.coalesce(found, F.array())) > 0, found)
    one = answers.withColumn("v", F.explode_outer(some))
    return one.select(*answers.columns, F.col("v.location").alias("location"), F.coalesce("v.bug_class", F.lit("unknown")).alias("bug_class"), F.coalesce("v.confidence", F.lit(0.3)).alias("confidence"), F.when(F.col("v").isNull(), F.substring("response", 1, 500)).alias("evidence"))


def python_symbols(files: DataFrame) -> DataFrame:
    """file_id, kind, name, line of functions, classes, imports and calls of Python sources; sources that don't parse give none.

    A syntax tree needs Python: batches go to the workers, files stay where they are."""

    def walk(batches):
        import pandas as pd

        kinds = {ast.FunctionDef: "function", ast.ClassDef: "class"}
        for pdf in batches:
            out = []
            for file_id, content in zip(pdf["file_id"], pdf["content"]):
                try:
                    tree = ast.parse(content or "")
                except (SyntaxError, ValueError, RecursionError, MemoryError):
                    continue
                for node in ast.walk(tree):
                    if type(node) in kinds:
                        out.append((file_id, kinds[type(node)], node.name, node.lineno))
                    elif isinstance(node, ast.Import | ast.ImportFrom):
                        base = f"{node.module}." if isinstance(node, ast.ImportFrom) and node.module else ""
                        out += [(file_id, "import", base + a.name, node.lineno) for a in node.names]
                    elif isinstance(node, ast.Call):
                        out.append((file_id, "call", ast.unparse(node.func), node.lineno))
            yield pd.DataFrame(out, columns=["file_id", "kind", "name", "line"])

    return files.select("file_id", "content").mapInPandas(walk, "file_id long, kind string, name string, line int")


# What names symbols of JavaScript and TypeScript, and extensions of source files.
JS_SYMBOLS = {"import": r"import\s+[^;]*?from\s+[\"']([^\"']+)[\"']", "function": r"function\s+(\w+)", "arrow": r"const\s+(\w+)\s*=\s*(?:async\s*)?\(", "class": r"class\s+(\w+)"}
EXTENSIONS = {"c": "c", "cpp": "c", "h": "c", "rs": "rust", "py": "python", "js": "javascript", "go": "go", "sol": "solidity"}


def js_symbols(files: DataFrame) -> DataFrame:
    """file_id, kind, ordinal, name of imports, functions, arrow functions and classes."""
    parts = [files.select("file_id", F.lit(k).alias("kind"), F.posexplode(F.regexp_extract_all("content", F.lit(p), F.lit(1))).alias("ordinal", "name")) for k, p in JS_SYMBOLS.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def language_vote(diffs: DataFrame) -> DataFrame:
    """diff_id, language: of the files a diff names the language of most, the first by name of equals. The extension's
    alternation is unanchored, so ``.cpp`` counts as ``.c``."""
    ext = F.explode(F.regexp_extract_all("content", F.lit(r"\.(" + "|".join(EXTENSIONS) + ")"), F.lit(1)))
    lang = F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv])
    votes = diffs.select("diff_id", ext.alias("ext")).select("diff_id", lang[F.col("ext")].alias("language")).groupBy("diff_id", "language").agg(F.count("*").alias("n"))
    best = votes.groupBy("diff_id").agg(F.max(F.struct("n")).alias("m"), F.min_by("language", F.struct(-F.col("n"), F.col("language"))).alias("language"))
    return best.select("diff_id", "language", F.col("m.n").alias("n"))
