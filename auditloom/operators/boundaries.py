"""Language boundaries in source code and what surrounds them; invariants, entry points, tool output, uploads, certificates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.catalogs import frame
from auditloom.functions.code_patterns import ASSERTIONS, COMMENT_BLOCKS, ENTRY_POINTS, EXTERNAL_CALL, INVARIANTS, PYTHON_TARGETS, RELEVANT, SANITIZER_OUTPUT, STATE_WRITE, WEAK_CRYPTO
from auditloom.functions.text import any_of, line_of, matches, window


def kinds_in(text: Column, risks: dict[str, list[str]]) -> Column:
    """The kinds of which a pattern occurs in the text, ignoring case, in their order."""
    return F.array_compact(F.array(*[F.when(text.rlike("(?i)" + "|".join(f"(?:{p})" for p in ps)), k) for k, ps in risks.items()]))


def boundaries(files: DataFrame, patterns: dict[str, dict[str, str]], risks: dict[str, list[str]], around: int) -> DataFrame:
    """files: file_id, lang, content -> a row a boundary of the file's language, with line and the risks around it."""
    catalog = frame(files.sparkSession, "lang string, boundary string, pattern string", [(lang, k, p) for lang, ps in patterns.items() for k, p in ps.items()])
    hit = files.join(F.broadcast(catalog), "lang").select("file_id", "lang", "content", "boundary", F.explode(matches(F.col("content"), F.col("pattern"))).alias("m"))
    context = window(F.col("content"), F.col("m.start"), F.col("m.end"), around)
    return hit.select("file_id", "lang", "boundary", F.col("m.start").alias("start"), line_of(F.col("content"), F.col("m.start")).alias("line"), kinds_in(context, risks).alias("risks"))


def boundary_totals(found: DataFrame) -> DataFrame:
    """By language, by boundary, in all; high risk is two kinds or more."""
    lang, boundary = F.col("lang"), F.col("boundary")
    sums = found.groupingSets([[lang], [boundary], []], lang, boundary).agg(F.count("*").alias("n"), F.count_if(F.size("risks") >= 2).alias("high"))
    return sums.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in ("lang", "boundary")], "n", "high")


def risk_frequency(found: DataFrame) -> DataFrame:
    return found.select(F.explode("risks").alias("risk")).groupBy("risk").agg(F.count("*").alias("n"))


def reentrancy(files: DataFrame) -> DataFrame:
    """Each external call with the first later state write that no ``require`` or ``if`` stands before.

    Sorted windows a file: the next write and the end of the next guard are looked up for each call; if a guard ends before that write,
    later writes have it before them as well. Texts are read where hits are found and go no further."""
    text = F.col("content")
    rules = frame(files.sparkSession, "role string, pattern string", [("call", EXTERNAL_CALL), ("write", STATE_WRITE), ("guard", "require|if")])
    hit = files.select("file_id", "content").join(F.broadcast(rules), F.lit(True)).select("file_id", "role", "content", F.explode(matches(text, F.col("pattern"))).alias("m"))
    hit = hit.select("file_id", "role", F.col("m.start").alias("at"), F.col("m.end").alias("end"), F.col("m.text").alias("text"), F.when(F.col("role") == "call", line_of(text, F.col("m.start"))).alias("line"))
    later = Window.partitionBy("file_id").orderBy("at")
    write = F.min(F.when(F.col("role") == "write", F.struct("at", "text"))).over(later.rangeBetween(1, Window.unboundedFollowing))
    guard = F.min(F.when(F.col("role") == "guard", F.col("end"))).over(later.rangeBetween(0, Window.unboundedFollowing))
    found = hit.withColumn("w", write).withColumn("g", guard).filter("role = 'call' AND w IS NOT NULL AND (g IS NULL OR w.at < g)")
    return found.select("file_id", "line", F.col("at").alias("call_at"), F.col("text").alias("call"), F.col("w.text").alias("write"))


def unchecked(text: Column) -> Column:
    """Whether a call's statement is followed by something else than ``require``."""
    return text.rlike(r"(?i)call\s*\([^)]*\)[^;]*;(?!\s*require)")


def invariants(notes: DataFrame) -> DataFrame:
    """note_id, line, kind, relevance: lines of ten characters or more, one hit a kind."""
    lines = notes.select("note_id", F.posexplode(F.split("content", "\n", -1)).alias("at", "raw")).select("note_id", (F.col("at") + 1).alias("line"), F.trim("raw").alias("text")).filter(F.length("text") >= 10)
    return lines.select("note_id", "line", F.explode(kinds_in(F.col("text"), INVARIANTS)).alias("kind"), F.least(F.lit(10), F.size(any_of(F.col("text"), RELEVANT)) * 2).alias("relevance_tenths"))


def top_invariants(found: DataFrame, n: int = 20) -> DataFrame:
    return found.orderBy(F.desc("relevance_tenths"), "note_id", "line", "kind").limit(n)


def entry_points(files: DataFrame) -> DataFrame:
    """The first literal of the file's language that it holds."""
    found = F.coalesce(*[F.when(F.col("lang") == lang, F.get(F.filter(F.array(*map(F.lit, ps)), lambda p: F.contains("content", p)), F.lit(0))) for lang, ps in ENTRY_POINTS.items()])
    return files.select("file_id", "lang", found.alias("pattern")).filter("pattern is not null")


def sanitizer_findings(outputs: DataFrame) -> DataFrame:
    catalog = frame(outputs.sparkSession, "sanitizer string, pattern string", [(k, p) for k, ps in SANITIZER_OUTPUT.items() for p in ps])
    return outputs.join(F.broadcast(catalog), F.expr("contains(lower(output), pattern)")).select("run_id", "sanitizer", F.concat(F.lit("Detected: "), "pattern").alias("message"))


def crypto_check(files: DataFrame) -> DataFrame:
    """Hard-coded keys and weak algorithms: violated with confidence .8, else verified with .7."""
    weak = F.array_compact(F.array(F.when(F.col("content").rlike(r"(?i)(key|secret|password)\s*=\s*[\"'].*[\"']"), "hardcoded"), *[F.when(F.col("content").rlike(f"(?i){p}"), k) for p, k in WEAK_CRYPTO.items()]))
    return files.select("file_id", F.concat_ws(",", weak).alias("weak"), F.when(F.size(weak) > 0, "violated").otherwise("verified").alias("status"), F.when(F.size(weak) > 0, 0.8).otherwise(0.7).alias("confidence"))


def upload_reason(name: Column) -> Column:
    """Why an upload's name is refused, null if it is not."""
    dots = F.length(name) - F.length(F.replace(name, F.lit("."), F.lit("")))
    return (
        F.when(F.contains(name, F.lit("..")) | name.startswith("/"), "path_traversal_detected")
        .when((dots > 1) & ~name.endswith(".tar.gz") & ~name.endswith(".min.js"), "suspicious_extension").when(name.startswith("."), "hidden_file")
    )


def nesting(text: Column) -> Column:
    """Greatest indentation of a line in steps of four blanks."""
    return F.array_max(F.transform(F.split(text, "\n", -1), lambda x: F.floor((F.length(x) - F.length(F.ltrim(x))) / 4)))


def certificate_issues(certs: DataFrame, as_of: Column, trusted: list[str]) -> DataFrame:
    """certs: chain_id, position, subject, issuer, algorithm, key_size, not_after -> chain_id, position, issue."""
    chain = certs.groupBy("chain_id").agg(F.max("position").alias("last"))
    c = certs.join(chain, "chain_id")
    issues = F.array_compact(
        F.array(
            F.when((F.col("subject") == F.col("issuer")) & (F.col("position") != F.col("last")), "self-signed"),
            F.when(F.upper("algorithm").rlike("SHA1|MD5"), "weak-algorithm"),
            F.when((F.col("key_size") > 0) & (F.col("key_size") < 2048), "weak-key"),
            F.when(F.try_to_timestamp("not_after") < as_of, "expired"),
            F.when((F.col("position") == F.col("last")) & ~F.col("issuer").isin(trusted), "untrusted-root"),
        )
    )
    return c.select("chain_id", "position", F.explode(issues).alias("issue"))


def route(tasks: DataFrame, agents: DataFrame) -> DataFrame:
    """Each task (task_id, bug_class, stage) to the least loaded agent (agent_id, bug_class, stage, load) of its class, else of
    its stage, else of all; of equals the first. Choices are made once a key, so tasks meet small tables only."""
    best = F.min_by("agent_id", F.struct("load", "agent_id"))
    by_class = agents.groupBy("bug_class").agg(best.alias("a"))
    by_stage = agents.groupBy("stage").agg(best.alias("b"))
    anyone = agents.agg(best.alias("c"))
    out = tasks.join(by_class, "bug_class", "left").join(by_stage, "stage", "left").join(F.broadcast(anyone), F.lit(True))
    return out.select("task_id", F.coalesce("a", "b", "c").alias("agent_id"))


def grounded(alerts: DataFrame) -> DataFrame:
    """Alerts that hold what a finding must have; the reason where one doesn't."""
    reason = F.when(~(F.col("t") | F.col("m") | F.col("l")), "no grounding").when(F.col("techniques") == 0, "no technique").when(F.col("confidence") == "low", "low confidence")
    return alerts.select("event_id", reason.alias("reason"), F.when(reason.isNull(), "confirmed").otherwise("unconfirmed").alias("state"))


def keyword_search(catalog: DataFrame, words: DataFrame) -> DataFrame:
    """words (query) against keywords (entry_id, keyword): either holds the other.

    Distinct words meet distinct words, by the rarest trigram of the one that lies within the other; those too short for
    a trigram are tried against all distinct ones. Entries are joined to what was found."""
    queries, held = words.select("query").distinct(), catalog.select("keyword").distinct()
    one = _within(queries.withColumnRenamed("query", "a"), held.withColumnRenamed("keyword", "b")).select(F.col("a").alias("query"), F.col("b").alias("keyword"))
    two = _within(held.withColumnRenamed("keyword", "a"), queries.withColumnRenamed("query", "b")).select(F.col("b").alias("query"), F.col("a").alias("keyword"))
    return one.unionByName(two).distinct().join(catalog, "keyword").select("query", "entry_id").distinct()


def _within(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """a, b of distinct words: all pairs of which b holds a."""
    grams = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.col(c).substr(i, F.lit(3)))))
    index = outer.filter(F.length("b") >= 3).withColumn("gram", grams("b"))
    asked = inner.filter(F.length("a") >= 3).withColumn("gram", grams("a")).join(index.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left")
    rarest = asked.groupBy("a").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))  # a trigram that no word has: no pair
    long = rarest.join(index, "gram").filter(F.contains("b", "a")).select("a", "b")
    short = inner.filter(F.length("a") < 3).join(outer, F.expr("contains(b, a)")).select("a", "b")
    return long.unionByName(short)


def verification_targets(files: DataFrame) -> DataFrame:
    """file_id, line, name, property, tenths of confidence: C functions by what stands within 200 characters (6), unsafe blocks (9),
    Python code that manages memory or threads (5, a row a pattern and match)."""
    text = F.col("content")
    rules = [("c", "", 6, r"(\w+)\s*\([^)]*\)\s*\{"), ("rust", "memory_safety", 9, r"unsafe\s*\{")] + [("python", k, 5, p) for k, ps in PYTHON_TARGETS.items() for p in ps]
    catalog = frame(files.sparkSession, "lang string, property string, tenths int, pattern string", rules)
    hit = files.join(F.broadcast(catalog), "lang").select("file_id", "lang", "content", "property", "tenths", "pattern", F.explode(matches(text, F.col("pattern"))).alias("m"))
    context = window(text, F.col("m.start"), F.col("m.end"), 200)
    nearby = F.when(context.rlike("malloc|free|alloc|pointer"), "memory_safety").when(context.rlike("thread|lock|mutex|atomic"), "thread_safety").when(context.rlike(r"[+\-*/]"), "arithmetic_correctness").otherwise("functional_correctness")
    name = F.when(F.col("lang") == "c", F.regexp_extract("m.text", r"(\w+)\s*\(", 1)).when(F.col("lang") == "rust", "unsafe_block").otherwise("unknown")
    return hit.select("file_id", line_of(text, F.col("m.start")).alias("line"), name.alias("name"), F.when(F.col("lang") == "c", nearby).otherwise(F.col("property")).alias("property"), "tenths")


def comment_invariants(files: DataFrame) -> DataFrame:
    """file_id, origin, line (in the file), kind, text, tenths: invariants in comments (6) and assertions (8).

    Comments are blocks (``/* */`` and Python's long strings) and lines that begin with # or //; each of their lines of ten characters or more
    gives one row a kind. An assertion gives what it asserts."""
    content = F.col("content")
    block = files.select("file_id", "content", F.explode(F.array(*map(F.lit, COMMENT_BLOCKS))).alias("p")).select("file_id", "content", F.explode(matches(content, F.col("p"))).alias("m"))
    blocks = block.select("file_id", line_of(content, F.col("m.start")).alias("first"), F.posexplode(F.split("m.text", "\n", -1)).alias("at", "text")).select("file_id", (F.col("first") + F.col("at")).alias("line"), "text")
    lines = files.select("file_id", F.posexplode(F.split("content", "\n", -1)).alias("at", "text")).select("file_id", (F.col("at") + 1).alias("line"), "text").filter(F.col("text").rlike(r"^\s*(#|//)"))
    spoken = blocks.unionByName(lines).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", "")).filter(F.length("text") >= 10)
    spoken = spoken.select("file_id", F.lit("comment").alias("origin"), "line", F.explode(kinds_in(F.col("text"), INVARIANTS)).alias("kind"), "text", F.lit(6).alias("tenths"))
    forms = files.select("file_id", "content", F.explode(F.array(*map(F.lit, ASSERTIONS))).alias("p")).select("file_id", "content", "p", F.explode(matches(content, F.col("p"))).alias("m"))
    asserted = forms.select("file_id", F.lit("assertion").alias("origin"), line_of(content, F.col("m.start")).alias("line"), F.lit("invariant").alias("kind"), F.expr("regexp_extract(m.text, p, 1)").alias("text"), F.lit(8).alias("tenths"))
    return spoken.unionByName(asserted)


def riskiest(found: DataFrame, n: int = 10) -> DataFrame:
    """The files with most risks at their boundaries."""
    return found.groupBy("file_id").agg(F.sum(F.size("risks")).alias("risks")).orderBy(F.desc("risks"), "file_id").limit(n)


def plain_text(text: Column) -> Column:
    """Without tags and script addresses."""
    return F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), "(?i)javascript:", "")
