"""Controls, verification results, models, paths and estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Domains of invariants, path prefixes of systems.
DOMAINS = {
    "security": ["vulnerability", "exploit", "attack", "mitigation", "threat", "risk", "protection", "defense", "secure"],
    "database": ["transaction", "consistency", "isolation", "durability", "query", "index", "schema", "migration"],
    "network": ["protocol", "connection", "latency", "throughput", "packet", "socket", "bandwidth", "timeout"],
    "crypto": ["encryption", "decryption", "key", "signature", "hash", "certificate", "authentication", "integrity"],
    "filesystem": ["file", "directory", "permission", "access", "inode", "mount", "path", "lock"],
}
FORMAL = [r"[<>]=?\s*\d+", r"[a-zA-Z_]\w*\s*[<>!=]=\s*[a-zA-Z_]\w*", r"\b(?:true|false|null|undefined)\b", r"\b(?:and|or|not|if|then|else)\b"]
SYSTEM_PREFIXES = [("windows", ["c:/", "/windows"]), ("macos", ["/library", "/applications", "/users"]), ("linux", ["/usr", "/etc", "/var", "/home", "/opt"])]


def controls_of(controls: DataFrame) -> DataFrame:
    """Per technique its controls, distinct and sorted."""
    return controls.groupBy("technique_id").agg(F.array_sort(F.collect_set("control")).alias("controls"))


def control_coverage(controls: DataFrame) -> DataFrame:
    return controls.agg(F.count("*").alias("total"), F.count_distinct("control").alias("controls"), F.count_distinct("technique_id").alias("techniques"))


def suggest_techniques(requirements: DataFrame, controls: DataFrame) -> DataFrame:
    """requirements: requirement -> techniques of which a definition contains one of its words of more than five characters, or
    the name one of more than four. Words are parted by white space.

    A word of a requirement lies within one of a catalog text, so distinct words are matched with distinct words, never text by
    text: they meet by the asked word's rarest trigram in the catalog, and contains decides."""
    words = lambda c: F.array_distinct(F.split(F.lower(c), r"(?U)\s+"))
    grams = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c) - 2), lambda i: F.col(c).substr(i, F.lit(3)))))
    asked = requirements.select("requirement").distinct().withColumn("word", F.explode(words(F.col("requirement")))).filter(F.length("word") > 4)
    held = lambda c, least: controls.select("technique_id", F.explode(words(F.col(c))).alias("held"), F.lit(least).alias("least"))
    held = held("name", 5).unionByName(held("definition", 6)).filter(F.length("held") >= F.col("least")).distinct()
    index = held.select("held").distinct().withColumn("gram", grams("held"))
    rarest = asked.select("word").distinct().withColumn("gram", grams("word")).join(index.groupBy("gram").agg(F.count("*").alias("n")), "gram")
    rarest = rarest.groupBy("word").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    within = rarest.join(index, "gram").filter(F.contains("held", "word")).select("word", "held")
    techniques = within.join(held, "held").filter(F.length("word") >= F.col("least")).select("word", "technique_id").distinct()
    return asked.join(techniques, "word").select("requirement", "technique_id").distinct()


def verification_report(results: DataFrame) -> DataFrame:
    """Properties and methods by status, one column a status."""
    return results.groupBy("property", "method").pivot("status", ["verified", "violated", "unknown", "timeout"]).count().na.fill(0)


def choose_model(tasks: DataFrame, models: DataFrame, budget: float) -> DataFrame:
    """Per tier the first affordable model (two units of its price within the budget) with code, else the cheapest of all."""
    fits = models.filter((F.col("price") * 2 <= budget) & F.col("has_code")).groupBy("tier").agg(F.min("model_id").alias("first"))
    cheapest = models.agg(F.min_by("model_id", F.struct("price", "model_id")).alias("cheapest"))
    return tasks.join(fits, "tier", "left").join(F.broadcast(cheapest), F.lit(True)).select("task_id", F.coalesce("first", "cheapest").alias("model_id"))


def pool_metrics(agents: DataFrame) -> DataFrame:
    return agents.groupBy("stage").agg(F.count("*").alias("agents"), F.sum("load").alias("load"), F.count_if(F.col("load") == 0).alias("idle"))


def normal_path(path: Column) -> Column:
    return F.lower(F.translate(path, "\\", "/"))


def system_of(path: Column) -> Column:
    out = F.lit("unknown")
    for name, prefixes in reversed(SYSTEM_PREFIXES):
        test = F.lit(False)
        for p in prefixes:
            test = test | normal_path(path).startswith(p)
        out = F.when(test, name).otherwise(out)
    return out


def domain_of(text: Column) -> Column:
    """The domain with the most words in the text, the first of equals, else general."""
    hits = lambda ws: sum((F.contains(F.lower(text), F.lit(w)).cast("int") for w in ws), F.lit(0))
    best = F.array_max(F.array(*[F.struct(hits(ws).alias("n"), F.lit(-i).alias("o"), F.lit(k).alias("domain")) for i, (k, ws) in enumerate(DOMAINS.items())]))
    return F.when(best["n"] > 0, best["domain"]).otherwise("general")


def formal_expressions(text: Column) -> Column:
    """Comparisons with numbers and of names, constants and logical words in the text, joined; one form after the other."""
    return F.concat_ws(", ", F.concat(*[F.regexp_extract_all(text, F.lit(f"(?i){p}"), F.lit(0)) for p in FORMAL]))


def line_context(text: Column, line: Column, around: int) -> Column:
    """The lines around a line (from 1)."""
    first = F.greatest(F.lit(1), line - around)
    return F.array_join(F.slice(F.split(text, "\n", -1), first, line + around - first + 1), "\n")


def estimates(answers: DataFrame) -> DataFrame:
    """Cost estimates of texts in millionths: a thousandth of a dollar a thousand words, a ten-thousandth a thousand tokens of four characters."""
    chars = F.length(F.coalesce("response", F.lit("")))
    words = F.size(F.filter(F.split(F.coalesce("response", F.lit("")), r"\s+"), lambda w: w != ""))
    return answers.select("conv_id", "turn", words.cast("long").alias("scan_millionths"), F.floor(chars / 4 / 1000 * 100).cast("long").alias("embed_millionths"))


def recommendations(findings: DataFrame, sheets: DataFrame) -> DataFrame:
    """findings (finding_id, bug_class, cwe_id), sheets (name, priority, kind, value, ordinal): the sheets of a finding's class,
    then of its CWE that are not among them; ranked by priority, and by that order within one."""
    asked = findings.select("finding_id", F.explode(F.array(F.struct(F.lit("class").alias("kind"), F.col("bug_class").alias("value"), F.lit(0).alias("step")), F.struct(F.lit("cwe").alias("kind"), F.col("cwe_id").alias("value"), F.lit(1).alias("step")))).alias("a")).select("finding_id", "a.*")
    hit = asked.join(sheets, ["kind", "value"]).groupBy("finding_id", "name", "priority").agg(F.min(F.struct("step", "ordinal")).alias("first"))
    rank = F.coalesce(F.create_map(*[F.lit(x) for kv in (("critical", 0), ("high", 1), ("medium", 2), ("low", 3)) for x in kv])[F.col("priority")], F.lit(4))
    w = Window.partitionBy("finding_id").orderBy(rank, "first", "name")
    return hit.select("finding_id", "name", "priority", F.row_number().over(w).alias("place"))


def technique_union(lookups: DataFrame, keys: Column) -> DataFrame:
    """All techniques of the keys of a catalog (key, techniques), distinct and sorted, as one row."""
    return lookups.filter(keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("techniques")))).alias("techniques"))
