"""Short summaries and selections: properties of results, coverage of cheat sheets, capped lists, fixes, facets, timelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.code_patterns import CROSS_LANGUAGE_CLASSES, FIX_PATTERNS, NETWORK_FACING


def results_by_property(results: DataFrame, targets: DataFrame) -> DataFrame:
    """property, status, n: results by the property of the first target (least ordinal, then property) of their id; results of none are left out."""
    first = targets.groupBy("target_id").agg(F.min_by("property", F.struct("ordinal", "property")).alias("property"))
    counted = results.groupBy("target_id", "status").agg(F.count("*").alias("n"))
    return counted.join(first, "target_id").groupBy("property", "status").agg(F.sum("n").alias("n"))


def network_facing(target_type: Column) -> Column:
    return F.coalesce(target_type.isin(NETWORK_FACING), F.lit(False))


def sheet_stats(sheets: DataFrame) -> DataFrame:
    """Sheets in all, distinct classes and CWEs they cover, and sheets by priority."""
    of = lambda kind: F.count_distinct(F.when(F.col("kind") == kind, F.col("value")))
    by = [F.count_distinct(F.when(F.col("priority") == p, F.col("name"))).alias(p) for p in ("critical", "high", "medium", "low")]
    return sheets.agg(F.count_distinct("name").alias("sheets"), of("class").alias("classes"), of("cwe").alias("cwes"), *by)


def capped_list(items: DataFrame, group: str, item: str, most: int = 20) -> DataFrame:
    """group, text: a line for each of the first items and how many more there are. Only the first are ever gathered."""
    first = items.withColumn("__r", F.row_number().over(Window.partitionBy(group).orderBy(item))).filter(F.col("__r") <= most)
    lines = first.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("__r", F.concat(F.lit("- "), F.col(item).cast("string")).alias("t")))).alias("l"))
    sized = lines.join(items.groupBy(group).agg(F.count("*").alias("n")), group)
    more = F.when(F.col("n") > most, F.concat(F.lit("\n... and "), F.col("n") - most, F.lit(" more"))).otherwise("")
    return sized.select(group, F.concat(F.array_join(F.transform("l", lambda x: x["t"]), "\n"), more).alias("text"))


def patterns_above(scored: DataFrame, least: float = 0.65, limit: int = 50, most: int = 500, floor: float = 0.5) -> DataFrame:
    """id, score: the best up to limit (never more than most) at a score of least or more (never less than floor)."""
    return scored.filter(F.col("score") >= max(least, floor)).orderBy(F.desc("score"), "id").limit(min(limit, most)).select("id", "score")


def embedding_text(bug_class: Column, location: Column, precondition: Column) -> Column:
    return F.concat(bug_class, F.lit(" at "), location, F.lit(": "), precondition)


def feedback_id(at: Column) -> Column:
    return F.concat(F.lit("feedback-"), F.date_format(at, "yyyyMMdd-HHmmss"))


def context_metrics(missed: DataFrame, examples: int = 3) -> DataFrame:
    """agent_id, category, missed_count, share of the agent's misses, the first examples: what an agent's context learns."""
    place = F.row_number().over(Window.partitionBy("agent_id", "category").orderBy("vuln_id"))
    some = missed.withColumn("r", place).filter(F.col("r") <= examples).groupBy("agent_id", "category").agg(F.array_sort(F.collect_list("vuln_id")).alias("examples"))
    counts = missed.groupBy("agent_id", "category").agg(F.count("*").alias("missed_count"))
    total = counts.groupBy("agent_id").agg(F.sum("missed_count").alias("total"))
    return counts.join(total, "agent_id").join(some, ["agent_id", "category"]).select("agent_id", "category", "missed_count", (F.col("missed_count") / F.col("total")).alias("share"), "examples")


def target_agents(language: Column, bug_class: Column) -> Column:
    """Agents that a patch teaches, the default scanner if there is none."""
    cross = F.when(bug_class.isin(CROSS_LANGUAGE_CLASSES), F.lit("scanner_cross_language"))
    own = [F.when(bug_class == c, F.lit(a)) for c, a in (("wasm_runtime", "scanner_wasm"), ("solidity_native", "scanner_solidity"))]
    found = F.array_compact(F.array(F.when(language != "", F.concat(F.lit("scanner_"), language)), cross, *own))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("scanner_default")))


def split_by_kind(top: DataFrame) -> DataFrame:
    """kind, notes: an already limited list of invariants, split by kind in its order."""
    order = F.struct((-F.col("relevance_tenths")).alias("o"), "note_id", "line")
    return top.groupBy("kind").agg(F.array_sort(F.collect_list(order)).alias("l")).select("kind", F.array_join(F.transform("l", lambda x: F.concat_ws(":", x["note_id"], x["line"])), ",").alias("notes"))


def fix_patterns(text: Column) -> Column:
    """The descriptions of the rules that a patch answers, in order."""
    return F.array_compact(F.array(*[F.when(F.lower(text).rlike(p), F.lit(d)) for p, d in FIX_PATTERNS]))


def host_facets(hosts: DataFrame) -> DataFrame:
    """facet, value, n: hosts by service, by country, by vulnerability and in all."""
    by = ("service", "country", "vuln")
    sums = hosts.groupingSets([[F.col(c)] for c in by], *map(F.col, by)).agg(F.count("*").alias("n"))
    facet = reduce(lambda rest, c: F.when(F.col(c).isNotNull(), F.lit(c)).otherwise(rest), by, F.lit("none"))
    return sums.select(facet.alias("facet"), F.coalesce(*by).alias("value"), "n").unionByName(hosts.agg(F.count("*").alias("n")).select(F.lit("all").alias("facet"), F.lit("*").alias("value"), "n"))


def timeline(events: DataFrame, gap_minutes: int = 60) -> DataFrame:
    """event_id, agent_id, place, incident: events with evidence in order of time, an agent's incidents parted by longer pauses."""
    w = Window.partitionBy("agent_id").orderBy("ts", "event_id")
    kept = events.filter("evidence is not null").withColumn("place", F.row_number().over(w))
    fresh = F.coalesce(F.lag("ts").over(w) < F.col("ts") - F.make_interval(mins=F.lit(gap_minutes)), F.lit(True))
    return kept.withColumn("fresh", fresh.cast("int")).withColumn("incident", F.sum("fresh").over(w)).select("event_id", "agent_id", "place", "incident")


def agents_for(agents: DataFrame, stage: str, bug_class: str, most_load: int) -> DataFrame:
    """Agents of a stage and class that can take more."""
    return agents.filter((F.col("stage") == stage) & (F.col("bug_class") == bug_class) & (F.col("load") < most_load)).select("agent_id", "load")


def average_exposure(findings: DataFrame, intel: DataFrame) -> DataFrame:
    """findings: group, address -> group, average: known exposures over the number of addresses, 0 where none is known."""
    both = findings.join(intel, "address", "left").groupBy("group")
    return both.agg((F.sum(F.coalesce("exposure", F.lit(0.0))) / F.count("address")).alias("average")).select("group", F.coalesce("average", F.lit(0.0)).alias("average"))
