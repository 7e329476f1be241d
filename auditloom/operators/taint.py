"""Flows of tainted data from sources to sinks within a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.catalogs import SANITIZERS, frame
from auditloom.functions.taint_rules import EXTENSION, FLOW_CLASSES, NATIVE, SINKS, SOURCES
from auditloom.functions.text import choose, line_of, matches

Rules = dict[str, dict[str, list[str]]]


def open_flows(files: DataFrame, sources: Rules, sinks: Rules) -> DataFrame:
    """files: file_id, lang, content -> file_id, lang, source, sink, source_at, sink_at, source_line, sink_line of every source and later
    sink of a file without a sanitizer that begins and ends between them.

    A text is read where its hits are found and goes no further. Between two places lies a sanitizer if and only if the first
    one that begins after the source ends before the sink, so each source has one limit, by a look ahead along the
    file, and meets the sinks before it."""
    spark = files.sparkSession
    rows = [(lang, role, kind, p) for role, rules in (("source", sources), ("sink", sinks)) for lang, kinds in rules.items() for kind, ps in kinds.items() for p in ps]
    rules = frame(spark, "lang string, role string, kind string, pattern string", rows + [(lang, "sanitizer", "", "(?i)" + "|".join(SANITIZERS)) for lang in sources])
    text = F.col("content")
    hit = files.select("file_id", "lang", "content").join(F.broadcast(rules), "lang").select("file_id", "lang", "role", "kind", "content", F.explode(matches(text, F.col("pattern"))).alias("m"))
    hit = hit.select("file_id", "lang", "role", "kind", F.col("m.start").alias("at"), F.col("m.end").alias("end"), F.when(F.col("role") != "sanitizer", line_of(text, F.col("m.start"))).alias("line"))
    later = Window.partitionBy("file_id").orderBy("at").rangeBetween(0, Window.unboundedFollowing)
    limit = F.min(F.when(F.col("role") == "sanitizer", F.col("end"))).over(later)
    placed = hit.withColumn("limit", F.coalesce(limit, F.lit(2**31 - 1)))
    one = placed.filter("role = 'source'").select("file_id", "lang", F.col("kind").alias("source"), F.col("at").alias("source_at"), F.col("line").alias("source_line"), "limit")
    two = placed.filter("role = 'sink'").select("file_id", F.col("kind").alias("sink"), F.col("at").alias("sink_at"), F.col("line").alias("sink_line"))
    return one.join(two, "file_id").filter("sink_at > source_at AND sink_at < limit").select("file_id", "lang", "source", "sink", "source_at", "sink_at", "source_line", "sink_line")


def classified(source: Column, sink: Column) -> Column:
    pair = F.concat_ws(">", source, sink)
    return choose(pair, {f"{a}>{b}": v for (a, b), v in FLOW_CLASSES.items()}, "Unsanitized Data Flow")


def flows(files: DataFrame) -> DataFrame:
    """open_flows() of four languages with the flow's class, whether the file has a native boundary, and a confidence that falls by a
    thousandth a character between source and sink, from 1 to 0.3."""
    native = F.lit("none")
    for lang, patterns in NATIVE.items():
        native = F.when((F.col("lang") == lang) & F.col("content").rlike("|".join(patterns)), f"{EXTENSION[lang]}->native").otherwise(native)
    marked = files.select("file_id", native.alias("boundary"))
    found = open_flows(files, SOURCES, SINKS).join(marked, "file_id")
    confidence = F.least(F.lit(1.0), F.greatest(F.lit(0.3), 1 - (F.col("sink_at") - F.col("source_at")) / 1000))
    return found.withColumn("vulnerability", classified(F.col("source"), F.col("sink"))).withColumn("confidence", confidence)


def flow_summary(found: DataFrame) -> DataFrame:
    """By boundary, by class and in all ('*'): flows, those of a confidence of 0.7 or more, those across a boundary."""
    boundary, kind = F.col("boundary"), F.col("vulnerability")
    sums = found.groupingSets([[boundary], [kind], []], boundary, kind).agg(F.count("*").alias("n"), F.count_if(F.col("confidence") >= 0.7).alias("high"), F.count_if(boundary != "none").alias("crossing"))
    return sums.select(*[F.coalesce(c, F.lit("*")).alias(c) for c in ("boundary", "vulnerability")], "n", "high", "crossing").filter("n > 0")
