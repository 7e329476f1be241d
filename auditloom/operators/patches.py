"""Classes of patches and described bugs, and the code that shows them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import frame
from auditloom.functions.patch_rules import DESCRIBED, KNOWN, PATCH_CLASSES
from auditloom.functions.text import matches
from auditloom.operators.extract import class_scores


def classify(patches: DataFrame) -> DataFrame:
    """patches: patch_id, description, pre, post -> with bug_class and score: the class with most matches of its patterns in the
    lower-cased text of all three, the first of equals (also where nothing matches)."""
    text = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in ("description", "pre", "post"))))
    best = class_scores(text, {k: [f"(?i){p}" for p in ps] for k, ps in PATCH_CLASSES.items()})
    return patches.withColumn("best", best).select("*", "best.bug_class", "best.score").drop("best")


def contexts(classified: DataFrame, most: int = 5, around: int = 50) -> DataFrame:
    """patch_id, place (from 1), context: the code before the patch around the first matches of its class's patterns, one pattern
    after the other, without blanks at both ends."""
    rules = [(k, i, f"(?i){p}") for k, ps in PATCH_CLASSES.items() for i, p in enumerate(ps)]
    catalog = frame(classified.sparkSession, "bug_class string, rule int, pattern string", rules)
    found = classified.select("patch_id", "bug_class", "pre").join(F.broadcast(catalog), "bug_class").select("patch_id", "rule", "pre", matches(F.col("pre"), F.col("pattern")).alias("m"))
    low = lambda m: F.greatest(F.lit(0), m["start"] - around)
    cut = lambda m: F.regexp_replace(F.col("pre").substr(low(m) + 1, m["end"] + around - low(m)), r"^\s+|\s+$", "")
    each = found.filter(F.size("m") > 0).select("patch_id", "rule", F.transform(F.slice("m", 1, most), cut).alias("texts"))
    held = each.groupBy("patch_id").agg(F.array_sort(F.collect_list(F.struct("rule", "texts"))).alias("x"))
    return held.select("patch_id", F.posexplode(F.slice(F.flatten("x.texts"), 1, most)).alias("place", "context")).withColumn("place", F.col("place") + 1)


def described_class(bug_class: Column, description: Column) -> Column:
    """A known class as it is, else the first of the described ones, else logic_error."""
    text = F.lower(F.coalesce(description, F.lit("")))
    holds = lambda words: reduce(lambda a, b: a & b, [F.contains(text, F.lit(w)) for w in words])
    out = F.when(bug_class.isin(*KNOWN), bug_class)
    for name, lists in DESCRIBED:
        out = out.when(reduce(lambda a, b: a | b, map(holds, lists)), name)
    return out.otherwise("logic_error")
