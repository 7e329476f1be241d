"""Hierarchies of techniques, and techniques of a weakness by the first source that knows any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.functions.storage import materialize


def ancestors(parents: DataFrame) -> DataFrame:
    """parents: node, parent -> node, ancestor, depth of all ancestors, the shortest way where there are several.

    Ways are doubled a round: what a round has found is joined with itself, so the number of rounds is the logarithm of
    the depth. A node on a cycle is its own ancestor. Null ends and loops are left out."""
    now = parents.filter("node is not null and parent is not null and node <> parent").select("node", F.col("parent").alias("ancestor"), F.lit(1).alias("depth")).distinct()
    now = materialize(now, "ancestors")
    state = _state(now)
    while True:
        far = now.alias("a").join(now.alias("b"), F.col("a.ancestor") == F.col("b.node")).select("a.node", "b.ancestor", (F.col("a.depth") + F.col("b.depth")).alias("depth"))
        now = materialize(now.unionByName(far).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")), "ancestors")
        after = _state(now)
        if after == state:
            return now
        state = after


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum("depth")).first())


def subtree_tactics(found: DataFrame, techniques: DataFrame) -> DataFrame:
    """ancestors() and techniques (technique_id, tactic) -> ancestor, tactic, n, deepest: what stands below each technique."""
    below = found.join(techniques.select(F.col("technique_id").alias("node"), F.coalesce("tactic", F.lit("unknown")).alias("tactic")), "node")
    return below.groupBy("ancestor", "tactic").agg(F.count("*").alias("n"), F.max("depth").alias("deepest"))


def catalog_keywords(catalog: DataFrame) -> DataFrame:
    """technique_id, keyword: words of four characters or more in any column of an entry, without punctuation around them."""
    text = F.lower(F.concat_ws(" ", "technique_id", "tactic", "technique", "level_0", "level_1", "definition"))
    words = F.transform(F.split(text, r"\s+"), lambda w: F.btrim(w, F.lit(".,;:\"'")))
    return catalog.filter("technique_id <> ''").select("technique_id", F.explode(words).alias("keyword")).filter(F.length("keyword") >= 4).distinct()


def cwe_techniques(cwes: DataFrame, catalog: DataFrame, keywords: DataFrame, tactics: DataFrame, default: list[str], known: DataFrame, mapped: DataFrame, listed: DataFrame) -> DataFrame:
    """cwe_id, technique_id, source of the distinct weaknesses (cwes: cwe_id).

    The catalog (see catalog_keywords) answers by the weakness's keywords (cwe_id, keyword), and where none of them meets an entry by its
    tactics (cwe_id, tactic; default tactics for weaknesses without any). Where the catalog has nothing the ontology answers: the
    techniques mapped to the weakness (cwe_id, technique_id) that it knows (technique_id). The list (cwe_id, technique)
    adds what is not there yet, always. Weaknesses are compared in upper case with keywords and tactics, and as they are with the other
    two. Each step is a join of those weaknesses that no step before has answered."""
    asked = cwes.filter("cwe_id is not null and cwe_id <> ''").select("cwe_id").distinct().withColumn("upper", F.upper("cwe_id"))
    words = keywords.select(F.col("cwe_id").alias("upper"), "keyword").join(catalog_keywords(catalog), "keyword").select("upper", "technique_id").distinct()
    by_word = materialize(asked.join(words, "upper").select("cwe_id", "technique_id"), "answers")
    rest = asked.join(by_word.select("cwe_id"), "cwe_id", "left_anti")
    hints = rest.join(tactics.select(F.col("cwe_id").alias("upper"), "tactic"), "upper", "left")
    hints = hints.select("cwe_id", F.explode(F.when(F.col("tactic").isNull(), F.array(*map(F.lit, default))).otherwise(F.array("tactic"))).alias("tactic"))
    by_tactic = materialize(hints.join(catalog.filter("technique_id <> ''").select("technique_id", "tactic"), "tactic").select("cwe_id", "technique_id").distinct(), "answers")
    rest = rest.join(by_tactic.select("cwe_id"), "cwe_id", "left_anti")
    by_map = rest.join(mapped.select("cwe_id", "technique_id").distinct(), "cwe_id").join(known.select("technique_id").distinct(), "technique_id").select("cwe_id", "technique_id")
    tagged = lambda df, name: df.select("cwe_id", "technique_id", F.lit(name).alias("source"))
    found = materialize(tagged(by_word, "keyword").unionByName(tagged(by_tactic, "tactic")).unionByName(tagged(by_map, "ontology")), "answers")
    more = asked.join(listed.select("cwe_id", F.col("technique").alias("technique_id")).distinct(), "cwe_id").select("cwe_id", "technique_id")
    return found.unionByName(tagged(more.join(found, ["cwe_id", "technique_id"], "left_anti"), "list"))


def recommendations(attacks: DataFrame, defences: DataFrame, texts: DataFrame) -> DataFrame:
    """attacks (finding_id, tactic, ordinal), defences (finding_id, technique_id, label, tactic, ordinal), texts (tactic, place, text) ->
    finding_id, place (from 1), text: the texts of the attacks' tactics in order, then one a defence; of equal texts the first."""
    one = attacks.join(texts, "tactic").select("finding_id", F.struct(F.lit(0).alias("part"), F.col("ordinal").cast("long").alias("ordinal"), F.col("place").cast("long").alias("place")).alias("at"), "text")
    line = F.concat(F.lit("Apply D3FEND technique "), "technique_id", F.lit(": "), "label", F.lit(" ("), "tactic", F.lit(" tactic)"))
    two = defences.select("finding_id", F.struct(F.lit(1).alias("part"), F.col("ordinal").cast("long").alias("ordinal"), F.lit(0).cast("long").alias("place")).alias("at"), line.alias("text"))
    first = one.unionByName(two).groupBy("finding_id", "text").agg(F.min("at").alias("at"))
    return first.groupBy("finding_id").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("t")).select("finding_id", F.posexplode("t.text").alias("place", "text")).withColumn("place", F.col("place") + 1)
