"""Votes on findings: aggregates, status, debate quality, and what debaters' texts say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditloom.functions.catalogs import REASONING_WORDS
from auditloom.functions.text import any_of

THRESHOLD = 0.67


def aggregate(votes: DataFrame) -> DataFrame:
    """Per finding: counts, the result (more true than false), the winners' share, whether that reaches the threshold."""
    g = votes.groupBy("finding_id").agg(F.count("*").alias("n"), F.count_if("vote").alias("n_true"))
    result = F.col("n_true") > F.col("n") - F.col("n_true")
    share = F.when(result, F.col("n_true")).otherwise(F.col("n") - F.col("n_true")) / F.col("n")
    return g.withColumn("result", result).withColumn("confidence", share).withColumn("consensus", F.col("confidence") >= THRESHOLD)


def weighted(votes: DataFrame) -> DataFrame:
    """Per finding the weights of either side; strictly more for true wins; null share where all weights are 0."""
    side = lambda v: F.coalesce(F.sum(F.when(F.col("vote") == v, F.col("weight"))), F.lit(0))
    g = votes.groupBy("finding_id").agg(side(True).alias("w_true"), side(False).alias("w_false"))
    return g.withColumn("result", F.col("w_true") > F.col("w_false")).withColumn("confidence", F.try_divide(F.greatest("w_true", "w_false"), F.col("w_true") + F.col("w_false")))


def personas(votes: DataFrame) -> DataFrame:
    return votes.groupBy("persona").agg(F.count("*").alias("total"), F.count_if("vote").alias("n_true"), F.count_if(~F.col("vote")).alias("n_false"))


def status(votes: DataFrame) -> DataFrame:
    """Per finding: share of true votes, result at the threshold, the agreeing share, and the status that follows."""
    g = votes.groupBy("finding_id").agg(F.avg(F.col("vote").cast("double")).alias("share"))
    result = F.col("share") >= THRESHOLD
    agreeing = F.when(result, F.col("share")).otherwise(1 - F.col("share"))
    g = g.withColumn("result", result).withColumn("confidence", agreeing)
    return g.withColumn("status", F.when(F.col("result") & (F.col("confidence") >= THRESHOLD), "validated").when(~F.col("result") & (F.col("confidence") >= THRESHOLD), "false_positive").otherwise("unconfirmed"))


def panel(votes: DataFrame) -> DataFrame:
    """FOR against AGAINST, without abstentions; nobody voting is no validation."""
    g = votes.groupBy("finding_id").agg(F.count_if(F.col("stance") == "FOR").alias("n_for"), F.count_if(F.col("stance") == "AGAINST").alias("n_against"), F.count_if(F.col("stance") == "ABSTAIN").alias("n_abstain"))
    ratio = F.try_divide(F.col("n_for"), F.col("n_for") + F.col("n_against"))
    return g.withColumn("ratio", F.coalesce(ratio, F.lit(0.0))).withColumn("validated", F.coalesce(ratio >= THRESHOLD, F.lit(False)))


def two_round(votes: DataFrame, judge_line: int = 1) -> DataFrame:
    """Panel with a judge: the others' FOR share reaches the threshold and a judge is FOR."""
    judge = F.col("line") == judge_line
    g = votes.groupBy("finding_id").agg(F.count_if(~judge & (F.col("stance") == "FOR")).alias("n_for"), F.count_if(~judge).alias("n_panel"), F.max(F.when(judge, (F.col("stance") == "FOR").cast("int"))).alias("judge_for"))
    ok = (F.coalesce(F.try_divide(F.col("n_for"), F.col("n_panel")), F.lit(0.0)) >= THRESHOLD) & (F.coalesce(F.col("judge_for"), F.lit(0)) == 1)
    return g.withColumn("validated", ok)


def quality(answers: DataFrame, key: str) -> DataFrame:
    """Mean over a debate's answers of detail (500 characters) and reasoning words (three)."""
    text = F.coalesce("response", F.lit(""))
    detail = F.least(F.lit(1.0), F.length(text) / 500)
    reasons = F.least(F.lit(1.0), F.size(any_of(text, REASONING_WORDS)) / 3)
    return answers.groupBy(key).agg(F.count("*").alias("n"), F.avg((detail + reasons) / 2).alias("quality"))


def consistency(votes: DataFrame) -> DataFrame:
    """The majority's share of a finding's votes."""
    g = votes.groupBy("finding_id").agg(F.count_if("vote").alias("t"), F.count("*").alias("n"))
    return g.select("finding_id", (F.greatest("t", F.col("n") - F.col("t")) / F.col("n")).alias("consistency"))


def parse_vote(response: Column) -> tuple[Column, Column, Column]:
    """vote, confidence, reasoning of an answer: of lines that begin with each word the last valid one; confidence in [0, 1]."""
    lines = F.transform(F.split(response, "\n", -1), lambda x: F.trim(x))
    after = lambda word: F.transform(F.filter(lines, lambda x: x.startswith(word)), lambda x: F.trim(F.substring(x, len(word) + 1, 1 << 30)))
    votes = F.filter(F.transform(after("VOTE:"), lambda v: F.upper(v)), lambda v: v.isin("FOR", "AGAINST", "ABSTAIN"))
    numbers = F.filter(F.transform(after("CONFIDENCE:"), lambda c: c.try_cast("double")), lambda c: c.isNotNull())
    vote = F.coalesce(F.try_element_at(votes, F.lit(-1)), F.lit("ABSTAIN"))
    confidence = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_element_at(numbers, F.lit(-1)))), F.lit(0.5))
    return vote, confidence, F.coalesce(F.try_element_at(after("REASONING:"), F.lit(-1)), response)
