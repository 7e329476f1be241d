"""Rows dealt evenly: equality joins on keys that many rows of both sides share, small rows with much work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of either side that meet in one cell of a hot key.
CELL = 1000
#: Pairs that a task makes, about.
PAIRS = 10_000_000


def cell_join(a: DataFrame, b: DataFrame, key: list[str], of_a: list[str], of_b: list[str], cell: int | None = None) -> DataFrame:
    """Inner join on key. The rows of a hot key are dealt, by the hash of the columns of_a and of_b, into cells where every two
    rows meet once.

    A cell is a few rows but up to cell x cell pairs, so tasks are counted by pairs, not by bytes; only the number of pairs
    reaches the driver."""
    cell = cell or CELL
    sizes = a.groupBy(key).agg(F.count("*").alias("m")).join(b.groupBy(key).agg(F.count("*").alias("n")), key)
    pairs = sizes.agg(F.sum(F.col("m") * F.col("n"))).first()[0] or 0
    tasks = min(20_000, max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs // PAIRS))
    sizes = sizes.filter(F.col("m") * F.col("n") > cell * cell)
    sizes = sizes.select(*key, F.ceil(F.col("m") / cell).alias("p"), F.ceil(F.col("n") / cell).alias("q"))  # a row for cell rows at least; Spark sees at run time whether it is short
    own = lambda c, k: F.pmod(F.xxhash64(*c), F.coalesce(k, F.lit(1)))
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(k), F.lit(1)) - 1))
    a = a.join(sizes, key, "left").withColumn("i", own(of_a, F.col("p"))).withColumn("j", each("q")).drop("p", "q")
    b = b.join(sizes, key, "left").withColumn("j", own(of_b, F.col("q"))).withColumn("i", each("p")).drop("p", "q")
    on = [*key, "i", "j"]
    return a.repartition(tasks, *on).join(b.repartition(tasks, *on), on).drop("i", "j")


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df in as many partitions as the session shuffles into, for rows that are few bytes but much work: a small file is one
    split, and Spark would merge partitions of so few bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
