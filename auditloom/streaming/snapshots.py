"""Counters that survive restarts: a snapshot an epoch, written once whatever is replayed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, key string, n long"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def last_epoch(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The last complete epoch (before a given one): an epoch is complete once its mark is written, after its snapshot."""
    marks = _read(spark, f"{path}/done", "epoch long")
    return (marks if before is None else marks.filter(F.col("epoch") < before)).agg(F.max("epoch")).first()[0]


def load(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """kind, key, n of the last complete epoch; empty if there is none."""
    epoch = last_epoch(spark, path, before)
    return spark.createDataFrame([], SCHEMA) if epoch is None else spark.read.schema(SCHEMA).parquet(f"{path}/state/epoch={epoch}")


def counts(batch: DataFrame, columns: list[str]) -> DataFrame:
    """kind, key, n: how often each value of each column occurs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("key")) for c in columns])).alias("p")
    return batch.select(pairs).select("p.*").filter("key is not null").groupBy("kind", "key").agg(F.count("*").alias("n"))


def saver(path: str, columns: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: adds a batch's counts to the last snapshot before its epoch and writes them as the epoch's own. A complete
    epoch is left alone and one that broke off is written anew from the same snapshot, so a replayed batch changes nothing."""

    def save(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        if not _read(spark, f"{path}/done", "epoch long").filter(F.col("epoch") == epoch).isEmpty():
            return
        total = load(spark, path, epoch).unionByName(counts(batch, columns)).groupBy("kind", "key").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{path}/state/epoch={epoch}")
        spark.range(1).select(F.lit(epoch).cast("long").alias("epoch")).write.mode("append").parquet(f"{path}/done")

    return save


def history(spark: SparkSession, path: str) -> DataFrame:
    """epoch, kind, key, n of all complete epochs."""
    done = _read(spark, f"{path}/done", "epoch long").distinct()
    return spark.read.schema(f"{SCHEMA}, epoch long").parquet(f"{path}/state").join(F.broadcast(done), "epoch", "left_semi").select("epoch", "kind", "key", "n")
