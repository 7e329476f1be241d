"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary folder if all runs in
    this process (tests), and an error on a cluster, whose executors would each write to a disk of their own."""
    there = spark.sparkContext._jsc.sc().getCheckpointDir()
    if there.isDefined():
        return there.get()
    own = spark.conf.get("spark.checkpoint.dir", None)
    if not own:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        own = tempfile.mkdtemp(prefix="auditloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends there and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
