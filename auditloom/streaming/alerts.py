"""Structured Streaming over alerts. ``ts`` must be a timestamp with a zone (cast TIMESTAMP_NTZ under UTC)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def alerts(events: DataFrame) -> DataFrame:
    """The binding of the events table, as a stream."""
    severity = F.element_at(F.array(*map(F.lit, ("low", "medium", "high", "critical"))), (F.col("event_id") % 4 + 1).cast("int"))
    return events.select("event_id", F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("alert_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("mode"), severity.alias("severity"), F.col("value").alias("anomaly"), F.col("user_id").alias("agent_id"))


def dedupe(stream: DataFrame, horizon: str = "24 hours") -> DataFrame:
    """One alert an id while its state lives: at least horizon of event time."""
    return stream.withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["alert_id"])


def tumbling(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    g = stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "severity").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "severity", "n")


def sessions(stream: DataFrame, gap: str = "2 hours", late: str = "10 minutes") -> DataFrame:
    g = stream.withWatermark("ts", late).groupBy("agent_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("agent_id", F.col("w.start").alias("start"), "n")


def agent_counters(stream: DataFrame) -> DataFrame:
    """Running counters by agent and kind; for update or complete mode."""
    return stream.groupBy("agent_id", "mode").agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is there now, into Parquet, exactly once."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path).awaitTermination()


def admit(stream: DataFrame, per_minute: int = 1, per_hour: int = 3) -> DataFrame:
    """event_id, mode, admitted: the caps of ``telemetry.admitted`` on a stream; a mode's state is its admitted times of the
    last hour. Events of one batch are taken in the order of time."""

    def fold(key, batches, state):
        kept = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(batches)).sort_values(["at", "event_id"])
        out = []
        for event, at in zip(rows["event_id"], rows["at"]):
            kept = [t for t in kept if t > at - 3_600_000_000]
            ok = len(kept) < per_hour and sum(t > at - 60_000_000 for t in kept) < per_minute
            if ok:
                kept.append(int(at))
            out.append((event, key[0], ok))
        state.update((kept,))
        yield pd.DataFrame(out, columns=["event_id", "mode", "admitted"])

    timed = stream.select("mode", "event_id", F.unix_micros("ts").alias("at"))
    return timed.groupBy("mode").applyInPandasWithState(fold, "event_id long, mode string, admitted boolean", "kept array<long>", "append", GroupStateTimeout.NoTimeout)
