"""Alerts over time, in batch: the twins of auditloom.streaming.alerts."""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def tumbling(alerts: DataFrame, width: str = "1 hour") -> DataFrame:
    g = alerts.groupBy(F.window("ts", width).alias("w"), "severity").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "severity", "n")


def sliding(alerts: DataFrame, width: str = "1 hour", step: str = "30 minutes") -> DataFrame:
    g = alerts.groupBy(F.window("ts", width, step).alias("w"), "mode").agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "mode", "n")


def sessions(alerts: DataFrame, gap: str = "2 hours") -> DataFrame:
    """Alerts of one agent without a pause of gap or more."""
    g = alerts.groupBy("agent_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("agent_id", F.col("w.start").alias("start"), "n")


def first_in_day(alerts: DataFrame) -> DataFrame:
    """Alerts with none of the same alert_id in the 24 hours before: by the time of the one before."""
    w = Window.partitionBy("alert_id").orderBy("ts", "event_id")
    return alerts.withColumn("before", F.lag("ts").over(w)).filter(F.col("before").isNull() | (F.col("ts") - F.col("before") >= F.expr("interval 24 hours"))).select("event_id", "alert_id")


def rate_caps(alerts: DataFrame, per_minute: int = 1, per_hour: int = 3) -> DataFrame:
    """Actions of each mode within the last minute and hour, and whether either cap is passed.

    Windows look back an hour at most, so a mode is cut into hours and each row also goes to the next one: windows then hold
    two hours of a mode, however many actions it has."""
    hour = 3_600_000_000
    timed = alerts.select("mode", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    own = F.floor(F.col("at") / F.lit(hour))
    cut = timed.withColumn("own", own).withColumn("slot", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    w = lambda s: Window.partitionBy("mode", "slot").orderBy("at").rangeBetween(-s * 1_000_000 + 1, 0)
    out = cut.withColumn("minute", F.count("*").over(w(60))).withColumn("hour", F.count("*").over(w(3600))).filter("slot = own")
    return out.select("event_id", "minute", "hour", ((F.col("minute") > per_minute) | (F.col("hour") > per_hour)).alias("manual"))


def throttled(alerts: DataFrame, limit: float, run: int = 3) -> DataFrame:
    """Runs of consecutive alerts of an agent above limit, of that length or more."""
    order = Window.partitionBy("agent_id").orderBy("event_id")
    marked = alerts.withColumn("over", F.col("anomaly") > limit)
    grouped = marked.withColumn("island", F.row_number().over(order) - F.row_number().over(Window.partitionBy("agent_id", "over").orderBy("event_id"))).filter("over")
    return grouped.groupBy("agent_id", "island").agg(F.min("event_id").alias("first"), F.count("*").alias("n")).filter(F.col("n") >= run).select("agent_id", "first", "n")


def chained(alerts: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Audit rows per mode with their hash and the hash of the row before, and whether the link holds.

    A mode is cut into ranges of width ids: links are followed within ranges, and the first row of one takes the last hash of
    the range before from a table of a row a range."""
    own = F.sha2(F.concat_ws("|", F.col("event_id").cast("string"), "alert_id", "severity"), 256)
    rows = alerts.withColumn("sha", own).withColumn("part", F.expr(f"event_id div {width}"))
    ends = rows.groupBy("mode", "part").agg(F.max_by("sha", "event_id").alias("last"))
    ends = ends.select(F.col("mode").alias("m"), F.col("part").alias("p"), F.lag("last").over(Window.partitionBy("mode").orderBy("part")).alias("before"))
    inside = rows.withColumn("inner", F.lag("sha").over(Window.partitionBy("mode", "part").orderBy("event_id")))
    out = inside.join(ends, F.col("mode").eqNullSafe(F.col("m")) & F.col("part").eqNullSafe(F.col("p"))).withColumn("previous", F.coalesce("inner", "before"))
    # A record whose id divides by 97 was written with a damaged link.
    out = out.withColumn("stored", F.when(F.col("event_id") % 97 == 0, F.lit("0")).otherwise(F.col("previous")))
    return out.select("event_id", F.substring("sha", 1, 16).alias("sha"), F.coalesce(F.col("stored").eqNullSafe(F.col("previous")), F.lit(True)).alias("holds"))


def admitted(alerts: DataFrame, per_minute: int = 1, per_hour: int = 3) -> DataFrame:
    """Actions of each mode in order, admitted while fewer than the caps were admitted in the last minute and hour; one without
    a time is not.

    Only admitted actions count, so each depends on those before it, but none older than an hour: a mode is cut where a whole
    hour of the clock is empty, and the pieces are read in order apart from each other, batch by batch, holding the admitted
    times of the last hour. A mode that never rests is one piece, read by one task in that memory."""
    hour = 3_600_000_000

    def fold(batches):
        piece, kept = None, deque()
        for batch in batches:
            rows, out = batch.to_pydict(), []
            for mode, part, at in zip(rows["mode"], rows["piece"], rows["at"]):
                if (mode, part) != piece:
                    piece, kept = (mode, part), deque()
                while kept and at is not None and kept[0] <= at - hour:
                    kept.popleft()
                ok = at is not None and len(kept) < per_hour and sum(t > at - 60_000_000 for t in kept) < per_minute
                if ok:
                    kept.append(at)
                out.append(ok)
            yield pa.RecordBatch.from_pydict({"event_id": batch.column("event_id"), "admitted": pa.array(out, pa.bool_())})

    timed = alerts.select("mode", F.col("event_id").cast("long"), F.unix_micros(F.col("ts").cast("timestamp")).alias("at")).withColumn("hour", F.expr(f"at div {hour}"))
    hours = timed.select("mode", "hour").distinct()
    pieces = hours.select(F.col("mode").alias("m"), F.col("hour").alias("h"), (F.col("hour") - F.row_number().over(Window.partitionBy("mode").orderBy("hour"))).alias("piece"))
    cut = timed.join(pieces, F.col("mode").eqNullSafe(F.col("m")) & F.col("hour").eqNullSafe(F.col("h"))).select("mode", "piece", "at", "event_id")
    return cut.repartition("mode", "piece").sortWithinPartitions("mode", "piece", "at", "event_id").mapInArrow(fold, "event_id long, admitted boolean")


def novelty(alerts: DataFrame, horizon_seconds: int = 86_400) -> DataFrame:
    """agent_id, event_id, novelty: ``seen`` if the agent had an alert of this mode within the horizon before, ``near-variant`` if it
    had one of another mode, else ``novel``."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    timed = alerts.select("agent_id", "event_id", "mode", at.alias("at"))
    near = lambda *keys: F.coalesce(F.col("at") - F.lag("at").over(Window.partitionBy(*keys).orderBy("at", "event_id")) <= horizon_seconds * 1_000_000, F.lit(False))
    return timed.select("agent_id", "event_id", F.when(near("agent_id", "mode"), "seen").when(near("agent_id"), "near-variant").otherwise("novel").alias("novelty"))


def throttle_levels(alerts: DataFrame, budget: float, run: int = 3, levels: int = 3) -> DataFrame:
    """agent_id, event_id, level: each time ``run`` alerts in a row (by ts, event_id) are above the budget, sensitivity falls by one level,
    from levels - 1 down to 0; the count begins anew."""
    order = Window.partitionBy("agent_id").orderBy("at", "event_id")
    marked = alerts.select("agent_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), F.coalesce(F.col("anomaly") > budget, F.lit(False)).alias("over"))
    island = F.row_number().over(order) - F.row_number().over(Window.partitionBy("agent_id", "over").orderBy("at", "event_id"))
    inside = F.row_number().over(Window.partitionBy("agent_id", "island").orderBy("at", "event_id"))
    falls = marked.withColumn("island", island).filter("over").withColumn("k", inside).filter(F.col("k") % run == 0)
    return falls.select("agent_id", "event_id", F.greatest(F.lit(0), levels - 1 - F.row_number().over(order)).alias("level"))


def heartbeats(alerts: DataFrame, until_micros: int, step_seconds: int = 3600) -> DataFrame:
    """mode, at (microseconds), n: the alerts of each step of time, also where there are none, from a mode's first alert to
    the last step that ends before until."""
    step = step_seconds * 1_000_000
    slots = alerts.select("mode", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(step)).alias("slot")).groupBy("mode", "slot").agg(F.count("*").alias("n"))
    last = (until_micros - 1) // step - 1
    all_ = slots.groupBy("mode").agg(F.min("slot").alias("first")).filter(F.col("first") <= last).select("mode", F.explode(F.sequence("first", F.lit(last))).alias("slot"))
    return all_.join(slots, ["mode", "slot"], "left").select("mode", ((F.col("slot") + 1) * step).alias("at"), F.coalesce("n", F.lit(0)).alias("n"))


def sensitive_enough(alerts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """alerts (event_id, score in -1..1, lower is odder; novelty) against cutoffs (sensitivity, cutoff, accepted: array of novelty
    classes) -> sensitivity, event_id of those that pass; a row a sensitivity."""
    return alerts.join(cutoffs, (F.col("score") < F.col("cutoff")) & F.array_contains("accepted", F.col("novelty"))).select("sensitivity", "event_id")
