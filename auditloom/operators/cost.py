"""Cost ledgers (integer cents) and budgets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stage_costs(costs: DataFrame) -> DataFrame:
    return costs.groupBy("stage").agg(F.sum("cents").alias("cents"), F.count("*").alias("requests"), F.count_distinct("model").alias("models"))


def model_costs(costs: DataFrame) -> DataFrame:
    """Stages by models, one column a model."""
    return costs.groupBy("stage").pivot("model", ["small", "medium", "large"]).agg(F.sum("cents"))


def running(costs: DataFrame, total: int) -> DataFrame:
    """Per run the running sum, what remains, and whether the charge fits: exact up to the first one that doesn't."""
    w = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    out = costs.withColumn("spent", F.sum("cents").over(w))
    return out.select("run_id", "seq", "spent", F.greatest(F.lit(0), total - F.col("spent")).alias("remaining"), (F.col("spent") <= total).alias("fits"))


def fold(costs: DataFrame, total: int, stage_limits: dict[str, int]) -> DataFrame:
    """Charges in order: one that would exceed the total is refused and marks the budget exceeded, one that would exceed its
    stage's limit is refused. A charge without cents is one of 0.

    What is accepted depends on all before it, so one task reads a run in order; it holds sums and a batch, never the run."""

    def folded(batches):
        at, spent, by, exceeded = None, 0, {}, False
        for batch in batches:
            rows, accepted, sums, flags = batch.to_pydict(), [], [], []
            for run, stage, cents in zip(rows["run_id"], rows["stage"], rows["cents"]):
                if (run,) != at:
                    at, spent, by, exceeded = (run,), 0, {}, False
                ok = spent + cents <= total
                exceeded |= not ok
                ok = ok and (stage not in stage_limits or by.get(stage, 0) + cents <= stage_limits[stage])
                if ok:
                    spent += cents
                    by[stage] = by.get(stage, 0) + cents
                accepted.append(ok)
                sums.append(spent)
                flags.append(exceeded)
            yield pa.RecordBatch.from_pydict({"run_id": batch.column("run_id"), "seq": batch.column("seq"), "accepted": pa.array(accepted, pa.bool_()), "spent": pa.array(sums, pa.int64()), "exceeded": pa.array(flags, pa.bool_())})

    charges = costs.select(F.col("run_id").cast("long"), F.col("seq").cast("long"), "stage", F.coalesce(F.col("cents").cast("long"), F.lit(0)).alias("cents"))
    return charges.repartition("run_id").sortWithinPartitions("run_id", "seq").mapInArrow(folded, "run_id long, seq long, accepted boolean, spent long, exceeded boolean")


def utilisation(costs: DataFrame, budget: int) -> DataFrame:
    g = costs.agg(F.sum("cents").alias("cents"), F.count("*").alias("requests"))
    return g.select("cents", "requests", (F.col("cents") / budget).alias("used"), F.greatest(F.lit(0), budget - F.col("cents")).alias("remaining"))


def agent_metrics(events: DataFrame) -> DataFrame:
    """Counters of each agent by kind of event, and its last value."""
    n = lambda kind: F.count_if(F.col("mode") == kind).alias(f"n_{kind}")
    return events.groupBy("agent_id").agg(n("purchase"), n("signup"), n("error"), n("view"), n("click"), F.max_by("anomaly", "event_id").alias("last_value"))
