"""Streams of reordered alerts against their batch twins over closed time."""

import datetime
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from auditloom.operators import telemetry
from auditloom.streaming import alerts as streaming
from auditloom.streaming import detect

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
SCHEMA = "event_id long, alert_id string, ts timestamp, mode string, anomaly double, agent_id long"


@pytest.fixture(scope="module")
def arrivals(spark):
    """Alerts of nine days in five files, each a span of time of which neighbours overlap by half the delay; rows are shuffled."""
    detect.stateful(spark)
    r = random.Random(12)
    times = sorted(r.choice([0, 1, 2, 5, 6, 8]) * 86_400 + r.random() * 40_000 for _ in range(300))
    rows = [(i, f"a{r.randint(0, 25)}", START + datetime.timedelta(seconds=t), r.choice("xyz"), r.choice([5.0, 50.0, 60.0, None]), r.randint(0, 4)) for i, t in enumerate(times)]
    rows += [(900 + k, f"a{k}", START + datetime.timedelta(days=10), "x", 99.0, k) for k in range(2)]  # moves the watermark past the others
    folder = tempfile.mkdtemp()
    order = sorted(rows, key=lambda x: x[2].timestamp() + r.random() * 1500)
    size = len(order) // 5 + 1
    for k in range(0, len(order), size):
        part = order[k : k + size]
        r.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder + "/in")
    return folder, spark.createDataFrame(rows, SCHEMA)


def closed(spark, arrivals, make, name):
    folder, _ = arrivals
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        streaming.run_once(make(stream), f"{folder}/{name}", f"{folder}/{name}-c")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark.read.parquet(f"{folder}/{name}").collect()


LATE = "30 minutes"
MARK = START + datetime.timedelta(days=10) - datetime.timedelta(minutes=30)


def before(batch):
    return batch.filter(F.col("event_id") < 900)


def test_once_a_day(spark, arrivals):
    got = closed(spark, arrivals, lambda s: detect.once_a_day(s, LATE), "once")
    want = before(telemetry.first_in_day(arrivals[1])).collect()
    assert sorted((r["event_id"], r["alert_id"]) for r in got) == sorted((r["event_id"], r["alert_id"]) for r in want) and 50 < len(want) < 290


def test_novelty(spark, arrivals):
    got = closed(spark, arrivals, lambda s: detect.novelty(s, late=LATE), "novelty")
    want = before(telemetry.novelty(arrivals[1])).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r["novelty"] for r in want} == {"seen", "near-variant", "novel"}


def test_throttle(spark, arrivals):
    got = closed(spark, arrivals, lambda s: detect.throttle(s, 20.0, late=LATE), "throttle")
    want = before(telemetry.throttle_levels(arrivals[1], 20.0)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and {r["level"] for r in want} == {0, 1}


def test_heartbeat(spark, arrivals):
    got = closed(spark, arrivals, lambda s: detect.heartbeat(s, 6 * 3600, LATE), "beats")
    mark = int(MARK.timestamp() * 1_000_000)
    want = telemetry.heartbeats(before(arrivals[1]), mark, 6 * 3600).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert sum(r["n"] == 0 for r in want) > 10 and sum(r["n"] for r in want) > 280
