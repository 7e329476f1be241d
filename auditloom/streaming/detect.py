"""Detection over a stream in the order of event time: exact de-duplication, novelty, throttling, heartbeats.

Rows may come in any order within the watermark's delay. A key holds its rows until the watermark has passed them (event-time
timers), takes them in the order of (ts, event_id) and keeps a small memory, so the result over closed time is that of the
batch twin whatever the order of arrival. Later rows than the watermark allows are dropped by Spark. The state needs the
RocksDB provider (``stateful`` sets it); a memory that is no longer needed is cleared by a timer of its own."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

MICRO = 1_000_000
DAY = 24 * 3600 * MICRO
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: A fold takes a memory (None at first) and rows in order, and gives the new memory, rows to emit, and the time in
#: microseconds at which the memory may be forgotten (None: never).
Fold = Callable[[dict | None, list[dict]], tuple[dict, list[tuple], int | None]]


def stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class InOrder(StatefulProcessor):
    """Holds rows until the watermark has passed them, then folds them in order."""

    def __init__(self, fold: Fold, columns: list[str], out: list[str]):
        self.fold, self.columns, self.out = fold, columns, out

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "row string")
        self.memory = handle.getValueState("memory", "value string, until long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            records = part[self.columns].to_dict("records")
            self.waiting.appendList([(json.dumps(r, default=_plain),) for r in records])
            for at in {int(r["at"]) // 1000 + 1 for r in records}:
                self.handle.registerTimer(at)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [json.loads(r[0]) for r in self.waiting.get()]
        ready = sorted((r for r in rows if r["at"] < closed), key=lambda r: (r["at"], r["event_id"]))
        held = self.memory.get() if self.memory.exists() else None
        if not ready:
            if held is not None and held[1] is not None and held[1] < closed:
                self.memory.clear()
            return
        left = [r for r in rows if r["at"] >= closed]
        self.waiting.put([(json.dumps(r),) for r in left]) if left else self.waiting.clear()
        memory = json.loads(held[0]) if held is not None and (held[1] is None or held[1] >= ready[0]["at"]) else None
        memory, found, until = self.fold(memory, ready)
        self.memory.update((json.dumps(memory), until))
        if until is not None:
            self.handle.registerTimer(until // 1000 + 2)
        if found:
            yield pd.DataFrame([(*key, *r) for r in found], columns=self.out)

    def close(self) -> None:
        pass


def _plain(x):
    return x.item() if hasattr(x, "item") else str(x)


def _ordered(stream: DataFrame, keys: list[str], columns: list[str], fold: Fold, out: str, late: str) -> DataFrame:
    timed = stream.withWatermark("ts", late).withColumn("at", F.unix_micros("ts"))
    names = [c.split()[0] for c in out.split(", ")]
    return timed.groupBy(*keys).transformWithStateInPandas(InOrder(fold, ["at", "event_id", *columns], names), out, "append", "EventTime")


def once_a_day(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """alert_id, event_id of alerts with none of the same id in the 24 hours before: telemetry.first_in_day of a stream."""

    def fold(memory, rows):
        last, found = (memory or {}).get("last"), []
        for r in rows:
            if last is None or r["at"] - last >= DAY:
                found.append((r["event_id"],))
            last = r["at"]
        return {"last": last}, found, last + DAY

    return _ordered(stream, ["alert_id"], [], fold, "alert_id string, event_id long", late)


def novelty(stream: DataFrame, horizon: int = DAY, late: str = "10 minutes") -> DataFrame:
    """agent_id, event_id, novelty: ``seen`` if the agent had an alert of this mode within the horizon before, ``near-variant`` if it had one
    of another mode, else ``novel``: telemetry.novelty of a stream. What the horizon has passed is forgotten."""

    def fold(memory, rows):
        last, found = dict(memory or {}), []
        for r in rows:
            last = {m: t for m, t in last.items() if r["at"] - t <= horizon}
            found.append((r["event_id"], "seen" if r["mode"] in last else "near-variant" if last else "novel"))
            last[r["mode"]] = r["at"]
        return last, found, max(last.values()) + horizon

    return _ordered(stream, ["agent_id"], ["mode"], fold, "agent_id long, event_id long, novelty string", late)


def throttle(stream: DataFrame, budget: float, run: int = 3, levels: int = 3, late: str = "10 minutes") -> DataFrame:
    """agent_id, event_id, level: after each run iterations above the budget in a row sensitivity falls by one level, from
    levels - 1 down to 0: telemetry.throttle_levels of a stream."""

    def fold(memory, rows):
        m, found = memory or {"over": 0, "level": levels - 1}, []
        for r in rows:
            m["over"] = m["over"] + 1 if r["anomaly"] is not None and r["anomaly"] > budget else 0
            if m["over"] == run:
                m = {"over": 0, "level": max(0, m["level"] - 1)}
                found.append((r["event_id"], m["level"]))
        return m, found, None

    return _ordered(stream, ["agent_id"], ["anomaly"], fold, "agent_id long, event_id long, level int", late)


class Beats(StatefulProcessor):
    """A row at the end of each step of event time from a key's first row on, with the rows of the step, also where there are none."""

    def __init__(self, step: int):
        self.step = step  # milliseconds

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "slot long", "n long")
        self.next = handle.getValueState("next", "slot long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        slots: dict[int, int] = {}
        for part in rows:
            for at in part["at"]:
                slots[int(at) // 1000 // self.step] = slots.get(int(at) // 1000 // self.step, 0) + 1
        for slot, n in slots.items():
            self.counts.updateValue((slot,), ((self.counts.getValue((slot,))[0] if self.counts.containsKey((slot,)) else 0) + n,))
        first = min(slots)
        # Before its first timer a key may still learn of an earlier row; later on, earlier rows are late and never come.
        if not self.next.exists() or first < self.next.get()[0]:
            if self.next.exists():
                self.handle.deleteTimer((self.next.get()[0] + 1) * self.step + 1)
            self.next.update((first,))
            self.handle.registerTimer((first + 1) * self.step + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slot, closed, out = self.next.get()[0], timerValues.getCurrentWatermarkInMs(), []
        while (slot + 1) * self.step < closed:
            n = self.counts.getValue((slot,))[0] if self.counts.containsKey((slot,)) else 0
            if n:
                self.counts.removeKey((slot,))
            out.append((*key, (slot + 1) * self.step * 1000, n))
            slot += 1
        self.next.update((slot,))
        self.handle.registerTimer((slot + 1) * self.step + 1)
        if out:
            yield pd.DataFrame(out, columns=["mode", "at", "n"])

    def close(self) -> None:
        pass


def heartbeat(stream: DataFrame, step_seconds: int = 3600, late: str = "10 minutes") -> DataFrame:
    """mode, at (microseconds), n: a heartbeat of every mode at the end of each step once the watermark has passed it, whether
    or not anything came: telemetry.heartbeats of a stream."""
    timed = stream.withWatermark("ts", late).withColumn("at", F.unix_micros("ts"))
    return timed.groupBy("mode").transformWithStateInPandas(Beats(step_seconds * 1000), "mode string, at long, n long", "append", "EventTime")
