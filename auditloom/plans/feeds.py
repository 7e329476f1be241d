"""Paged searches, counters over epochs, symbols through SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from auditloom.functions import symbols
from auditloom.functions.storage import shared_dir
from auditloom.plans.registry import register
from auditloom.sources import pages
from auditloom.sources.bindings import cases, table
from auditloom.streaming import snapshots

HOSTS = {"number": "c_custkey", "ip": "c_custkey * 7", "port": "CASE c_custkey % 3 WHEN 0 THEN 22 WHEN 1 THEN 80 ELSE 443 END", "country": cases("c_custkey", ["us", "de", "fr", "jp"])}


def _search(s, d):
    """All hosts through their recorded pages."""
    c = table(s, d, "customer").selectExpr(*[f"{e} AS {k}" for k, e in HOSTS.items()])
    low = c.agg(F.min("number")).first()[0] or 0
    folder = f"{shared_dir(s)}/pages-{uuid.uuid4().hex}"
    pages.record(c.withColumn("number", F.col("number") - low), folder)
    return pages.search(s, folder, "ip long, port long, country string").filter("port = 22")


register("paged_search", _search, f"SELECT ip, CAST(port AS BIGINT) AS port, country FROM (SELECT {', '.join(f'{e} AS {k}' for k, e in HOSTS.items())} FROM customer) WHERE port = 22")
EPOCHS = 4


def _history(s, d):
    """The events in epochs, one of them replayed, through the snapshots of their counters."""
    path = f"{shared_dir(s)}/counters-{uuid.uuid4().hex}"
    save = snapshots.saver(path, ["event_type", "hour"])
    events = table(s, d, "events").selectExpr("event_id", "event_type", "hour(ts) AS hour")
    for epoch in [0, 1, 1, 2, 3]:
        save(events.filter(F.col("event_id") % EPOCHS == epoch), epoch)
    return snapshots.history(s, path)


register(
    "counter_history",
    _history,
    f"WITH e AS (SELECT event_id % {EPOCHS} AS epoch, event_type, CAST(hour(ts) AS VARCHAR) AS h FROM events), c AS (SELECT epoch, 'event_type' AS kind, event_type AS key FROM e UNION ALL SELECT epoch, 'hour', h FROM e) "
    f"SELECT CAST(t.epoch AS BIGINT) AS epoch, kind, key, count(*) AS n FROM range({EPOCHS}) t(epoch) JOIN c ON c.epoch <= t.epoch GROUP BY ALL",
)
# Every third file is broken after its first lines.
SOURCE = "concat('import os, json', chr(10), 'from m', cast(event_id % 5 as string), ' import x', chr(10), '@app.route(\"/\")', chr(10), '@cached', chr(10), 'class C', event_type, ':', chr(10), '  @property', chr(10), '  async def f', cast(event_id % 7 as string), '(self):', chr(10), '    return 1', chr(10), CASE event_id % 3 WHEN 0 THEN 'def broken(' ELSE 'def whole(): pass' END)"


def _symbols(s, d):
    symbols.register(s)
    table(s, d, "events").selectExpr("event_id AS file_id", "event_type AS lang", f"{SOURCE} AS content").createOrReplaceTempView("symbol_files")
    return s.sql("SELECT * FROM symbols(TABLE(SELECT file_id, content FROM symbol_files), 'content')")


register(
    "symbol_table",
    _symbols,
    "SELECT event_id AS file_id, kind, name, line, decorators, CASE event_id % 3 WHEN 0 THEN 'no' ELSE 'yes' END AS parsed FROM events, LATERAL (VALUES ('import', 'os', 1, ''), ('import', CASE event_id % 3 WHEN 0 THEN NULL ELSE 'json' END, 1, ''), ('import', 'm' || event_id % 5, 2, ''), "
    "('class', 'C' || event_type, 5, 'app.route,cached'), ('function', 'f' || event_id % 7, 7, 'property'), ('function', CASE event_id % 3 WHEN 0 THEN 'broken' ELSE 'whole' END, 9, '')) v(kind, name, line, decorators) WHERE name IS NOT NULL",
)
