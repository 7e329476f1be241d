"""Costs, agents and alerts over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import frame, values_sql
from auditloom.operators import cost, telemetry
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, with_sql

BUDGET = 1_000_000
LIMITS = {"purchase": 50_000, "error": 20_000}
MICROS = "epoch_us(ts)"

register("stage_costs", lambda s, d: cost.stage_costs(domain(s, d, "costs")), with_sql(["costs"], "SELECT stage, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS requests, count(DISTINCT model) AS models FROM costs GROUP BY stage"))
register(
    "model_costs",
    lambda s, d: cost.model_costs(domain(s, d, "costs")),
    with_sql(["costs"], "SELECT stage, " + ", ".join(f"CAST(sum(cents) FILTER (model = '{m}') AS BIGINT) AS {m}" for m in ("small", "medium", "large")) + " FROM costs GROUP BY stage"),
)
register(
    "budget_running",
    lambda s, d: cost.running(domain(s, d, "costs"), BUDGET),
    with_sql(["costs"], f"SELECT run_id, seq, spent, greatest(0, {BUDGET} - spent) AS remaining, spent <= {BUDGET} AS fits FROM (SELECT run_id, seq, CAST(sum(cents) OVER (PARTITION BY run_id ORDER BY seq) AS BIGINT) AS spent FROM costs)"),
)
# One step a charge: the runs advance side by side.
ROOM = "CASE stage " + " ".join(f"WHEN '{k}' THEN {k} + cents <= {v}" for k, v in LIMITS.items()) + " ELSE true END"
FOLDED = {
    "c": "SELECT run_id, seq, stage, cents, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS k FROM costs",
    "f": "SELECT DISTINCT run_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS seq, false AS accepted, CAST(0 AS BIGINT) AS spent, false AS exceeded, " + ", ".join(f"CAST(0 AS BIGINT) AS {k}" for k in LIMITS) + " FROM c"
    + " UNION ALL SELECT run_id, k, seq, fits AND room, spent + CASE WHEN fits AND room THEN cents ELSE 0 END, exceeded OR NOT fits, " + ", ".join(f"{k} + CASE WHEN fits AND room AND stage = '{k}' THEN cents ELSE 0 END" for k in LIMITS)
    + f" FROM (SELECT c.*, spent, exceeded, {', '.join(LIMITS)}, spent + cents <= {BUDGET} AS fits, {ROOM} AS room FROM f JOIN c ON c.run_id = f.run_id AND c.k = f.k + 1)",
}
register(
    "budget_fold",
    lambda s, d: cost.fold(domain(s, d, "costs"), BUDGET, LIMITS),
    with_sql(["costs"], "SELECT run_id, seq, accepted, spent, exceeded FROM f WHERE k > 0", **FOLDED).replace("WITH ", "WITH RECURSIVE ", 1),
)
register(
    "utilisation",
    lambda s, d: cost.utilisation(domain(s, d, "costs"), 10**12).withColumn("used", F.round("used", 9)),
    with_sql(["costs"], f"SELECT CAST(sum(cents) AS BIGINT) AS cents, count(*) AS requests, round(sum(cents) / {10**12}, 9) AS used, CAST(greatest(0, {10**12} - sum(cents)) AS BIGINT) AS remaining FROM costs"),
)
register(
    "agent_metrics",
    lambda s, d: cost.agent_metrics(domain(s, d, "alerts")),
    with_sql(["alerts"], "SELECT agent_id, " + ", ".join(f"count(*) FILTER (mode = '{m}') AS n_{m}" for m in ("purchase", "signup", "error", "view", "click")) + ", arg_max(anomaly, event_id) AS last_value FROM alerts GROUP BY agent_id"),
)
text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias("start")
register(
    "alerts_tumbling",
    lambda s, d: telemetry.tumbling(domain(s, d, "alerts")).withColumn("start", text("start")),
    with_sql(["alerts"], "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS start, severity, count(*) AS n FROM alerts GROUP BY 1, 2"),
)
register(
    "alerts_sliding",
    lambda s, d: telemetry.sliding(domain(s, d, "alerts")).withColumn("start", text("start")),
    with_sql(["alerts"], "SELECT strftime(time_bucket(INTERVAL 30 MINUTE, ts) - k * INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS start, mode, count(*) AS n FROM alerts, (VALUES (0), (1)) x(k) GROUP BY 1, 2"),
)
register(
    "alerts_session",
    lambda s, d: telemetry.sessions(domain(s, d, "alerts")).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss.SSSSSS")),
    with_sql(["alerts"], "SELECT agent_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY agent_id ORDER BY ts, event_id) AS k FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY agent_id ORDER BY ts, event_id) < INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM alerts)) GROUP BY agent_id, k"),
)
register(
    "alert_dedupe_24h",
    lambda s, d: telemetry.first_in_day(domain(s, d, "alerts")),
    with_sql(["alerts"], "SELECT event_id, alert_id FROM (SELECT *, lag(ts) OVER (PARTITION BY alert_id ORDER BY ts, event_id) AS b FROM alerts) WHERE b IS NULL OR ts - b >= INTERVAL 24 HOUR"),
)
register(
    "rate_cap_window",
    lambda s, d: telemetry.rate_caps(domain(s, d, "alerts")),
    with_sql(["alerts"], f"SELECT event_id, m AS minute, h AS hour, m > 1 OR h > 3 AS manual FROM (SELECT event_id, count(*) OVER (PARTITION BY mode ORDER BY {MICROS} RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS m, count(*) OVER (PARTITION BY mode ORDER BY {MICROS} RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS h FROM alerts)"),
)
register(
    "throttle_islands",
    lambda s, d: telemetry.throttled(domain(s, d, "alerts"), 20.0),
    with_sql(["alerts"], "SELECT agent_id, min(event_id) AS first, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY event_id) - row_number() OVER (PARTITION BY agent_id, anomaly > 20.0 ORDER BY event_id) AS k FROM alerts) WHERE anomaly > 20.0 GROUP BY agent_id, k HAVING count(*) >= 3"),
)
register(
    "hash_chain_verify",
    lambda s, d: telemetry.chained(domain(s, d, "alerts")),
    with_sql(["alerts"], "SELECT event_id, substr(sha, 1, 16) AS sha, (CASE WHEN event_id % 97 = 0 THEN '0' ELSE p END) IS NOT DISTINCT FROM p AS holds FROM (SELECT *, lag(sha) OVER (PARTITION BY mode ORDER BY event_id) AS p FROM (SELECT *, sha256(CAST(event_id AS VARCHAR) || '|' || alert_id || '|' || severity) AS sha FROM alerts))"),
)
ADMITTED = {
    "a": f"SELECT mode, event_id, {MICROS} AS us, row_number() OVER (PARTITION BY mode ORDER BY {MICROS}, event_id) AS k FROM alerts",
    "f": "SELECT DISTINCT mode, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS event_id, false AS ok, CAST([] AS BIGINT[]) AS kept FROM a"
    " UNION ALL SELECT mode, k, event_id, ok, CASE WHEN ok THEN list_append(live, us) ELSE live END"
    " FROM (SELECT *, len(live) < 3 AND len(list_filter(live, lambda t: t > us - 60000000)) < 1 AS ok FROM (SELECT a.*, list_filter(kept, lambda t: t > a.us - 3600000000) AS live FROM f JOIN a ON a.mode = f.mode AND a.k = f.k + 1))",
}
register(
    "rate_cap_admitted",
    lambda s, d: telemetry.admitted(domain(s, d, "alerts")),
    with_sql(["alerts"], "SELECT event_id, ok AS admitted FROM f WHERE k > 0", **ADMITTED).replace("WITH ", "WITH RECURSIVE ", 1),
)
register(
    "alert_novelty",
    lambda s, d: telemetry.novelty(domain(s, d, "alerts")),
    with_sql(["alerts"], f"SELECT agent_id, event_id, CASE WHEN us - lag(us) OVER (PARTITION BY agent_id, mode ORDER BY us, event_id) <= 86400000000 THEN 'seen' WHEN us - lag(us) OVER (PARTITION BY agent_id ORDER BY us, event_id) <= 86400000000 THEN 'near-variant' ELSE 'novel' END AS novelty FROM (SELECT *, {MICROS} AS us FROM alerts)"),
)
LEVELS = {
    "o": f"SELECT agent_id, event_id, coalesce(anomaly > 20.0, false) AS high, row_number() OVER (PARTITION BY agent_id ORDER BY {MICROS}, event_id) AS k FROM alerts",
    "fold": "SELECT agent_id, event_id, k, CASE WHEN high THEN 1 ELSE 0 END AS run, 2 AS level, false AS fell FROM o WHERE k = 1"
    " UNION ALL SELECT o.agent_id, o.event_id, o.k, CASE WHEN NOT high THEN 0 WHEN run = 2 THEN 0 ELSE run + 1 END, CASE WHEN high AND run = 2 THEN greatest(0, level - 1) ELSE level END, high AND run = 2 FROM fold JOIN o ON o.agent_id = fold.agent_id AND o.k = fold.k + 1",
}
register("throttle_levels", lambda s, d: telemetry.throttle_levels(domain(s, d, "alerts"), 20.0), with_sql(["alerts"], "SELECT agent_id, event_id, level FROM fold WHERE fell", **LEVELS).replace("WITH ", "WITH RECURSIVE ", 1))


def _beats(s, d):
    a = domain(s, d, "alerts")
    return telemetry.heartbeats(a, a.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0] or 0)


register(
    "heartbeats",
    _beats,
    with_sql(
        ["alerts"],
        "SELECT r.mode, (slot + 1) * 3600000000 AS at, count(b.slot2) AS n FROM (SELECT mode, unnest(range(min(slot2), (SELECT (max(us) - 1) // 3600000000 FROM b))) AS slot FROM b GROUP BY mode) r LEFT JOIN b ON b.mode = r.mode AND b.slot2 = r.slot GROUP BY ALL",
        b=f"SELECT mode, {MICROS} AS us, {MICROS} // 3600000000 AS slot2 FROM alerts",
    ).replace("AS at,", 'AS "at",'),
)
# Cutoffs and accepted novelty of the sensitivities.
CUTOFFS = [("low", -0.6, ["novel"]), ("medium", -0.4, ["near-variant", "novel"]), ("high", -0.2, ["seen", "near-variant", "novel"])]
SCORED = "cast(event_id * 37 % 201 - 100 as double) / 100"
register(
    "sensitivity_gate",
    lambda s, d: telemetry.sensitive_enough(
        telemetry.novelty(domain(s, d, "alerts")).select("event_id", "novelty", F.expr(SCORED).alias("score")), F.broadcast(frame(s, "sensitivity string, cutoff double, accepted array<string>", CUTOFFS))
    ),
    with_sql(
        ["alerts"],
        f"SELECT sensitivity, event_id FROM (SELECT event_id, novelty, {SCORED} AS score FROM n) JOIN (VALUES " + ", ".join(f"('{a}', {b}::DOUBLE, {c})" for a, b, c in CUTOFFS) + ") c(sensitivity, cutoff, accepted) ON score < cutoff AND list_contains(accepted, novelty)",
        n=f"SELECT event_id, CASE WHEN us - lag(us) OVER (PARTITION BY agent_id, mode ORDER BY us, event_id) <= 86400000000 THEN 'seen' WHEN us - lag(us) OVER (PARTITION BY agent_id ORDER BY us, event_id) <= 86400000000 THEN 'near-variant' ELSE 'novel' END AS novelty FROM (SELECT *, {MICROS} AS us FROM alerts)",
    ),
)
# What a mode's alerts are bound to.
MODE_TECHNIQUES = [("purchase", "D3-NTA"), ("signup", "D3-PA"), ("error", "D3-PA"), ("error", "D3-IPCTA"), ("view", "D3-FA"), ("click", "D3-SCA")]
register(
    "alert_counters",
    lambda s, d: domain(s, d, "alerts").join(F.broadcast(frame(s, "mode string, technique string", MODE_TECHNIQUES)), "mode").groupBy("mode", "severity", "technique").agg(F.count("*").alias("n")),
    with_sql(["alerts"], "SELECT mode, severity, technique, count(*) AS n FROM alerts JOIN " + values_sql(MODE_TECHNIQUES, "m, technique", "t") + " ON m = mode GROUP BY 1, 2, 3"),
)
