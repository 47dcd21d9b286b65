"""Catalogue: batch runs of the streaming monitors (same plans as the streams)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kintsugi.operators import actionlog
from kintsugi.plans.registry import query
from kintsugi.plans.repair_queries import STRIP_SQL
from kintsugi.sources import fixtures as fx
from kintsugi.streaming import monitors


@query("stream_contract_monitor", f"""
SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, count(*) AS rows,
       round(count_if(value IS NULL OR isnan(value)) / count(*), 6) AS null_rate,
       round(count_if(NOT coalesce({STRIP_SQL.format(c='event_type')} IN ('click', 'view', 'purchase'), false))
             / count(*), 6) AS invalid_rate
FROM events_gappy GROUP BY 1""")
def stream_contract_monitor(t):
    out = monitors.contract_monitor(fx.events_gappy(t))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


_COSTS = "CASE action_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in actionlog.ACTION_COSTS.items()) + " ELSE 1.0 END"
_KNOWN = ", ".join(f"'{a}'" for a in actionlog.KNOWN_ACTIONS)


@query("stream_session_budget", """SELECT *,
       CAST(CASE WHEN actions / 20.0 <= 0.40 THEN 0.0 WHEN actions / 20.0 <= 0.70 THEN 0.10
                 WHEN actions / 20.0 <= 0.90 THEN 0.20 ELSE 0.40 END AS DOUBLE) AS step_pen,
       round(least(1.0, invalid_actions * CAST(0.15 AS DOUBLE)), 6) AS inv_pen,
       round(CASE WHEN cost <= 20.0 THEN 0.0 ELSE least(0.30, (cost - 20.0) / 20.0 * 0.30) END, 6) AS cost_pen
FROM (""" + f"""
WITH g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) IS NULL
                            OR ts - lag(ts) OVER (PARTITION BY session_id ORDER BY ts, event_id) >= INTERVAL 30 minutes
                          THEN 1 ELSE 0 END AS new_session FROM action_log),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY session_id ORDER BY ts, event_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sn FROM g)
SELECT session_id, min(ts) AS window_start, max(ts) + INTERVAL 30 minutes AS window_end,
       count(*) AS actions, CAST(sum({_COSTS}) AS DOUBLE) AS cost,
       CAST(count_if(NOT coalesce(valid, false) OR NOT coalesce(action_type IN ({_KNOWN}), false)) AS BIGINT) AS invalid_actions
FROM s GROUP BY session_id, sn)""")
def stream_session_budget(t):
    out = monitors.session_budget(fx.action_log(t))
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
              .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def _dup_events(t):
    e = t["events"].select("event_id", "user_id", "ts", "event_type", "value")
    return e.unionByName(e.filter(F.col("event_id") % 5 == 1))


@query("stream_dedup", """
SELECT DISTINCT event_id, user_id, ts, event_type, value FROM (
  SELECT event_id, user_id, ts, event_type, value FROM events
  UNION ALL SELECT event_id, user_id, ts, event_type, value FROM events WHERE event_id % 5 = 1)""")
def stream_dedup(t):
    out = monitors.dedup_events(_dup_events(t), ["event_id"])
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("stream_enrich", """
SELECT e.user_id, e.event_id, e.event_type, u.plan, u.region
FROM events e LEFT JOIN users u ON e.user_id = u.user_id""")
def stream_enrich(t):
    e = t["events"].select("event_id", "user_id", "event_type")
    return monitors.enrich_events(e, fx.users(t), "user_id")
