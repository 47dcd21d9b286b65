"""Streaming monitors built from built-in stateful operators only.

Every function takes a DataFrame that may be streaming or static, so the
same plan runs over a file/Kafka stream and over a batch table; the batch
result is the reference the streaming run must reproduce.

* ``contract_monitor``: tumbling event-time windows with a watermark, the
  share of missing values and of invalid event types per window;
* ``session_budget``: per-session cost, steps and failures over
  ``session_window`` (state is bounded by the watermark);
* ``dedup_events``: ``dropDuplicatesWithinWatermark`` on a key;
* ``enrich_events``: stream-static left join with a dimension table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kintsugi.functions.nulls import is_missing
from kintsugi.functions.text import strip
from kintsugi.operators.repair import drop_duplicates
from kintsugi.operators.scan import sessionize
from kintsugi.operators.actionlog import (action_cost, cost_penalty, invalid_penalty, is_invalid,
                                          step_penalty)
from kintsugi.sources.fixtures import VALID_EVENT_TYPES


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    # withWatermark needs TIMESTAMP (with time zone), not TIMESTAMP_NTZ
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def contract_monitor(events: DataFrame, ts: str = "ts", window: str = "1 hour",
                     watermark: str = "10 minutes", value: str = "value",
                     kind: str = "event_type") -> DataFrame:
    e = _event_time(events, ts).withWatermark(ts, watermark)
    miss = is_missing(value, events.schema[value].dataType)
    ok = F.coalesce(strip(kind).isin(list(VALID_EVENT_TYPES)), F.lit(False))
    agg = e.groupBy(F.window(ts, window).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(miss).alias("missing"),
        F.count_if(~ok).alias("invalid"))
    return agg.select(F.col("w.start").alias("window_start"), "rows",
                      F.round(F.col("missing") / F.col("rows"), 6).alias("null_rate"),
                      F.round(F.col("invalid") / F.col("rows"), 6).alias("invalid_rate"))


def session_budget(log: DataFrame, ts: str = "ts", gap: str = "30 minutes",
                   watermark: str = "1 hour", session: str = "session_id",
                   max_steps: int = 20) -> DataFrame:
    """Cost, steps and failures per session window, with the step, invalid
    and cost penalties computed on top of the aggregates (no Python state)."""
    if log.isStreaming:
        # streaming: Spark's session_window with state bounded by the watermark
        a = _event_time(log, ts).withWatermark(ts, watermark)
        a = a.withColumn("__cost", action_cost(F.col("action_type"))) \
             .withColumn("__inv", is_invalid(F.col("action_type"), F.col("valid")))
        agg = a.groupBy(session, F.session_window(ts, gap).alias("w")).agg(
            F.count(F.lit(1)).alias("actions"), F.sum("__cost").alias("cost"),
            F.count_if("__inv").alias("invalid_actions"))
        agg = agg.select(session, F.col("w.start").alias("window_start"),
                         F.col("w.end").alias("window_end"), "actions", "cost", "invalid_actions")
    else:
        # batch: the same sessions from range-partitioned scans, so a session
        # key holding a third of all events is split over many tasks
        a = _event_time(log, ts).withColumn("__cost", action_cost(F.col("action_type"))) \
            .withColumn("__inv", is_invalid(F.col("action_type"), F.col("valid")))
        tie = [c for c in ("event_id",) if c in log.columns]
        a = sessionize(a, session, ts, gap, tie)
        agg = a.groupBy(session, "session_no").agg(
            F.min(ts).alias("window_start"),
            (F.max(ts) + F.expr(f"INTERVAL {gap}")).alias("window_end"),
            F.count(F.lit(1)).alias("actions"), F.sum("__cost").alias("cost"),
            F.count_if("__inv").alias("invalid_actions"))
    return agg.select(session, "window_start", "window_end", "actions", "cost", "invalid_actions",
                      step_penalty(F.col("actions"), max_steps).alias("step_pen"),
                      F.round(invalid_penalty(F.col("invalid_actions")), 6).alias("inv_pen"),
                      F.round(cost_penalty(F.col("cost")), 6).alias("cost_pen"))


def dedup_events(events: DataFrame, key: list[str], ts: str = "ts",
                 watermark: str = "1 hour") -> DataFrame:
    """One event per key.  A stream keeps the first that arrives and forgets a key after the
    watermark, so a repeat that comes later than that is kept; a batch keeps the earliest by
    event time (then by the other columns), however far apart the repeats are."""
    e = _event_time(events, ts)
    if events.isStreaming:
        return e.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(key)
    return drop_duplicates(e, key, [ts, *[c for c in e.columns if c not in {ts, *key}]])


def enrich_events(events: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of a (streaming) fact with a static dimension; Spark keeps
    no state for a stream-static join."""
    return events.join(dim, on=key, how="left")


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything available into Parquet files at ``path`` (append mode); nothing passes the driver."""
    q = (df.writeStream.outputMode("append").format("parquet").option("path", path)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_available_now(df: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Process everything available, into a table ``name`` in the driver's memory: for
    small results such as monitors' windows; see ``run_to_files`` for the rest."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
           .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.table(name)
