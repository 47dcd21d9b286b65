"""Structured Streaming forms of the monitors (batch DataFrames work too)."""

from kintsugi.streaming.monitors import (contract_monitor, dedup_events, enrich_events,
                                         run_available_now, session_budget)

__all__ = ["contract_monitor", "dedup_events", "enrich_events", "run_available_now",
           "session_budget"]
