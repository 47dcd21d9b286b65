"""Action-log accounting: steps, running cost, failures, penalties, audit.

An action log is a table ``(session_id, ts, event_id, action_type, valid,
params_json)``.  Running values per session come from ``segmented_scan``,
which range-partitions on (session, order) so one session holding a third
of all actions is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kintsugi.operators.scan import ScanSpec, segmented_scan

# Cost of each action type; any other type costs 1.0.
ACTION_COSTS = {
    "inspect_column": 0.5,
    "check_nulls": 0.5,
    "cast_type": 1.0,
    "fill_nulls": 1.0,
    "drop_duplicates": 1.0,
    "rename_column": 1.0,
    "join_tables": 2.0,
    "filter_rows": 1.0,
    "validate_table": 0.5,
    "finish": 0.0,
    "check_pipeline_health": 0.5,
    "audit_log": 0.0,
}
UNKNOWN_ACTION_COST = 1.0
COST_BUDGET = 20.0

# The action types an episode accepts.
KNOWN_ACTIONS = (
    "check_pipeline_health", "inspect_column", "check_nulls", "cast_type", "fill_nulls",
    "drop_duplicates", "rename_column", "join_tables", "filter_rows", "validate_table",
    "audit_log", "finish",
)

# Parameters each action type must carry.
REQUIRED_PARAMS = {
    "inspect_column": ["table", "column"],
    "check_nulls": ["table"],
    "cast_type": ["table", "column", "target_type"],
    "fill_nulls": ["table", "column"],
    "drop_duplicates": ["table"],
    "rename_column": ["table", "old_name", "new_name"],
    "join_tables": ["left", "right", "on"],
    "filter_rows": ["table", "column", "operator"],
    "validate_table": ["table"],
    "finish": [],
}

# Step-penalty bands over the share of the step budget used.
STEP_BANDS = ((0.40, 0.0), (0.70, 0.10), (0.90, 0.20))
STEP_PENALTY_MAX = 0.40
INVALID_PENALTY_PER_ACTION = 0.15
COST_PENALTY_MAX = 0.30

# Audit line layout and message cut.
AUDIT_LINE = "[Step %02d] %s(%s) → %s"
MESSAGE_CUT = 120


def action_cost(action_type: Column) -> Column:
    expr = None
    for name, cost in ACTION_COSTS.items():
        expr = (F.when(action_type == name, F.lit(cost)) if expr is None
                else expr.when(action_type == name, F.lit(cost)))
    return expr.otherwise(F.lit(UNKNOWN_ACTION_COST))


def is_invalid(action_type: Column, valid: Column) -> Column:
    return (~F.coalesce(valid, F.lit(False))) | ~F.coalesce(action_type.isin(list(KNOWN_ACTIONS)), F.lit(False))


def annotate(log: DataFrame, session: str = "session_id",
             order_by: list[str] = ("ts", "event_id"), max_steps: int = 20,
             keep: list[str] | None = None) -> DataFrame:
    """Add step, cost, cum_cost, invalid, cum_invalid and ``active``; ``keep`` names the
    columns of the log that the result needs (all, if not given).
    A missing action type is an unknown action: it is invalid and costs as such.

    ``active`` is false after the session ended: after its first ``finish``
    or beyond ``max_steps`` (later actions change nothing and score 0).
    """
    x = (log.withColumn("cost", action_cost(F.col("action_type")))
            .withColumn("invalid", is_invalid(F.col("action_type"), F.col("valid")).cast("long"))
            .withColumn("__fin", F.col("action_type").eqNullSafe("finish").cast("long")))
    x = segmented_scan(x, list(order_by), [
        ScanSpec("step", "count"), ScanSpec("cum_cost", "sum", "cost"),
        ScanSpec("cum_invalid", "sum", "invalid"), ScanSpec("__cum_fin", "sum", "__fin")],
        partition_by=[session],
        keep=None if keep is None else [*keep, "cost", "invalid", "__fin"])
    active = ((F.col("__cum_fin") - F.col("__fin")) == 0) & (F.col("step") <= max_steps)
    return x.withColumn("active", active).drop("__fin", "__cum_fin")


def step_penalty(step: Column, max_steps: int) -> Column:
    used = step.cast("double") / max_steps
    expr = None
    for bound, pen in STEP_BANDS:
        expr = (F.when(used <= bound, F.lit(pen)) if expr is None
                else expr.when(used <= bound, F.lit(pen)))
    return expr.otherwise(F.lit(STEP_PENALTY_MAX))


def invalid_penalty(n_invalid: Column) -> Column:
    return F.least(F.lit(1.0), n_invalid * INVALID_PENALTY_PER_ACTION)


def cost_penalty(cost: Column, budget: float = COST_BUDGET) -> Column:
    return F.when(cost <= budget, F.lit(0.0)).otherwise(
        F.least(F.lit(COST_PENALTY_MAX), (cost - budget) / budget * COST_PENALTY_MAX))


def penalties(annotated: DataFrame, max_steps: int = 20) -> DataFrame:
    return (annotated.filter("active")
            .withColumn("step_pen", step_penalty(F.col("step"), max_steps))
            .withColumn("inv_pen", invalid_penalty(F.col("cum_invalid")))
            .withColumn("cost_pen", cost_penalty(F.col("cum_cost"))))


def session_end(annotated: DataFrame, session: str = "session_id",
                max_steps: int = 20) -> DataFrame:
    """Per session: end_step, how it ended, actions logged, actions ignored."""
    a = annotated
    return a.groupBy(session).agg(
        F.max(F.when(F.col("active"), F.col("step"))).alias("end_step"),
        F.max(F.when(F.col("active") & (F.col("action_type") == "finish"), 1)).alias("__f"),
        F.count(F.lit(1)).alias("actions"),
        F.count_if(~F.col("active")).alias("ignored_actions")).select(
        session, "end_step",
        F.when(F.col("__f") == 1, F.lit("finish"))
         .when(F.col("end_step") >= max_steps, F.lit("max_steps"))
         .otherwise(F.lit("open")).alias("ended_by"),
        "actions", "ignored_actions")


def message(action_type: Column, valid: Column) -> Column:
    return F.when(is_invalid(action_type, valid),
                  F.concat(F.lit("ERROR: invalid action "), F.coalesce(action_type, F.lit("None")))) \
        .otherwise(F.concat(F.lit("OK: "), action_type))


def audit(annotated: DataFrame) -> DataFrame:
    """Ordered history lines; ``finish`` and post-end actions are not logged."""
    a = annotated.filter(F.col("active") & ~F.col("action_type").eqNullSafe("finish"))
    msg = F.substring(message(F.col("action_type"), F.col("valid")), 1, MESSAGE_CUT)
    return a.select("session_id", "step", F.format_string(
        AUDIT_LINE, F.col("step"), F.coalesce("action_type", F.lit("None")),
        F.coalesce(F.col("params_json"), F.lit("{}")), msg).alias("line"))


def summary(annotated: DataFrame, session: str = "session_id") -> DataFrame:
    """Per session: steps, cost, invalid actions, and the cost trace by step.

    The trace collects only active rows, at most ``max_steps`` per session,
    so the collected list has a fixed bound."""
    a = annotated.filter("active")
    return a.groupBy(session).agg(
        F.max("step").alias("steps"), F.max("cum_cost").alias("cost_used"),
        F.max("cum_invalid").alias("invalid_actions"),
        F.transform(F.array_sort(F.collect_list(F.struct("step", "cum_cost"))),
                    lambda s: s["cum_cost"]).alias("cost_trace"))


def required_params_missing(log: DataFrame) -> DataFrame:
    """Required keys absent from ``params_json``, per action."""
    expr = None
    for name, keys in REQUIRED_PARAMS.items():
        arr = F.array(*[F.lit(k) for k in keys]).cast("array<string>")
        expr = F.when(F.col("action_type") == name, arr) if expr is None else \
            expr.when(F.col("action_type") == name, arr)
    required = expr.otherwise(F.array().cast("array<string>"))
    params = F.from_json(F.col("params_json"), "map<string,string>")
    keys = F.coalesce(F.map_keys(params), F.array().cast("array<string>"))
    missing = F.array_except(required, keys)
    return log.select("session_id", "event_id", "action_type", missing.alias("missing"),
                      F.size(missing).alias("n_missing"))
