"""Corruption views: broken inputs derived from the driver's clean tables.

Each view injects the faults a repair has to undo (text-typed numbers,
nulls, duplicates, orphan keys, padding, camelCase names) over the whole
source table, so the work grows with the data.  The same views exist as SQL
in ``kintsugi.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Action type assigned to each event type in the action log.
ACTION_FOR_EVENT = {
    "click": "inspect_column",
    "view": "check_nulls",
    "purchase": "join_tables",
    "signup": "cast_type",
}

# Event types a cleaned event table may hold.
VALID_EVENT_TYPES = ("click", "view", "purchase")


def orders_dirty(t) -> DataFrame:
    o = t["orders"]
    k = F.col("o_orderkey")
    return o.select(
        k.cast("double").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .when(k % 97 == 0, F.lit("n/a"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        "o_orderstatus",
        F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("o_orderpriority"),
        "o_orderdate")


def orders_dup(t) -> DataFrame:
    o = t["orders"]
    base = o.select("o_orderkey", F.col("o_custkey").alias("custKey"),
                    F.col("o_orderstatus").alias("orderStatus"),
                    F.col("o_totalprice").cast("string").alias("totalPrice"))
    return base.unionByName(base.filter(F.col("o_orderkey") % 5 == 1))


def orders_orphan(t) -> DataFrame:
    k = F.col("o_orderkey")
    return t["orders"].select(
        "o_orderkey",
        F.when(k % 11 == 0, F.lit(None).cast("long"))
         .when(k % 7 == 0, F.col("o_custkey") + 1000000)
         .otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_totalprice")


def customer_nullkey(t) -> DataFrame:
    k = F.col("c_custkey")
    return t["customer"].select(
        F.when(k % 100 == 0, F.lit(None).cast("long")).otherwise(k).alias("c_custkey"),
        "c_name", "c_mktsegment")


def events_padded(t) -> DataFrame:
    k = F.col("event_id")
    return t["events"].select(
        "event_id", "user_id", "ts",
        F.when(k % 3 == 0, F.concat(F.lit("\t"), "event_type", F.lit(" ")))
         .when(k % 3 == 1, F.concat(F.lit(" "), "event_type", F.lit(" ")))
         .otherwise(F.col("event_type")).alias("event_type"))


def events_gappy(t) -> DataFrame:
    k = F.col("event_id")
    return t["events"].select(
        "event_id", "user_id", "ts", "event_type",
        F.when(k % 4 == 0, F.lit(None).cast("double"))
         .when(k % 10 == 7, F.lit(float("nan")))
         .otherwise(F.col("value")).alias("value"))


def sessions_clean(t) -> DataFrame:
    e = t["events"]
    return (e.groupBy("user_id", F.dayofyear("ts").alias("doy"))
             .agg(F.timestamp_diff("SECOND", F.min("ts"), F.max("ts")).cast("double")
                  .alias("session_duration"),
                  F.count(F.lit(1)).alias("page_views"))
             .select((F.col("user_id") * 1000 + F.col("doy")).alias("session_id"),
                     "user_id", "session_duration", "page_views"))


def sessions_dirty(t) -> DataFrame:
    s = sessions_clean(t)
    sid = F.col("session_id")
    return s.select(
        F.when(sid % 10 == 0, F.lit(None).cast("double")).otherwise(sid.cast("double"))
         .alias("session_id"),
        F.col("user_id").cast("double").alias("user_id"),
        F.col("session_duration").cast("string").alias("session_duration"),
        "page_views")


def users(t) -> DataFrame:
    """User dimension for the session summary: customer + region name."""
    c, n, r = t["customer"], t["nation"], t["region"]
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.col("c_custkey").alias("user_id"),
                     F.col("c_mktsegment").alias("plan"),
                     F.col("r_name").alias("region")))


def action_log(t) -> DataFrame:
    e = t["events"]
    k = F.col("event_id")
    kind = F.when(k % 13 == 0, F.lit("finish"))
    for ev, action in ACTION_FOR_EVENT.items():
        kind = kind.when(F.col("event_type") == ev, F.lit(action))
    kind = F.when(k % 17 == 0, F.lit(None)).otherwise(kind.otherwise(F.lit("unlisted_action")))
    return e.select(
        (F.col("user_id") * 100 + F.weekofyear("ts")).alias("session_id"),
        "event_id", "ts", kind.alias("action_type"),
        ((F.col("event_type") != "error") | (k % 13 == 0)).alias("valid"),
        F.col("props").alias("params_json"))


VIEWS = {
    "orders_dirty": orders_dirty,
    "orders_dup": orders_dup,
    "orders_orphan": orders_orphan,
    "customer_nullkey": customer_nullkey,
    "events_padded": events_padded,
    "events_gappy": events_gappy,
    "sessions_clean": sessions_clean,
    "sessions_dirty": sessions_dirty,
    "users": users,
    "action_log": action_log,
}


def register_views(tables) -> None:
    for name, build in VIEWS.items():
        build(tables).createOrReplaceTempView(name)
