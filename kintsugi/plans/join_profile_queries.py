"""Catalogue: guarded joins, join reports, profiling and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from kintsugi.functions.text import strip
from kintsugi.operators import joins, profile
from kintsugi.plans.registry import query
from kintsugi.plans.repair_queries import MISSING_SQL, STRIP_SQL
from kintsugi.sources import fixtures as fx

_CUST_K = "(SELECT c_custkey AS o_custkey, c_name, c_mktsegment FROM customer)"


def _cust_k(t):
    return t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")


# ---------------------------------------------------------------- joins ----

@query("join_inner", f"""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders_orphan o JOIN {_CUST_K} c ON o.o_custkey IS NOT DISTINCT FROM c.o_custkey""")
def join_inner(t):
    return joins.safe_join(fx.orders_orphan(t), _cust_k(t), "o_custkey", "inner")


@query("join_left", f"""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders_orphan o LEFT JOIN {_CUST_K} c ON o.o_custkey IS NOT DISTINCT FROM c.o_custkey""")
def join_left(t):
    return joins.safe_join(fx.orders_orphan(t), _cust_k(t), "o_custkey", "left")


@query("join_right", f"""
SELECT o.o_orderkey, c.o_custkey AS o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders_orphan o RIGHT JOIN {_CUST_K} c ON o.o_custkey IS NOT DISTINCT FROM c.o_custkey""")
def join_right(t):
    return joins.safe_join(fx.orders_orphan(t), _cust_k(t), "o_custkey", "right")


@query("join_outer", f"""
SELECT o.o_orderkey, coalesce(o.o_custkey, c.o_custkey) AS o_custkey, o.o_totalprice,
       c.c_name, c.c_mktsegment
FROM orders_orphan o FULL JOIN {_CUST_K} c ON o.o_custkey IS NOT DISTINCT FROM c.o_custkey""")
def join_outer(t):
    return joins.safe_join(fx.orders_orphan(t), _cust_k(t), "o_custkey", "outer")


@query("join_diff_keys", """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name, c.c_mktsegment
FROM orders_orphan o LEFT JOIN (SELECT c_custkey, c_name, c_mktsegment FROM customer) c
  ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey""")
def join_diff_keys(t):
    cust = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return joins.safe_join(fx.orders_orphan(t), cust, {"left": "o_custkey", "right": "c_custkey"},
                           "left")


@query("join_null_keys", """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name, c.c_mktsegment
FROM orders_orphan o JOIN customer_nullkey c ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey""")
def join_null_keys(t):
    return joins.safe_join(fx.orders_orphan(t), fx.customer_nullkey(t),
                           ("o_custkey", "c_custkey"), "inner", null_keys="match")


@query("join_name_clash", """
SELECT l.o_orderkey, l.o_custkey AS o_custkey_x, l.o_totalprice AS o_totalprice_x,
       r.o_custkey AS o_custkey_y, r.o_totalprice AS o_totalprice_y
FROM orders_orphan l JOIN orders r ON l.o_orderkey IS NOT DISTINCT FROM r.o_orderkey""")
def join_name_clash(t):
    right = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.safe_join(fx.orders_orphan(t), right, "o_orderkey", "inner")


@query("join_report", """
WITH lk AS (SELECT o_custkey AS k, count(*) AS lc FROM orders_orphan GROUP BY 1),
     rk AS (SELECT c_custkey AS k, count(*) AS rc FROM customer_nullkey GROUP BY 1),
     b AS (SELECT coalesce(lc, 0) AS l, coalesce(rc, 0) AS r
           FROM lk FULL JOIN rk ON lk.k IS NOT DISTINCT FROM rk.k)
SELECT CAST(sum(l) AS BIGINT) AS left_rows, CAST(sum(r) AS BIGINT) AS right_rows,
       CAST(sum(l * r) AS BIGINT) AS inner_rows,
       CAST(sum(CASE WHEN r > 0 THEN l * r ELSE l END) AS BIGINT) AS left_join_rows,
       CAST(sum(CASE WHEN l > 0 THEN l * r ELSE r END) AS BIGINT) AS right_join_rows,
       CAST(sum(CASE WHEN l > 0 AND r > 0 THEN l * r ELSE l + r END) AS BIGINT) AS full_join_rows,
       CAST(sum(CASE WHEN r = 0 THEN l ELSE 0 END) AS BIGINT) AS unmatched_left,
       CAST(sum(CASE WHEN l = 0 THEN r ELSE 0 END) AS BIGINT) AS unmatched_right,
       CAST(count_if(l > 0 AND r > 1) AS BIGINT) AS fanout_keys
FROM b""")
def join_report(t):
    return joins.join_report(fx.orders_orphan(t), fx.customer_nullkey(t), ("o_custkey", "c_custkey"))


@query("unmatched_left", """
SELECT o.* FROM orders_orphan o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey IS NOT DISTINCT FROM o.o_custkey)""")
def unmatched_left(t):
    return joins.unmatched_left(fx.orders_orphan(t), t["customer"], ("o_custkey", "c_custkey"))


@query("matched_left", """
SELECT o.* FROM orders_orphan o
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey IS NOT DISTINCT FROM o.o_custkey)""")
def matched_left(t):
    return joins.matched_left(fx.orders_orphan(t), t["customer"], ("o_custkey", "c_custkey"))


# ------------------------------------------------------------- profiling ----

_V = "CASE WHEN isnan(value) THEN NULL ELSE value END"


@query("inspect_column", f"""
SELECT 'value' AS column_name, 'float64' AS dtype,
       CAST(count_if({MISSING_SQL.format(c='value')}) AS BIGINT) AS null_count,
       count(DISTINCT {_V}) AS unique_count,
       (SELECT list(CAST(value AS VARCHAR) ORDER BY event_id)
        FROM (SELECT value, event_id FROM events_gappy WHERE NOT {MISSING_SQL.format(c='value')}
              ORDER BY event_id LIMIT 5)) AS sample_values,
       min({_V}) AS min, max({_V}) AS max, round(avg({_V}), 6) AS mean
FROM events_gappy""")
def inspect_column(t):
    r = profile.inspect_column(fx.events_gappy(t), "value", order_by=["event_id"])
    return r.withColumn("mean", F.round("mean", 6))


def _profile_sql(view: str, cols: list[tuple[str, str, str]]) -> str:
    allc = ", ".join(c for c, _, _ in cols)
    parts = [f"""SELECT '{view}' AS table_name, (SELECT count(*) FROM {view}) AS rows,
       {len(cols)} AS n_columns,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {view} GROUP BY {allc})) AS duplicates,
       '{c}' AS column_name, '{d}' AS dtype,
       (SELECT CAST(count_if({m}) AS BIGINT) FROM {view}) AS nulls""" for c, d, m in cols]
    return "\nUNION ALL\n".join(parts)


@query("profile_tables", _profile_sql("orders_dirty", [
    ("o_orderkey", "float64", MISSING_SQL.format(c="o_orderkey")),
    ("o_custkey", "object", "o_custkey IS NULL"),
    ("o_totalprice", "object", "o_totalprice IS NULL"),
    ("o_orderstatus", "object", "o_orderstatus IS NULL"),
    ("o_orderpriority", "object", "o_orderpriority IS NULL"),
    ("o_orderdate", "datetime64[ns]", "o_orderdate IS NULL")]) + "\nUNION ALL\n" + _profile_sql(
    "orders_dup", [("o_orderkey", "int64", "o_orderkey IS NULL"),
                   ("custKey", "int64", "custKey IS NULL"),
                   ("orderStatus", "object", "orderStatus IS NULL"),
                   ("totalPrice", "object", "totalPrice IS NULL")]))
def profile_tables(t):
    return profile.profile_tables({"orders_dirty": fx.orders_dirty(t), "orders_dup": fx.orders_dup(t)})


@query("distinct_values", f"SELECT DISTINCT {STRIP_SQL.format(c='event_type')} AS event_type FROM events_padded")
def distinct_values(t):
    e = fx.events_padded(t).select(strip("event_type").alias("event_type"))
    return profile.distinct_values(e, "event_type")


@query("preview_rows", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
FROM orders_dirty ORDER BY o_orderkey LIMIT 5""")
def preview_rows(t):
    return profile.preview(fx.orders_dirty(t), ["o_orderkey"], n=5).drop("row_json")


_HEALTH_SCHEMA = {"orders": {"o_orderkey": "int64", "o_custkey": "int64", "o_totalprice": "float64",
                             "o_orderdate": "datetime64[ns]"},
                  "sessions": {"session_id": "int64", "user_id": "int64",
                               "session_duration": "float64", "page_views": "int64"}}


def _health_sql(t, view, cols, issues):
    names = ", ".join(f"'{c}'" for c, _, _ in cols)
    dts = ", ".join(f"'{c}:{d}'" for c, d, _ in cols)
    nulls = ", ".join(f"'{c}=' || CAST(count_if({m}) AS VARCHAR)" for c, _, m in cols)
    allc = ", ".join(c for c, _, _ in cols)
    iss = ", ".join(f"'{x}'" for x in issues)
    return f"""SELECT '{t}' AS table_name, count(*) AS rows, {len(cols)} AS n_columns,
       [{names}] AS columns, [{dts}] AS dtypes, [{nulls}] AS null_counts,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {view} GROUP BY {allc})) AS duplicates,
       CAST([{iss}] AS VARCHAR[]) AS schema_issues
FROM {view}"""


@query("health_report", _health_sql("orders", "orders_dirty", [
    ("o_orderkey", "float64", "o_orderkey IS NULL OR isnan(o_orderkey)"),
    ("o_custkey", "object", "o_custkey IS NULL"), ("o_totalprice", "object", "o_totalprice IS NULL"),
    ("o_orderstatus", "object", "o_orderstatus IS NULL"), ("o_orderpriority", "object", "o_orderpriority IS NULL"),
    ("o_orderdate", "datetime64[ns]", "o_orderdate IS NULL")],
    ["o_orderkey: expected=int64, actual=float64", "o_custkey: expected=int64, actual=object",
     "o_totalprice: expected=float64, actual=object"]) + "\nUNION ALL\n" + _health_sql(
    "sessions", "sessions_dirty", [
        ("session_id", "float64", "session_id IS NULL OR isnan(session_id)"),
        ("user_id", "float64", "user_id IS NULL OR isnan(user_id)"),
        ("session_duration", "object", "session_duration IS NULL"), ("page_views", "int64", "page_views IS NULL")],
    ["session_id: expected=int64, actual=float64", "user_id: expected=int64, actual=float64",
     "session_duration: expected=float64, actual=object"]))
def health_report(t):
    from kintsugi.session import materialize
    tables = {"orders": fx.orders_dirty(t), "sessions": materialize(fx.sessions_dirty(t))}
    return profile.health_report(tables, _HEALTH_SCHEMA)
