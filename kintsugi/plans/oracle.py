"""DuckDB SQL for the corruption views, inlined as CTEs into oracle queries.

Only the raw tables are registered on the oracle side, so each oracle
query gets the views it names (and their dependencies) prepended.
"""

from __future__ import annotations

import re

# name -> (SQL body, dependencies)
VIEW_SQL: dict[str, tuple[str, tuple[str, ...]]] = {
    "orders_dirty": ("""
SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'n/a'
            ELSE CAST(o_totalprice AS VARCHAR) END AS o_totalprice,
       o_orderstatus, concat(' ', o_orderpriority, ' ') AS o_orderpriority, o_orderdate
FROM orders""", ()),
    "orders_dup": ("""
SELECT o_orderkey, o_custkey AS custKey, o_orderstatus AS orderStatus,
       CAST(o_totalprice AS VARCHAR) AS totalPrice FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR)
FROM orders WHERE o_orderkey % 5 = 1""", ()),
    "orders_orphan": ("""
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL
                        WHEN o_orderkey % 7 = 0 THEN o_custkey + 1000000
                        ELSE o_custkey END AS o_custkey, o_totalprice
FROM orders""", ()),
    "customer_nullkey": ("""
SELECT CASE WHEN c_custkey % 100 = 0 THEN NULL ELSE c_custkey END AS c_custkey,
       c_name, c_mktsegment FROM customer""", ()),
    "events_padded": ("""
SELECT event_id, user_id, ts,
       CASE WHEN event_id % 3 = 0 THEN concat(chr(9), event_type, ' ')
            WHEN event_id % 3 = 1 THEN concat(' ', event_type, ' ')
            ELSE event_type END AS event_type
FROM events""", ()),
    "events_gappy": ("""
SELECT event_id, user_id, ts, event_type,
       CASE WHEN event_id % 4 = 0 THEN NULL
            WHEN event_id % 10 = 7 THEN CAST('NaN' AS DOUBLE) ELSE value END AS value
FROM events""", ()),
    "sessions_clean": ("""
SELECT user_id * 1000 + dayofyear(ts) AS session_id, user_id,
       CAST(date_sub('second', min(ts), max(ts)) AS DOUBLE) AS session_duration,
       count(*) AS page_views
FROM events GROUP BY user_id, dayofyear(ts)""", ()),
    "sessions_dirty": ("""
SELECT CASE WHEN session_id % 10 = 0 THEN NULL ELSE CAST(session_id AS DOUBLE) END AS session_id,
       CAST(user_id AS DOUBLE) AS user_id, CAST(session_duration AS VARCHAR) AS session_duration,
       page_views FROM sessions_clean""", ("sessions_clean",)),
    "users": ("""
SELECT c_custkey AS user_id, c_mktsegment AS plan, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey""", ()),
    "action_log": ("""
SELECT user_id * 100 + weekofyear(ts) AS session_id, event_id, ts,
       CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'finish'
            WHEN event_type = 'click' THEN 'inspect_column'
            WHEN event_type = 'view' THEN 'check_nulls'
            WHEN event_type = 'purchase' THEN 'join_tables'
            WHEN event_type = 'signup' THEN 'cast_type'
            ELSE 'unlisted_action' END AS action_type,
       event_type <> 'error' OR event_id % 13 = 0 AS valid,
       props AS params_json
FROM events""", ()),
}


def with_views(sql: str) -> str:
    """Prepend the CTEs of every view the query names."""
    needed: list[str] = []

    def need(name: str) -> None:
        for dep in VIEW_SQL[name][1]:
            need(dep)
        if name not in needed:
            needed.append(name)

    for name in VIEW_SQL:
        if re.search(rf"\b{name}\b", sql):
            need(name)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n][0].strip()})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
