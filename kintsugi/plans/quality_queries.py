"""Catalogue: contract issues and scores, trusted-copy comparison, rubrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kintsugi.operators import compare, contract, repair
from kintsugi.plans.registry import query
from kintsugi.plans.repair_queries import STRIP_SQL
from kintsugi.session import materialize, row_counts
from kintsugi.sources import fixtures as fx

# ------------------------------------------------------------ scenario ----

SCHEMA = {
    "orders": {"o_orderkey": "int64", "o_custkey": "int64", "o_totalprice": "float64",
               "o_orderdate": "datetime64[ns]"},
    "sessions": {"session_id": "int64", "user_id": "int64", "session_duration": "float64",
                 "page_views": "int64"},
    "orders_dup": {"o_orderkey": "int64", "cust_key": "int64", "order_status": "object",
                   "total_price": "float64"},
    "user_summary": {"session_id": "int64", "plan": "object", "region": "object"},
}


def _count(df: DataFrame) -> int:
    """Row count as a number: contract constants are used in several
    expressions, so they are computed once instead of as repeated scalar
    subqueries."""
    return df.count()


def scenario(t):
    """Broken live tables plus a contract whose row counts come from data."""
    # sessions_dirty is an aggregate of events: materialise it once, since the
    # contract passes and the counts read it several times
    live = {"orders": fx.orders_dirty(t), "sessions": materialize(fx.sessions_dirty(t)),
            "orders_dup": fx.orders_dup(t).filter(F.col("orderStatus") == "F")}
    n_orders, n_sessions, n_dirty, n_sdirty, n_dup = row_counts(
        t["orders"], fx.sessions_clean(t), live["orders"], live["sessions"], fx.orders_dup(t))
    c = contract.Contract(
        schema=SCHEMA,
        expected_rows={"orders": n_orders, "sessions": n_sessions, "orders_dup": n_orders,
                       "user_summary": n_sessions},
        initial_rows={"orders": n_dirty, "sessions": n_sdirty, "orders_dup": n_dup})
    return live, c


_ODF = "(SELECT * FROM orders_dup WHERE orderStatus = 'F')"


def _null_issue(t, view, col, miss):
    return (f"SELECT '{t}' AS table_name, '{col}' AS column_name, 'nulls' AS check_name, '0' AS expected, "
            f"CAST(n AS VARCHAR) AS actual, n, printf('''%s''.''%s'' has %d null value(s)', '{t}', '{col}', n) "
            f"AS message FROM (SELECT CAST(count_if({miss}) AS BIGINT) AS n FROM {view}) WHERE n > 0")


def _lit_issue(t, col, check, exp, act, msg):
    esc = msg.replace("'", "''")
    colv = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
    actv = f"'{act}'" if act else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{t}', {colv}, '{check}', '{exp}', {actv}, CAST(NULL AS BIGINT), '{esc}'")


def _dup_issue(t, view, cols):
    return (f"SELECT '{t}', CAST(NULL AS VARCHAR), 'duplicates', '0', CAST(d AS VARCHAR), d, "
            f"printf('''%s'' has %d duplicate row(s)', '{t}', d) FROM (SELECT CAST(coalesce(sum(n - 1), 0) "
            f"AS BIGINT) AS d FROM (SELECT count(*) AS n FROM {view} GROUP BY {cols})) WHERE d > 0")


def _overclean_issue(t, view, init_view):
    return (f"SELECT '{t}', CAST(NULL AS VARCHAR), 'over_clean', CAST(i AS VARCHAR), CAST(r AS VARCHAR), "
            f"i - r, printf('WARNING: ''%s'' lost %d rows (%d%% of original) — possible over-filtering', "
            f"'{t}', i - r, CAST(round((i - r) * 100.0 / i) AS BIGINT)) FROM (SELECT (SELECT count(*) "
            f"FROM {init_view}) AS i, (SELECT count(*) FROM {view}) AS r) WHERE i > 0 AND r < i * 0.75")


ISSUES_SQL = "\nUNION ALL\n".join([
    _null_issue("orders", "orders_dirty", "o_orderkey", "(o_orderkey IS NULL OR isnan(o_orderkey))"),
    _null_issue("orders", "orders_dirty", "o_custkey", "o_custkey IS NULL"),
    _null_issue("orders", "orders_dirty", "o_totalprice", "o_totalprice IS NULL"),
    _null_issue("orders", "orders_dirty", "o_orderdate", "o_orderdate IS NULL"),
    _lit_issue("orders", "o_orderkey", "dtype", "int64", "float64",
               "'orders'.'o_orderkey' dtype mismatch: expected=int64, actual=float64"),
    _lit_issue("orders", "o_custkey", "dtype", "int64", "object",
               "'orders'.'o_custkey' dtype mismatch: expected=int64, actual=object"),
    _lit_issue("orders", "o_totalprice", "dtype", "float64", "object",
               "'orders'.'o_totalprice' dtype mismatch: expected=float64, actual=object"),
    _dup_issue("orders", "orders_dirty",
               "o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, o_orderdate"),
    _overclean_issue("orders", "orders_dirty", "orders_dirty"),
    _null_issue("sessions", "sessions_dirty", "session_id", "(session_id IS NULL OR isnan(session_id))"),
    _null_issue("sessions", "sessions_dirty", "user_id", "(user_id IS NULL OR isnan(user_id))"),
    _null_issue("sessions", "sessions_dirty", "session_duration", "session_duration IS NULL"),
    _null_issue("sessions", "sessions_dirty", "page_views", "page_views IS NULL"),
    _lit_issue("sessions", "session_id", "dtype", "int64", "float64",
               "'sessions'.'session_id' dtype mismatch: expected=int64, actual=float64"),
    _lit_issue("sessions", "user_id", "dtype", "int64", "float64",
               "'sessions'.'user_id' dtype mismatch: expected=int64, actual=float64"),
    _lit_issue("sessions", "session_duration", "dtype", "float64", "object",
               "'sessions'.'session_duration' dtype mismatch: expected=float64, actual=object"),
    _dup_issue("sessions", "sessions_dirty", "session_id, user_id, session_duration, page_views"),
    _overclean_issue("sessions", "sessions_dirty", "sessions_dirty"),
    _null_issue("orders_dup", _ODF, "o_orderkey", "o_orderkey IS NULL"),
    _lit_issue("orders_dup", "cust_key", "missing_column", "int64", None,
               "'orders_dup' is missing expected column 'cust_key'"),
    _lit_issue("orders_dup", "order_status", "missing_column", "object", None,
               "'orders_dup' is missing expected column 'order_status'"),
    _lit_issue("orders_dup", "total_price", "missing_column", "float64", None,
               "'orders_dup' is missing expected column 'total_price'"),
    _dup_issue("orders_dup", _ODF, "o_orderkey, custKey, orderStatus, totalPrice"),
    _overclean_issue("orders_dup", _ODF, "orders_dup"),
    _lit_issue("user_summary", None, "missing_table", "present", "absent", "'user_summary' is missing"),
])


@query("issues", ISSUES_SQL)
def issues(t):
    live, c = scenario(t)
    return contract.issues(live, c)


@query("issues_one_table", f"SELECT * FROM ({ISSUES_SQL}) WHERE table_name = 'sessions'")
def issues_one_table(t):
    live, c = scenario(t)
    return contract.validate_table(live, c, "sessions")


CONTRACT_SCORES_SQL = f"""
WITH v AS (
  SELECT (CAST(count_if(o_orderkey IS NULL OR isnan(o_orderkey)) = 0 AS INT)
          + CAST(count_if(o_custkey IS NULL) = 0 AS INT) + CAST(count_if(o_totalprice IS NULL) = 0 AS INT)
          + CAST(count_if(o_orderdate IS NULL) = 0 AS INT)
          + CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM orders_dirty
                  GROUP BY o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, o_orderdate)) = 0 AS INT)) AS passed,
         5 AS total FROM orders_dirty
  UNION ALL
  SELECT (CAST(count_if(session_id IS NULL OR isnan(session_id)) = 0 AS INT)
          + CAST(count_if(user_id IS NULL OR isnan(user_id)) = 0 AS INT)
          + CAST(count_if(session_duration IS NULL) = 0 AS INT) + CAST(count_if(page_views IS NULL) = 0 AS INT)
          + CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM sessions_dirty
                  GROUP BY session_id, user_id, session_duration, page_views)) = 0 AS INT)), 5
  FROM sessions_dirty
  UNION ALL
  SELECT (CAST(count_if(o_orderkey IS NULL) = 0 AS INT)
          + CAST((SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM {_ODF} x
                  GROUP BY o_orderkey, custKey, orderStatus, totalPrice)) = 0 AS INT)), 2
  FROM {_ODF} y),
r AS (
  SELECT CAST(rows AS DOUBLE) AS rows, CAST(e AS DOUBLE) AS e, CAST(i AS DOUBLE) AS i FROM (
    SELECT (SELECT count(*) FROM orders_dirty) AS rows, (SELECT count(*) FROM orders) AS e,
           (SELECT count(*) FROM orders_dirty) AS i
    UNION ALL SELECT (SELECT count(*) FROM sessions_dirty), (SELECT count(*) FROM sessions_clean),
           (SELECT count(*) FROM sessions_dirty)
    UNION ALL SELECT (SELECT count(*) FROM {_ODF} z), (SELECT count(*) FROM orders),
           (SELECT count(*) FROM orders_dup))),
rs AS (SELECT CASE WHEN i > 0 AND rows < i * 0.75 THEN greatest(0.0, 0.5 - (1 - rows / i))
                   WHEN e = 0 THEN CASE WHEN rows = 0 THEN 1.0 ELSE 0.5 END
                   ELSE greatest(0.0, 1 - abs(rows / e - 1)) END AS s FROM r)
SELECT CAST(0.2 AS DOUBLE) AS schema_score,
       round((SELECT sum(passed) / sum(total) FROM v), 6) AS validity_score,
       round((SELECT sum(s) FROM rs) / 4.0, 6) AS row_integrity"""


def _round_scores(df):
    return df.select(F.round("schema_score", 6).alias("schema_score"),
                     F.round("validity_score", 6).alias("validity_score"),
                     F.round("row_integrity", 6).alias("row_integrity"))


@query("contract_scores", CONTRACT_SCORES_SQL)
def contract_scores(t):
    live, c = scenario(t)
    return _round_scores(contract.contract_scores(live, c))


# ---------------------------------------------------------- comparison ----

def repaired_orders(t) -> DataFrame:
    d = fx.orders_dirty(t)
    d = repair.cast_column(d, "o_orderkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_custkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_totalprice", "float64")
    d = repair.fill_nulls(d, "o_totalprice", strategy="mean")
    return repair.strip_column(d, "o_orderpriority")


REPAIRED_ORDERS_SQL = f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(trim(o_custkey) AS BIGINT) AS o_custkey,
       coalesce(TRY_CAST(trim(o_totalprice) AS DOUBLE),
                (SELECT avg(TRY_CAST(trim(o_totalprice) AS DOUBLE)) FROM orders_dirty)) AS o_totalprice,
       o_orderstatus, {STRIP_SQL.format(c='o_orderpriority')} AS o_orderpriority, o_orderdate
FROM orders_dirty"""


def num_match(t, a, t_missing, a_missing):
    return (f"coalesce(abs(coalesce({t}, 0) - coalesce({a}, 0)) <= 0.01 + 0.01 * abs(coalesce({a}, 0)) "
            f"AND (({t_missing}) = ({a_missing})), false)")


def text_match(t, a):
    return f"(coalesce(CAST({t} AS VARCHAR), 'None') = coalesce(CAST({a} AS VARCHAR), 'None'))"


def time_match(t, a):
    return f"coalesce(abs(epoch_us({t}) - epoch_us({a})) < 172800000000, false)"


def keyed_sql(live_sql: str, trusted_sql: str, key: str, live_cols: list[str],
              matches: dict[str, str], per_column: bool = False) -> str:
    """Oracle of ``compare_keyed`` / ``compare_columns``: ``matches`` maps a
    column to its match SQL over ``t.<c>`` and ``l.<c>``."""
    rest = [c for c in live_cols if c != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    n = len(matches)
    cells = " + ".join(f"CAST(m_{i} AS INT)" for i in range(n))
    mcols = ", ".join(f"(l.__p IS NOT NULL AND {m}) AS m_{i}" for i, m in enumerate(matches.values()))
    head = f"""WITH live AS ({live_sql}), trusted AS ({trusted_sql}),
lk AS (SELECT {key}, count(*) AS n FROM live GROUP BY {key}),
ld AS (SELECT *, 1 AS __p FROM live QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1),
m AS (SELECT l.__p IS NOT NULL AS present, {mcols}
      FROM trusted t LEFT JOIN ld l ON t.{key} IS NOT DISTINCT FROM l.{key})"""
    if per_column:
        parts = [f"SELECT '{c}' AS column_name, CAST(count_if(m_{i}) AS BIGINT) AS matched, count(*) AS total FROM m"
                 for i, c in enumerate(matches)]
        return head + "\n" + "\nUNION ALL\n".join(parts)
    return head + f"""
SELECT count(*) AS trusted_rows, (SELECT CAST(sum(n) AS BIGINT) FROM lk) AS live_rows,
       {n} AS compared_columns, CAST(coalesce(sum({cells}), 0) AS BIGINT) AS matched_cells,
       count(*) * {n} AS total_cells, CAST(count_if(NOT present) AS BIGINT) AS missing_keys,
       (SELECT count(*) FROM lk) - CAST(count_if(present) AS BIGINT) AS extra_rows,
       (SELECT CAST(count_if(n > 1) AS BIGINT) FROM lk) AS duplicate_live_keys,
       CASE WHEN count(*) > 0 THEN round(sum({cells}) / (count(*) * {n}), 4) ELSE 0.0 END AS score
FROM m"""


_ORDER_MATCHES = {
    "o_orderkey": num_match("t.o_orderkey", "l.o_orderkey", "t.o_orderkey IS NULL", "l.o_orderkey IS NULL"),
    "o_custkey": num_match("t.o_custkey", "l.o_custkey", "t.o_custkey IS NULL", "l.o_custkey IS NULL"),
    "o_orderstatus": text_match("t.o_orderstatus", "l.o_orderstatus"),
    "o_totalprice": num_match("t.o_totalprice", "l.o_totalprice", "t.o_totalprice IS NULL",
                              "l.o_totalprice IS NULL"),
    "o_orderdate": time_match("t.o_orderdate", "l.o_orderdate"),
    "o_orderpriority": text_match("t.o_orderpriority", "l.o_orderpriority"),
}
_ORDER_LIVE_COLS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
                    "o_orderdate"]


@query("compare_keyed", keyed_sql(REPAIRED_ORDERS_SQL, "SELECT * FROM orders", "o_orderkey",
                                  _ORDER_LIVE_COLS, _ORDER_MATCHES))
def compare_keyed(t):
    return compare.compare_keyed(repaired_orders(t), t["orders"], "o_orderkey")


@query("compare_columns", keyed_sql(REPAIRED_ORDERS_SQL, "SELECT * FROM orders", "o_orderkey",
                                    _ORDER_LIVE_COLS, _ORDER_MATCHES, per_column=True))
def compare_columns(t):
    return compare.compare_columns(repaired_orders(t), t["orders"], "o_orderkey")


_SHIFTED_SQL = "SELECT o_orderkey, o_orderdate + to_days(CAST(o_orderkey % 4 AS INTEGER)) AS o_orderdate FROM orders"


@query("compare_datetime", keyed_sql(
    _SHIFTED_SQL, "SELECT o_orderkey, o_orderdate FROM orders", "o_orderkey",
    ["o_orderkey", "o_orderdate"],
    {"o_orderkey": _ORDER_MATCHES["o_orderkey"], "o_orderdate": time_match("t.o_orderdate", "l.o_orderdate")},
    per_column=True))
def compare_datetime(t):
    o = t["orders"]
    live = o.select("o_orderkey", F.timestamp_add("DAY", (F.col("o_orderkey") % 4).cast("int"),
                                                  F.col("o_orderdate")).alias("o_orderdate"))
    return compare.compare_columns(live, o.select("o_orderkey", "o_orderdate"), "o_orderkey")


def _sessions_live(t):
    return repair.cast_column(fx.sessions_dirty(t), "session_duration", "float64")


_SESS_LIVE_SQL = """SELECT session_id, user_id, TRY_CAST(trim(session_duration) AS DOUBLE) AS session_duration,
       page_views FROM sessions_dirty"""
_SESS_POS_SQL = f"""WITH a AS (SELECT *, row_number() OVER (ORDER BY user_id ASC NULLS FIRST, session_id ASC NULLS FIRST,
                         session_duration ASC NULLS FIRST, page_views ASC NULLS FIRST) AS pos
           FROM ({_SESS_LIVE_SQL})),
     t AS (SELECT *, row_number() OVER (ORDER BY session_id) AS pos FROM sessions_clean),
     j AS (SELECT t.session_id AS t_sid, t.user_id AS t_uid, t.session_duration AS t_dur, t.page_views AS t_pv,
                  a.session_id AS a_sid, a.user_id AS a_uid, a.session_duration AS a_dur, a.page_views AS a_pv
           FROM t JOIN a ON t.pos = a.pos)"""
_SESS_ORDER = ["user_id", "session_id", "session_duration", "page_views"]


def _sess_cells(null_rule: bool) -> str:
    def m(tc, ac, af):
        if null_rule:
            return num_match(tc, ac, f"{tc} IS NULL", f"({ac} IS NULL OR isnan({ac}))" if af else f"{ac} IS NULL")
        return f"coalesce(abs(coalesce({tc}, 0) - coalesce({ac}, 0)) <= 0.01 + 0.01 * abs(coalesce({ac}, 0)), false)"
    parts = [m("t_sid", "a_sid", True), m("t_uid", "a_uid", True), m("t_dur", "a_dur", True),
             m("t_pv", "a_pv", False)]
    if null_rule:
        return " + ".join(f"CAST({p} AS INT)" for p in parts)
    return " + ".join(f"CAST(NOT ({p}) AS INT)" for p in parts)


@query("compare_positional", _SESS_POS_SQL + f"""
SELECT (SELECT count(*) FROM sessions_clean) AS trusted_rows, (SELECT count(*) FROM sessions_dirty) AS live_rows,
       count(*) AS compared_rows, CAST(coalesce(sum({_sess_cells(True)}), 0) AS BIGINT) AS matched_cells,
       CASE WHEN count(*) > 0 THEN round(sum({_sess_cells(True)}) / ((SELECT count(*) FROM sessions_clean) * 4), 4)
            ELSE 0.0 END AS score
FROM j""")
def compare_positional(t):
    return compare.compare_positional(_sessions_live(t), fx.sessions_clean(t), _SESS_ORDER, ["session_id"])


@query("mismatch_ratio", _SESS_POS_SQL + f"""
SELECT CASE WHEN count(*) > 0 THEN round(sum({_sess_cells(False)}) / (count(*) * 4), 6) ELSE 0.0 END
       AS mismatch_ratio
FROM j""")
def mismatch_ratio(t):
    return compare.mismatch_ratio(_sessions_live(t), fx.sessions_clean(t), _SESS_ORDER, ["session_id"])


# The three contract scores under their own names (same plan, one column each).
def _one_score(name):
    @query(name, f"SELECT {name} FROM ({CONTRACT_SCORES_SQL})")
    def run(t):
        live, c = scenario(t)
        return _round_scores(contract.contract_scores(live, c)).select(name)
    return run


validity_score = _one_score("validity_score")
row_integrity = _one_score("row_integrity")
