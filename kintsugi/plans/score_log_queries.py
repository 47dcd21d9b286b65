"""Catalogue: rubrics, scorecards, action-log accounting, text logs, set ops."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kintsugi.functions.nulls import is_missing
from kintsugi.functions.text import is_padded, strip
from kintsugi.functions.types import dtype_matches, dtype_name
from kintsugi.operators import actionlog, compare, contract, joins, repair, setops
from kintsugi.operators.score import (Check, Rubric, average_scores, final_blend, flag, row_credit, success,
                                      weighted_total)
from kintsugi.plans.quality_queries import (CONTRACT_SCORES_SQL, REPAIRED_ORDERS_SQL, keyed_sql,
                                            num_match, scenario, text_match)
from kintsugi.plans.registry import query
from kintsugi.plans.repair_queries import STRIP_SQL
from kintsugi.sources import fixtures as fx
from kintsugi.sources import runlog


def _count(df) -> int:
    # constants used by several checks: one count job, then a literal
    return df.count()


def _score(df) -> float:
    # a value-match score feeds the rubric, the output and the blend: evaluate once
    return float(df.select("score").first().score)


def _has_type(df, col, expected) -> float:
    return 1.0 if (col in df.columns and dtype_matches(dtype_name(df.schema[col].dataType), expected)) \
        else 0.0


def _present(df, *cols) -> float:
    return 1.0 if all(c in df.columns for c in cols) else 0.0


def _stages(rows):
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# Rubric weights and tolerances of the four repair tasks.
TYPES_W = {"dtype": 0.20, "no_nulls": 0.15, "rows": 0.10}
TYPES_ROW_TOL = 2
RENAME_W = {"new_name": 0.15, "old_name_gone": 0.10, "no_duplicates": 0.20, "dtype": 0.15,
            "rows": 0.10, "keys_no_nulls": 0.05}
RENAME_ROW_TOL = 2
JOIN_W = {"rows": 0.30, "key_filled": 0.15, "customer_key": 0.15, "total_dtype": 0.10,
          "name": 0.10, "total_no_nulls": 0.10, "value_match": 0.10}
JOIN_ROW_TOL = 2
JOIN_MIN_SHARE = 0.9          # rows under this share of the expected count score 0
JOIN_NO_COPY = 0.5            # value-match credit where there is no trusted copy
JOIN_ABSENT_W = {"inputs": 0.05, "key_renamed": 0.03, "key_integer": 0.02}
JOIN_ABSENT_CAP = 0.15        # most that the inputs earn without a result
CASCADE_W = {"unpadded": 0.10, "valid_types": 0.15, "duration_dtype": 0.10, "session_ids": 0.10,
             "user_dtype": 0.10, "prereq": 0.05, "summary_exists": 0.15, "summary_rows": 0.10,
             "join_columns": 0.10, "value_match": 0.10}
CASCADE_ROW_TOL = 5
BASE_NULL_RATE = 0.10         # null rate of the broken session ids

_RC = "CASE WHEN abs(rows - e) <= {tol} THEN 1.0 ELSE greatest(0.0, 1 - abs(rows / e - 1)) END"

# --------------------------------------------------------------- rubrics ----


def types_rubric(df: DataFrame, expected_rows) -> tuple[Rubric, DataFrame]:
    miss = lambda c: F.count_if(is_missing(c, df.schema[c].dataType)) if c in df.columns \
        else F.lit(None)
    facts = df.agg(F.count(F.lit(1)).alias("rows"), miss("o_totalprice").alias("tn"),
                   miss("o_custkey").alias("cn"))
    checks = [
        Check("o_orderkey_int64", TYPES_W["dtype"], F.lit(_has_type(df, "o_orderkey", "int64"))),
        Check("o_totalprice_float64", TYPES_W["dtype"], F.lit(_has_type(df, "o_totalprice", "float64"))),
        Check("o_custkey_int64", TYPES_W["dtype"], F.lit(_has_type(df, "o_custkey", "int64"))),
        Check("o_totalprice_no_nulls", TYPES_W["no_nulls"], flag(F.col("tn") == 0)),
        Check("o_custkey_no_nulls", TYPES_W["no_nulls"], flag(F.col("cn") == 0)),
        Check("rows_kept", TYPES_W["rows"], row_credit(F.col("rows"), expected_rows, TYPES_ROW_TOL)),
    ]
    return Rubric(checks), facts


def _repaired_types(t):
    d = fx.orders_dirty(t)
    d = repair.cast_column(d, "o_orderkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_custkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_totalprice", "float64")
    return repair.fill_nulls(d, "o_totalprice", strategy="mean")


@query("rubric_types", f"""
WITH after AS ({REPAIRED_ORDERS_SQL}),
e AS (SELECT CAST(count(*) AS DOUBLE) AS e FROM orders),
fb AS (SELECT CAST(count(*) AS DOUBLE) AS rows, count_if(o_totalprice IS NULL) AS tn,
              count_if(o_custkey IS NULL) AS cn FROM orders_dirty),
fa AS (SELECT CAST(count(*) AS DOUBLE) AS rows, count_if(o_totalprice IS NULL) AS tn,
              count_if(o_custkey IS NULL) AS cn FROM after)
SELECT 'before' AS stage,
       round(least(1.0, 0.15 * CAST(tn = 0 AS INT) + 0.15 * CAST(cn = 0 AS INT)
                        + 0.10 * {_RC.format(tol=2)}), 4) AS score FROM fb, e
UNION ALL
SELECT 'after', round(least(1.0, 0.60 + 0.15 * CAST(tn = 0 AS INT) + 0.15 * CAST(cn = 0 AS INT)
                             + 0.10 * {_RC.format(tol=2)}), 4) FROM fa, e""")
def rubric_types(t):
    expected = F.lit(_count(t["orders"]))
    rows = []
    for stage, df in (("before", fx.orders_dirty(t)), ("after", _repaired_types(t))):
        rub, facts = types_rubric(df, expected)
        rows.append(facts.select(F.lit(stage).alias("stage"), rub.total_expr().alias("score")))
    return _stages(rows)


def rename_dedup_rubric(df: DataFrame, expected_rows) -> tuple[Rubric, DataFrame]:
    keys = [c for c in ("cust_key", "order_status", "total_price") if c in df.columns]
    dup = F.lit(repair.dedup_report(df).first().dropped)
    key_nulls = sum((F.count_if(is_missing(c, df.schema[c].dataType)) for c in keys), F.lit(0))
    facts = df.agg(F.count(F.lit(1)).alias("rows"), key_nulls.alias("kn")).withColumn("dups", dup)
    checks = [
        Check("cust_key_present", RENAME_W["new_name"], F.lit(_present(df, "cust_key"))),
        Check("order_status_present", RENAME_W["new_name"], F.lit(_present(df, "order_status"))),
        Check("custKey_gone", RENAME_W["old_name_gone"], F.lit(1.0 - _present(df, "custKey"))),
        Check("orderStatus_gone", RENAME_W["old_name_gone"], F.lit(1.0 - _present(df, "orderStatus"))),
        Check("no_duplicates", RENAME_W["no_duplicates"], flag(F.col("dups") == 0)),
        Check("total_price_float64", RENAME_W["dtype"], F.lit(_has_type(df, "total_price", "float64"))),
        Check("rows_near_expected", RENAME_W["rows"], row_credit(F.col("rows"), expected_rows, RENAME_ROW_TOL)),
        Check("key_columns_no_nulls", RENAME_W["keys_no_nulls"], flag(F.col("kn") == 0) if keys else F.lit(0.0)),
    ]
    return Rubric(checks), facts


def _repaired_dup(t):
    d = repair.snake_case_columns(fx.orders_dup(t))
    d = repair.drop_duplicates(d)
    return repair.cast_column(d, "total_price", "float64")


@query("rubric_rename_dedup", f"""
WITH e AS (SELECT CAST(count(*) AS DOUBLE) AS e FROM orders),
fb AS (SELECT CAST((SELECT count(*) FROM orders_dup) AS DOUBLE) AS rows,
              (SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM orders_dup
               GROUP BY o_orderkey, custKey, orderStatus, totalPrice)) AS dups),
after AS (SELECT DISTINCT o_orderkey, custKey AS cust_key, orderStatus AS order_status,
                 TRY_CAST(trim(totalPrice) AS DOUBLE) AS total_price FROM orders_dup),
fa AS (SELECT CAST(count(*) AS DOUBLE) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM after)) AS dups,
              count_if(cust_key IS NULL) + count_if(order_status IS NULL)
              + count_if(total_price IS NULL OR isnan(total_price)) AS kn FROM after)
SELECT 'before' AS stage,
       round(least(1.0, 0.20 * CAST(dups = 0 AS INT) + 0.10 * {_RC.format(tol=2)}), 4) AS score FROM fb, e
UNION ALL
SELECT 'after', round(least(1.0, 0.15 + 0.15 + 0.10 + 0.10 + 0.20 * CAST(dups = 0 AS INT) + 0.15
                             + 0.10 * {_RC.format(tol=2)} + 0.05 * CAST(kn = 0 AS INT)), 4) FROM fa, e""")
def rubric_rename_dedup(t):
    expected = F.lit(_count(t["orders"]))
    rows = []
    for stage, df in (("before", fx.orders_dup(t)), ("after", _repaired_dup(t))):
        rub, facts = rename_dedup_rubric(df, expected)
        rows.append(facts.select(F.lit(stage).alias("stage"), rub.total_expr().alias("score")))
    return _stages(rows)


def absent_join_rubric(spark, inputs: dict[str, DataFrame], left: str, right: str, renamed: str, raw: str):
    """What a join task without a result earns: both inputs, and the left key's name and type."""
    keyed = inputs.get(left)
    both = float(left in inputs and right in inputs)
    checks = [Check("inputs_present", JOIN_ABSENT_W["inputs"], F.lit(both)),
              Check("key_renamed", JOIN_ABSENT_W["key_renamed"], F.lit(_present(keyed, renamed) if keyed is not None else 0.0)),
              Check("key_integer", JOIN_ABSENT_W["key_integer"], F.lit(_has_type(keyed, raw, "int64") if keyed is not None else 0.0))]
    return Rubric(checks, cap=JOIN_ABSENT_CAP), spark.range(1)


def join_rubric(final: DataFrame, expected_rows, value_match=None, min_share: float = JOIN_MIN_SHARE):
    """``value_match`` None: there is no trusted copy, which earns a fixed part of that check."""
    total = is_missing("o_totalprice", final.schema["o_totalprice"].dataType) if "o_totalprice" in final.columns else F.lit(True)
    key = F.col("o_orderkey").isNull() if "o_orderkey" in final.columns else F.lit(True)
    facts = final.agg(F.count(F.lit(1)).alias("rows"), F.count_if(key).alias("kn"), F.count_if(total).alias("tn"))
    value_match = F.lit(JOIN_NO_COPY) if value_match is None else value_match
    rows, exp = F.col("rows").cast("double"), expected_rows.cast("double")
    within = F.abs(rows - exp) <= JOIN_ROW_TOL
    checks = [
        Check("rows", JOIN_W["rows"], F.when(within, 1.0).otherwise(
            F.greatest(F.lit(0.0), 1 - F.abs(rows / exp - 1)))),
        Check("order_key_filled", JOIN_W["key_filled"], F.when(rows > 0, 1 - F.col("kn") / rows).otherwise(0.0)),
        Check("customer_key_present", JOIN_W["customer_key"], F.lit(_present(final, "c_custkey"))),
        Check("total_float64", JOIN_W["total_dtype"], F.lit(_has_type(final, "o_totalprice", "float64"))),
        Check("name_present", JOIN_W["name"], F.lit(_present(final, "c_name"))),
        Check("total_no_nulls", JOIN_W["total_no_nulls"], flag(F.col("tn") == 0)),
        Check("value_match", JOIN_W["value_match"], value_match),
    ]
    return Rubric(checks, gate=(~within) & (rows < exp * min_share)), facts


def _join_trusted(t):
    cust = t["customer"].select("c_custkey", "c_name")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.safe_join(o, cust, ("o_custkey", "c_custkey"), "inner") \
        .select("o_orderkey", "o_custkey", "o_totalprice", "c_name")


_JOIN_TRUSTED_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, c_name
FROM orders JOIN customer ON o_custkey IS NOT DISTINCT FROM c_custkey"""
_JOIN_MATCHES = {
    "o_orderkey": num_match("t.o_orderkey", "l.o_orderkey", "t.o_orderkey IS NULL", "l.o_orderkey IS NULL"),
    "o_custkey": num_match("t.o_custkey", "l.o_custkey", "t.o_custkey IS NULL", "l.o_custkey IS NULL"),
    "o_totalprice": num_match("t.o_totalprice", "l.o_totalprice", "t.o_totalprice IS NULL",
                              "l.o_totalprice IS NULL"),
    "c_name": text_match("t.c_name", "l.c_name"),
}


def _join_final_sql(how):
    return f"""SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_custkey, c.c_name
FROM orders_orphan o {how} JOIN (SELECT c_custkey, c_name FROM customer) c
  ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey"""


def _join_stage_sql(stage, how):
    vm = keyed_sql(_join_final_sql(how), _JOIN_TRUSTED_SQL, "o_orderkey",
                   ["o_orderkey", "o_custkey", "o_totalprice", "c_custkey", "c_name"], _JOIN_MATCHES)
    return f"""SELECT '{stage}' AS stage, rubric, vm AS value_match,
       round(0.85 * rubric + 0.15 * vm, 4) AS final_score
FROM (SELECT vm, CASE WHEN abs(rows - e) > 2 AND rows < e * 0.9 THEN 0.0 ELSE round(least(1.0,
          0.30 * CASE WHEN abs(rows - e) <= 2 THEN 1.0 ELSE greatest(0.0, 1 - abs(rows / e - 1)) END
          + 0.15 * CASE WHEN rows > 0 THEN 1 - kn / rows ELSE 0.0 END + 0.15 + 0.10 + 0.10
          + 0.10 * CAST(tn = 0 AS INT) + 0.10 * vm), 4) END AS rubric
      FROM (SELECT CAST(count(*) AS DOUBLE) AS rows, count_if(o_orderkey IS NULL) AS kn,
                   count_if(o_totalprice IS NULL OR isnan(o_totalprice)) AS tn
            FROM ({_join_final_sql(how)})) f,
           (SELECT CAST(count(*) AS DOUBLE) AS e FROM orders) x,
           (SELECT score AS vm FROM ({vm})) v)"""


_JOIN_ALL_SQL = "\nUNION ALL\n".join([_join_stage_sql("inner", "INNER"), _join_stage_sql("left", "LEFT"), f"""
SELECT 'no_copy', round(0.60 + 0.15 * (1 - kn / rows) + 0.10 * CAST(tn = 0 AS INT) + 0.05
       + 0.30 * CASE WHEN abs(rows - e) <= 2 THEN 1.0 ELSE greatest(0.0, 1 - abs(rows / e - 1)) END - 0.25, 4), NULL, NULL
FROM (SELECT CAST(count(*) AS DOUBLE) AS rows, count_if(o_orderkey IS NULL) AS kn,
             count_if(o_totalprice IS NULL OR isnan(o_totalprice)) AS tn FROM ({_join_final_sql("LEFT")})) f,
     (SELECT CAST(count(*) AS DOUBLE) AS e FROM orders) x""", """
SELECT 'absent', round(0.05 * CAST((SELECT count(*) > 0 FROM orders_orphan) AND (SELECT count(*) > 0 FROM customer) AS INT)
       + 0.02, 4), NULL, NULL"""])


@query("rubric_join", f"SELECT stage, rubric, value_match, coalesce(final_score, round(0.85 * rubric, 4)) AS final_score "
       f"FROM ({_JOIN_ALL_SQL}) s(stage, rubric, value_match, final_score)")
def rubric_join(t):
    expected = _count(t["orders"])
    cust = t["customer"].select("c_custkey", "c_name")
    trusted = _join_trusted(t)
    rows = []
    for stage in ("inner", "left"):
        final = joins.safe_join(fx.orders_orphan(t), cust, ("o_custkey", "c_custkey"), stage)
        vm = F.lit(_score(compare.compare_keyed(final, trusted, "o_orderkey")))
        rub, facts = join_rubric(final, F.lit(expected), vm)
        rows.append(facts.select(F.lit(stage).alias("stage"), rub.total_expr().alias("rubric"),
                                 vm.alias("value_match")))
    none = F.lit(None).cast("double").alias("value_match")
    final = joins.safe_join(fx.orders_orphan(t), cust, ("o_custkey", "c_custkey"), "left")
    rub, facts = join_rubric(final, F.lit(expected))
    rows.append(facts.select(F.lit("no_copy").alias("stage"), rub.total_expr().alias("rubric"), none))
    inputs = {"orders": fx.orders_orphan(t), "customer": t["customer"]}
    rub, facts = absent_join_rubric(cust.sparkSession, inputs, "orders", "customer", "c_custkey", "o_custkey")
    rows.append(facts.select(F.lit("absent").alias("stage"), rub.total_expr().alias("rubric"), none))
    return _stages(rows).withColumn("final_score", final_blend(
        F.col("rubric"), F.coalesce("value_match", F.lit(0.0))))


# cascade ---------------------------------------------------------------

def cascade_rubric(events: DataFrame, sessions: DataFrame, summary: DataFrame | None,
                   expected_summary_rows, value_match):
    ok = F.coalesce(strip("event_type").isin(list(fx.VALID_EVENT_TYPES)), F.lit(False))
    facts = events.agg(
        F.coalesce(F.bool_or(is_padded("event_type")), F.lit(False)).alias("padded"),
        F.count_if(F.col("event_type").isNotNull() & ~ok).alias("n_invalid"),
        F.count(F.lit(1)).alias("ev_rows"), F.avg(ok.cast("double")).alias("valid_share"))
    s_stats = sessions.agg(F.count(F.lit(1)).alias("r"),
                           F.count_if(is_missing("session_id", sessions.schema["session_id"].dataType))
                           .alias("n"))
    st = s_stats.first()
    facts = facts.withColumn("s_rows", F.lit(st.r)).withColumn("s_nulls", F.lit(st.n))
    s_rows = F.col("s_rows").cast("double")
    dur = _has_type(sessions, "session_duration", "float64")
    uid = _has_type(sessions, "user_id", "int64")
    checks = [
        Check("events_unpadded", CASCADE_W["unpadded"], flag(~F.col("padded"))),
        Check("events_valid_types", CASCADE_W["valid_types"], F.when(F.col("n_invalid") == 0, flag(F.col("ev_rows") > 0))
              .otherwise(F.coalesce(F.col("valid_share"), F.lit(0.0)))),
        Check("duration_float64", CASCADE_W["duration_dtype"], F.lit(dur)),
        Check("session_id_no_nulls", CASCADE_W["session_ids"], F.when(F.col("s_nulls") == 0, 1.0).otherwise(
            F.when(s_rows > 0, F.greatest(F.lit(0.0), BASE_NULL_RATE - F.col("s_nulls") / s_rows)
                   / BASE_NULL_RATE)
            .otherwise(0.0))),
        Check("user_id_int64", CASCADE_W["user_dtype"], F.lit(uid)),
    ]
    if summary is None:
        checks += [Check("prereq_user_id", CASCADE_W["prereq"], F.lit(uid)),
                   Check("prereq_duration", CASCADE_W["prereq"], F.lit(dur))]
    else:
        facts = facts.withColumn("sum_rows", F.lit(_count(summary)))
        checks += [
            Check("summary_exists", CASCADE_W["summary_exists"], F.lit(1.0)),
            Check("summary_rows", CASCADE_W["summary_rows"],
                  row_credit(F.col("sum_rows"), expected_summary_rows, CASCADE_ROW_TOL)),
            Check("join_columns", CASCADE_W["join_columns"], F.lit(_present(summary, "plan", "region"))),
            Check("value_match", CASCADE_W["value_match"], value_match),
        ]
    return Rubric(checks), facts


def cascade_after(t):
    ev = repair.strip_column(fx.events_padded(t), "event_type")
    ev = repair.filter_rows(ev, "event_type", "isin", list(fx.VALID_EVENT_TYPES))
    s = repair.filter_rows(fx.sessions_dirty(t), "session_id", "notnull")
    s = repair.cast_column(s, "session_id", "int64", on_error="fail")
    s = repair.cast_column(s, "user_id", "int64", on_error="fail")
    s = repair.cast_column(s, "session_duration", "float64")
    summary = joins.safe_join(s, fx.users(t), "user_id", "left")
    return ev, s, summary


def cascade_trusted(t):
    return joins.safe_join(fx.sessions_clean(t), fx.users(t), "user_id", "left")


_CASCADE_MATCHES = {
    "session_id": num_match("t.session_id", "l.session_id", "t.session_id IS NULL", "l.session_id IS NULL"),
    "user_id": num_match("t.user_id", "l.user_id", "t.user_id IS NULL", "l.user_id IS NULL"),
    "session_duration": num_match("t.session_duration", "l.session_duration",
                                  "(t.session_duration IS NULL OR isnan(t.session_duration))",
                                  "(l.session_duration IS NULL OR isnan(l.session_duration))"),
    "page_views": num_match("t.page_views", "l.page_views", "t.page_views IS NULL", "l.page_views IS NULL"),
    "plan": text_match("t.plan", "l.plan"),
    "region": text_match("t.region", "l.region"),
}
_S_AFTER_SQL = """SELECT CAST(session_id AS BIGINT) AS session_id, CAST(user_id AS BIGINT) AS user_id,
       TRY_CAST(trim(session_duration) AS DOUBLE) AS session_duration, page_views
FROM sessions_dirty WHERE session_id IS NOT NULL AND NOT isnan(session_id)"""
_SUMMARY_SQL = f"""SELECT s.session_id, s.user_id, s.session_duration, s.page_views, u.plan, u.region
FROM ({_S_AFTER_SQL}) s LEFT JOIN users u ON s.user_id IS NOT DISTINCT FROM u.user_id"""
_CASCADE_TRUSTED_SQL = """SELECT s.session_id, s.user_id, s.session_duration, s.page_views, u.plan, u.region
FROM sessions_clean s LEFT JOIN users u ON s.user_id IS NOT DISTINCT FROM u.user_id"""
_EV_OK = f"coalesce({STRIP_SQL.format(c='event_type')} IN ('click', 'view', 'purchase'), false)"


def _ev_facts_sql(events_sql):
    return f"""(SELECT coalesce(bool_or(event_type <> {STRIP_SQL.format(c='event_type')}), false) AS padded,
        count_if(event_type IS NOT NULL AND NOT {_EV_OK}) AS n_invalid, count(*) AS ev_rows,
        avg(CASE WHEN {_EV_OK} THEN 1.0 ELSE 0.0 END) AS valid_share FROM ({events_sql}))"""


def _sess_credit_sql(sessions_sql):
    return f"""(SELECT CASE WHEN n = 0 THEN 1.0 WHEN r > 0 THEN greatest(0.0, 0.10 - n / r) / 0.10 ELSE 0.0 END AS sc
      FROM (SELECT CAST(count(*) AS DOUBLE) AS r,
                   count_if(session_id IS NULL OR isnan(CAST(session_id AS DOUBLE))) AS n FROM ({sessions_sql})))"""


_EV_PART = ("0.10 * CAST(NOT padded AS INT) + 0.15 * CASE WHEN n_invalid = 0 THEN CAST(ev_rows > 0 AS INT) "
            "ELSE coalesce(valid_share, 0.0) END")


@query("rubric_cascade", f"""
SELECT 'before' AS stage, rubric, 0.0 AS value_match, round(0.85 * rubric + 0.15 * 0.0, 4) AS final_score
FROM (SELECT round(least(1.0, {_EV_PART} + 0.10 * 0 + 0.10 * sc + 0.10 * 0 + 0.05 * 0 + 0.05 * 0), 4) AS rubric
      FROM {_ev_facts_sql('SELECT * FROM events_padded')} ev, {_sess_credit_sql('SELECT * FROM sessions_dirty')} s)
UNION ALL
SELECT 'after', rubric, vm, round(0.85 * rubric + 0.15 * vm, 4)
FROM (SELECT vm, round(least(1.0, {_EV_PART} + 0.10 + 0.10 * sc + 0.10 + 0.15
                 + 0.10 * CASE WHEN abs(sr - e) <= 5 THEN 1.0 ELSE greatest(0.0, 1 - abs(sr / e - 1)) END
                 + 0.10 + 0.10 * vm), 4) AS rubric
      FROM {_ev_facts_sql("SELECT event_id, " + STRIP_SQL.format(c='event_type') + " AS event_type FROM events_padded WHERE " + STRIP_SQL.format(c='event_type') + " IN ('click', 'view', 'purchase')")} ev,
           {_sess_credit_sql(_S_AFTER_SQL)} s,
           (SELECT CAST(count(*) AS DOUBLE) AS sr FROM ({_SUMMARY_SQL})) x,
           (SELECT CAST(count(*) AS DOUBLE) AS e FROM sessions_clean) y,
           (SELECT score AS vm FROM ({keyed_sql(_SUMMARY_SQL, _CASCADE_TRUSTED_SQL, "session_id",
                                                list(_CASCADE_MATCHES), _CASCADE_MATCHES)})) v)""")
def rubric_cascade(t):
    expected = _count(fx.sessions_clean(t))
    rub, facts = cascade_rubric(fx.events_padded(t), fx.sessions_dirty(t), None, F.lit(expected),
                                F.lit(0.0))
    before = facts.select(F.lit("before").alias("stage"), rub.total_expr().alias("rubric"),
                          F.lit(0.0).alias("value_match"))
    ev, s, summary = cascade_after(t)
    vm = F.lit(_score(compare.compare_keyed(summary, cascade_trusted(t), "session_id")))
    rub, facts = cascade_rubric(ev, s, summary, F.lit(expected), vm)
    after = facts.select(F.lit("after").alias("stage"), rub.total_expr().alias("rubric"),
                         vm.alias("value_match"))
    out = before.unionByName(after)
    return out.withColumn("final_score", final_blend(F.col("rubric"), F.col("value_match")))


# ----------------------------------------------------------- action log ----

MAX_STEPS = 20
_COST_CASE = "CASE action_type " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in actionlog.ACTION_COSTS.items()) + " ELSE 1.0 END"
_KNOWN = ", ".join(f"'{a}'" for a in actionlog.KNOWN_ACTIONS)
_ANNOTATED_SQL = f"""a0 AS (SELECT *, CAST({_COST_CASE} AS DOUBLE) AS cost,
             CAST((NOT coalesce(valid, false)) OR NOT coalesce(action_type IN ({_KNOWN}), false) AS BIGINT) AS invalid,
             CAST(action_type IS NOT DISTINCT FROM 'finish' AS BIGINT) AS fin FROM action_log),
a1 AS (SELECT *, row_number() OVER w AS step, sum(cost) OVER w AS cum_cost,
              CAST(sum(invalid) OVER w AS BIGINT) AS cum_invalid, sum(fin) OVER w AS cum_fin
       FROM a0 WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
al AS (SELECT *, (cum_fin - fin = 0 AND step <= {MAX_STEPS}) AS active FROM a1)"""


def _annotated(t):
    return actionlog.annotate(fx.action_log(t), max_steps=MAX_STEPS)


_STEP_PEN_SQL = ("CAST(CASE WHEN step / {m}.0 <= 0.40 THEN 0.0 WHEN step / {m}.0 <= 0.70 THEN 0.10 "
                 "WHEN step / {m}.0 <= 0.90 THEN 0.20 ELSE 0.40 END AS DOUBLE)").format(m=MAX_STEPS)
_INV_PEN_SQL = "least(1.0, cum_invalid * CAST(0.15 AS DOUBLE))"
_COST_PEN_SQL = "CASE WHEN cum_cost <= 20.0 THEN 0.0 ELSE least(0.30, (cum_cost - 20.0) / 20.0 * 0.30) END"


@query("log_running_cost", f"""WITH {_ANNOTATED_SQL}
SELECT session_id, event_id, step, cost, cum_cost, cum_invalid FROM al""")
def log_running_cost(t):
    a = actionlog.annotate(fx.action_log(t), max_steps=MAX_STEPS, keep=["session_id", "event_id"])
    return a.select("session_id", "event_id", "step", "cost", "cum_cost", "cum_invalid")


@query("log_penalties", f"""WITH {_ANNOTATED_SQL}
SELECT session_id, event_id, step, {_STEP_PEN_SQL} AS step_pen, round({_INV_PEN_SQL}, 6) AS inv_pen,
       round({_COST_PEN_SQL}, 6) AS cost_pen
FROM al WHERE active""")
def log_penalties(t):
    p = actionlog.penalties(actionlog.annotate(fx.action_log(t), max_steps=MAX_STEPS, keep=["session_id", "event_id"]),
                            max_steps=MAX_STEPS)
    return p.select("session_id", "event_id", "step", "step_pen", F.round("inv_pen", 6).alias("inv_pen"),
                    F.round("cost_pen", 6).alias("cost_pen"))


SESSION_END_SQL = f"""WITH {_ANNOTATED_SQL}
SELECT session_id, max(CASE WHEN active THEN step END) AS end_step,
       CASE WHEN max(CASE WHEN active AND action_type = 'finish' THEN 1 END) = 1 THEN 'finish'
            WHEN max(CASE WHEN active THEN step END) >= {MAX_STEPS} THEN 'max_steps' ELSE 'open' END AS ended_by,
       count(*) AS actions, CAST(count_if(NOT active) AS BIGINT) AS ignored_actions
FROM al GROUP BY session_id"""


@query("log_session_end", SESSION_END_SQL)
def log_session_end(t):
    return actionlog.session_end(_annotated(t), max_steps=MAX_STEPS)


@query("log_audit", f"""WITH {_ANNOTATED_SQL}
SELECT session_id, step,
       printf('[Step %02d] %s(%s) → %s', step, coalesce(action_type, 'None'), coalesce(params_json, '{{}}'),
              substring(CASE WHEN invalid = 1 THEN 'ERROR: invalid action ' || coalesce(action_type, 'None')
                             ELSE 'OK: ' || action_type END, 1, 120)) AS line
FROM al WHERE active AND action_type IS DISTINCT FROM 'finish'""")
def log_audit(t):
    return actionlog.audit(_annotated(t))


@query("log_summary", f"""WITH {_ANNOTATED_SQL}
SELECT session_id, max(step) AS steps, max(cum_cost) AS cost_used, max(cum_invalid) AS invalid_actions,
       list(cum_cost ORDER BY step) AS cost_trace
FROM al WHERE active GROUP BY session_id""")
def log_summary(t):
    return actionlog.summary(_annotated(t))


def _required_sql():
    cases = " ".join(
        f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v)}]::VARCHAR[]" if v else f"WHEN '{k}' THEN []::VARCHAR[]"
        for k, v in actionlog.REQUIRED_PARAMS.items())
    return f"CASE action_type {cases} ELSE []::VARCHAR[] END"


@query("log_required_params", f"""
SELECT session_id, event_id, action_type, missing, CAST(len(missing) AS INTEGER) AS n_missing
FROM (SELECT session_id, event_id, action_type,
             list_filter({_required_sql()}, lambda x: NOT list_contains(coalesce(json_keys(params_json), []), x))
               AS missing
      FROM action_log)""")
def log_required_params(t):
    return actionlog.required_params_missing(fx.action_log(t))


@query("scorecard", "SELECT *, coalesce(total >= 0.1, false) AS success FROM (" + f"""WITH {_ANNOTATED_SQL},
cs AS ({CONTRACT_SCORES_SQL}),
s AS (SELECT session_id, max(step) AS step, max(cum_invalid) AS cum_invalid, max(cum_cost) AS cum_cost
      FROM al WHERE active GROUP BY session_id)
SELECT session_id, step AS steps, cum_invalid AS invalid_actions, cum_cost AS cost_used,
       {_STEP_PEN_SQL} AS step_pen, round({_INV_PEN_SQL}, 6) AS inv_pen, round({_COST_PEN_SQL}, 6) AS cost_pen,
       round(greatest(0.0, least(1.0, 0.30 * cs.schema_score + 0.30 * cs.validity_score + 0.30 * cs.row_integrity
             - 0.05 * ({_STEP_PEN_SQL}) - 0.05 * {_INV_PEN_SQL} - ({_COST_PEN_SQL}))), 4) AS total
FROM s, cs""" + ")")
def scorecard(t):
    live, c = scenario(t)
    # one row of three numbers, used in every session's total: evaluate once
    scores = contract.contract_scores(live, c).first()
    sc = {k: F.lit(round(float(scores[k]), 6)) for k in ("schema_score", "validity_score", "row_integrity")}
    per = actionlog.summary(_annotated(t)).select(
        "session_id", F.col("steps"), F.col("invalid_actions"), F.col("cost_used"))
    sp = actionlog.step_penalty(F.col("steps"), MAX_STEPS)
    ip = actionlog.invalid_penalty(F.col("invalid_actions"))
    cp = actionlog.cost_penalty(F.col("cost_used"))
    total = weighted_total(sc["schema_score"], sc["validity_score"], sc["row_integrity"], sp, ip, cp)
    return per.select("session_id", "steps", "invalid_actions", "cost_used", sp.alias("step_pen"),
                      F.round(ip, 6).alias("inv_pen"), F.round(cp, 6).alias("cost_pen"),
                      F.round(total, 4).alias("total"), success(F.round(total, 4)).alias("success"))


# -------------------------------------------------------------- text logs ----

def _step_lines(t):
    a = _annotated(t).filter("active")
    done = F.col("action_type").eqNullSafe("finish") | (F.col("step") == MAX_STEPS)
    a = a.withColumn("action_type", F.coalesce("action_type", F.lit("None")))
    err = F.when(F.col("invalid") == 1, F.lit("invalid_action"))
    return a.select("session_id", "event_id", runlog.format_step_lines(
        a, "step", "action_type", "cum_cost", done, err).alias("line"))


_STEP_RE = runlog.STEP_RE.replace("'", "''")


@query("log_extract_steps", f"""WITH {_ANNOTATED_SQL},
lines AS (SELECT session_id, event_id,
                 printf('[STEP] step=%d action=%s reward=%.2f done=%s error=%s', step, coalesce(action_type, 'None'), cum_cost,
                        CASE WHEN action_type = 'finish' OR step = {MAX_STEPS} THEN 'true' ELSE 'false' END,
                        CASE WHEN invalid = 1 THEN 'invalid_action' ELSE 'null' END) AS line
          FROM al WHERE active)
SELECT session_id, event_id, CAST(regexp_extract(line, '{_STEP_RE}', 1) AS BIGINT) AS step,
       regexp_extract(line, '{_STEP_RE}', 2) AS action,
       CAST(regexp_extract(line, '{_STEP_RE}', 3) AS DOUBLE) AS reward,
       regexp_extract(line, '{_STEP_RE}', 4) = 'true' AS done,
       nullif(regexp_extract(line, '{_STEP_RE}', 5), 'null') AS error
FROM lines WHERE regexp_matches(line, '{_STEP_RE}')""")
def log_extract_steps(t):
    return runlog.parse_steps(_step_lines(t))


def _end_lines(t):
    s = actionlog.summary(_annotated(t))
    rewards = F.array_join(F.transform("cost_trace", lambda x: F.format_string("%.2f", x)), ",")
    return s.select("session_id", F.format_string(
        "[END] success=%s steps=%d score=%.2f rewards=%s", F.when(F.col("invalid_actions") == 0, "true").otherwise("false"),
        F.col("steps"), F.col("cost_used"), rewards).alias("line"))


@query("log_extract_ends", f"""WITH {_ANNOTATED_SQL}
SELECT session_id, max(cum_invalid) = 0 AS success, max(step) AS steps, max(cum_cost) AS score,
       list(cum_cost ORDER BY step) AS rewards FROM al WHERE active GROUP BY session_id""")
def log_extract_ends(t):
    return runlog.parse_ends(_end_lines(t))


def _start_lines(t):
    """One line per session; every seventh lacks its model."""
    sid = F.col("session_id")
    return fx.action_log(t).select(sid).distinct().select(sid, F.concat(
        F.lit("[START] task=t"), (sid % 4).cast("string"), F.lit(" env=tables"),
        F.when(sid % 7 != 0, F.concat(F.lit(" model=m"), (sid % 3).cast("string"))).otherwise("")).alias("line"))


@query("log_extract_starts", """SELECT DISTINCT session_id, 't' || CAST(session_id % 4 AS VARCHAR) AS task,
       'tables' AS env, 'm' || CAST(session_id % 3 AS VARCHAR) AS model FROM action_log WHERE session_id % 7 <> 0""")
def log_extract_starts(t):
    return runlog.parse_starts(_start_lines(t))


@query("log_line_kinds", f"""WITH {_ANNOTATED_SQL},
k AS (SELECT 'step' AS kind FROM al WHERE active
      UNION ALL SELECT 'end' FROM (SELECT DISTINCT session_id FROM al WHERE active)
      UNION ALL SELECT CASE WHEN session_id % 7 <> 0 THEN 'start' ELSE 'unmatched' END
                FROM (SELECT DISTINCT session_id FROM action_log))
SELECT kind, count(*) AS n_lines FROM k GROUP BY kind""")
def log_line_kinds(t):
    lines = [x.select("line") for x in (_start_lines(t), _step_lines(t), _end_lines(t))]
    return runlog.line_kinds(setops.union_by_name(*lines))


def _model_text(t):
    c = t["conversations"]
    action = F.when(F.col("role") == "user", F.lit("inspect_column")).otherwise(F.lit("check_nulls"))
    j = F.to_json(F.struct(action.alias("action_type"), F.struct(
        F.lit("conversations").alias("table"), F.col("text").alias("note")).alias("parameters")))
    k = F.col("turn") % 3
    body = (F.when(k == 0, F.concat(F.lit("```json\n"), j, F.lit("\n```")))
             .when(k == 1, F.concat(F.lit("Next action: "), j, F.lit(" done.")))
             .otherwise(F.concat(F.lit("No action: "), F.col("text"))))
    return c.select("conv_id", "turn", "text", body.alias("model_text"))


@query("log_extract_actions", """
WITH m AS (SELECT conv_id, turn, text,
                  to_json(struct_pack(action_type := CASE WHEN role = 'user' THEN 'inspect_column' ELSE 'check_nulls' END,
                                      parameters := struct_pack("table" := 'conversations', note := text))) AS j
           FROM conversations),
t AS (SELECT conv_id, turn, text,
             CASE WHEN turn % 3 = 0 THEN '```json' || chr(10) || j || chr(10) || '```'
                  WHEN turn % 3 = 1 THEN 'Next action: ' || j || ' done.'
                  ELSE 'No action: ' || text END AS model_text FROM m),
b AS (SELECT conv_id, turn, text, regexp_extract(model_text, '(?s)(\\{.*\\})', 1) AS body FROM t)
SELECT conv_id, turn,
       CASE WHEN json_valid(body) AND body <> '' THEN json_extract_string(body, '$.action_type') END AS action_type,
       CASE WHEN json_valid(body) AND body <> '' THEN json_extract_string(body, '$.parameters.table') END AS table_name,
       CASE WHEN json_valid(body) AND body <> '' THEN json_extract_string(body, '$.parameters.note') = text END AS note_ok
FROM b""")
def log_extract_actions(t):
    m = _model_text(t)
    a = runlog.extract_action(F.col("model_text"))
    return m.select("conv_id", "turn", a["action_type"].alias("action_type"),
                    a["parameters"]["table"].alias("table_name"),
                    (a["parameters"]["note"] == F.col("text")).alias("note_ok"))


# --------------------------------------------------------------- set ops ----

@query("union_by_name", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders_orphan
UNION ALL BY NAME SELECT o_totalprice, o_orderkey, o_custkey FROM orders""")
def union_by_name(t):
    return setops.union_by_name(fx.orders_orphan(t),
                                t["orders"].select("o_totalprice", "o_orderkey", "o_custkey"))


@query("invalid_values", f"""
SELECT DISTINCT {STRIP_SQL.format(c='event_type')} AS event_type FROM events_padded
WHERE event_type IS NOT NULL AND {STRIP_SQL.format(c='event_type')} NOT IN ('click', 'view', 'purchase')""")
def invalid_values(t):
    return setops.invalid_values(fx.events_padded(t), "event_type", list(fx.VALID_EVENT_TYPES))


@query("last_n_per_session", """
SELECT session_id, event_id, action_type,
       row_number() OVER (PARTITION BY session_id ORDER BY ts DESC, event_id DESC) AS pos_from_end
FROM action_log
QUALIFY pos_from_end <= 3""")
def last_n_per_session(t):
    return setops.last_n_per_group(fx.action_log(t), ["session_id"], ["ts", "event_id"], 3) \
        .select("session_id", "event_id", "action_type", "pos_from_end")


@query("final_blend", f"SELECT stage, coalesce(final_score, round(0.85 * rubric, 4)) AS final_score "
       f"FROM ({_JOIN_ALL_SQL}) s(stage, rubric, value_match, final_score)")
def final_blend_query(t):
    """Rubric blended with the value match (0.85 / 0.15), per join variant."""
    return rubric_join(t).select("stage", "final_score")


_AVERAGE_SQL = f"SELECT stage, coalesce(final_score, round(0.85 * rubric, 4)) AS final_score FROM ({_JOIN_ALL_SQL}) s(stage, rubric, value_match, final_score)"


@query("score_average", f"""SELECT 'rubric_join' AS task, count(*) AS runs, round(avg(final_score), 4) AS average_score,
       count_if(final_score >= 0.1) AS successes FROM ({_AVERAGE_SQL})""")
def score_average(t):
    """The report over a set of final scores: runs, average and successes per task."""
    return average_scores(rubric_join(t).select(F.lit("rubric_join").alias("task"), "final_score"), "task", "final_score")
