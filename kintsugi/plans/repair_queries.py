"""Catalogue: casts, renames, stripping, filters, fills, deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from kintsugi.functions.text import is_padded, strip
from kintsugi.operators import profile, quantile, repair
from kintsugi.plans.registry import query
from kintsugi.sources import fixtures as fx

# DuckDB spellings shared by several oracle queries.
STRIP_SQL = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
INT_FORM_SQL = """CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') THEN TRY_CAST(trim({c}) AS BIGINT)
     WHEN TRY_CAST(trim({c}) AS DOUBLE) = floor(TRY_CAST(trim({c}) AS DOUBLE))
          AND TRY_CAST(trim({c}) AS DOUBLE) >= -9223372036854775808.0 AND TRY_CAST(trim({c}) AS DOUBLE) < 9223372036854775808.0
     THEN CAST(TRY_CAST(trim({c}) AS DOUBLE) AS BIGINT) END"""
MISSING_SQL = "({c} IS NULL OR isnan({c}))"


def _key(df):
    return repair.cast_column(df, "o_orderkey", "int64", on_error="fail")


# ---------------------------------------------------------------- casts ----

@query("cast_int_strict", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(trim(o_custkey) AS BIGINT) AS o_custkey
FROM orders_dirty""")
def cast_int_strict(t):
    d = fx.orders_dirty(t)
    d = repair.cast_column(d, "o_orderkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_custkey", "int64", on_error="fail")
    return d.select("o_orderkey", "o_custkey")


@query("cast_report", f"""
SELECT 'o_totalprice' AS column_name, 'int64' AS target, rows, missing_before, failed,
       (failed = 0 AND missing_before = 0) AS cast_ok
FROM (SELECT count(*) AS rows,
             CAST(count_if(o_totalprice IS NULL) AS BIGINT) AS missing_before,
             CAST(count_if(o_totalprice IS NOT NULL AND ({INT_FORM_SQL.format(c='o_totalprice')}) IS NULL)
                  AS BIGINT) AS failed
      FROM orders_dirty)""")
def cast_report(t):
    return repair.cast_report(fx.orders_dirty(t), "o_totalprice", "int64")


@query("cast_double_coerce", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, TRY_CAST(trim(o_totalprice) AS DOUBLE) AS o_totalprice
FROM orders_dirty""")
def cast_double_coerce(t):
    d = repair.cast_column(_key(fx.orders_dirty(t)), "o_totalprice", "float64")
    return d.select("o_orderkey", "o_totalprice")


@query("cast_string", f"""
SELECT event_id, CASE WHEN {MISSING_SQL.format(c='value')} THEN 'nan' ELSE CAST(value AS VARCHAR) END AS value
FROM events_gappy""")
def cast_string(t):
    d = repair.cast_column(fx.events_gappy(t), "value", "str", null_text=True)
    return d.select("event_id", "value")


@query("cast_bool_truthy", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CASE WHEN o_totalprice IS NULL THEN false ELSE length(o_totalprice) > 0 END AS o_totalprice
FROM orders_dirty""")
def cast_bool_truthy(t):
    d = repair.cast_column(_key(fx.orders_dirty(t)), "o_totalprice", "bool")
    return d.select("o_orderkey", "o_totalprice")


@query("cast_bool_float", """
SELECT event_id, CASE WHEN value IS NULL THEN false WHEN isnan(value) THEN true
                      ELSE value <> 0 END AS value
FROM events_gappy""")
def cast_bool_float(t):
    return repair.cast_column(fx.events_gappy(t), "value", "bool").select("event_id", "value")


_TS_TEXT_SQL = """CASE WHEN o_orderkey % 13 = 0 THEN 'not a date'
            WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@query("cast_timestamp", f"""
SELECT o_orderkey,
       CAST(epoch(try_strptime({_TS_TEXT_SQL}, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d'])) AS BIGINT)
         AS o_orderdate_epoch
FROM orders""")
def cast_timestamp(t):
    o, k = t["orders"], F.col("o_orderkey")
    text = (F.when(k % 13 == 0, F.lit("not a date"))
             .when(k % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
             .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    d = o.select("o_orderkey", text.alias("o_orderdate"))
    d = repair.cast_column(d, "o_orderdate", "datetime")
    return d.select("o_orderkey", F.unix_seconds("o_orderdate").alias("o_orderdate_epoch"))


# ------------------------------------------------- names and projection ----

@query("rename_camel_to_snake", """
SELECT o_orderkey, custKey AS cust_key, orderStatus AS order_status, totalPrice AS total_price
FROM orders_dup""")
def rename_camel_to_snake(t):
    return repair.snake_case_columns(fx.orders_dup(t))


@query("strip_column", f"""
SELECT event_id, {STRIP_SQL.format(c='event_type')} AS event_type FROM events_padded""")
def strip_column(t):
    return repair.strip_column(fx.events_padded(t), "event_type").select("event_id", "event_type")


@query("project_common", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders_orphan")
def project_common(t):
    return repair.project_common(fx.orders_orphan(t), t["orders"].columns)


# -------------------------------------------------------------- filters ----

def _gappy_filter(t, op, value):
    return repair.filter_rows(fx.events_gappy(t), "value", op, value).select("event_id", "value")


@query("filter_eq", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus FROM orders_dirty
WHERE o_orderstatus = 'F'""")
def filter_eq(t):
    return repair.filter_rows(_key(fx.orders_dirty(t)), "o_orderstatus", "eq", "F") \
        .select("o_orderkey", "o_orderstatus")


@query("filter_ne", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_totalprice FROM orders_dirty
WHERE o_totalprice IS DISTINCT FROM 'n/a'""")
def filter_ne(t):
    return repair.filter_rows(_key(fx.orders_dirty(t)), "o_totalprice", "ne", "n/a") \
        .select("o_orderkey", "o_totalprice")


@query("filter_gt", "SELECT event_id, value FROM events_gappy WHERE value > 50 AND NOT isnan(value)")
def filter_gt(t):
    return _gappy_filter(t, "gt", 50.0)


@query("filter_lt", "SELECT event_id, value FROM events_gappy WHERE value < 10 AND NOT isnan(value)")
def filter_lt(t):
    return _gappy_filter(t, "lt", 10.0)


@query("filter_gte", "SELECT event_id, value FROM events_gappy WHERE value >= 50 AND NOT isnan(value)")
def filter_gte(t):
    return _gappy_filter(t, "gte", 50.0)


@query("filter_lte", "SELECT event_id, value FROM events_gappy WHERE value <= 10 AND NOT isnan(value)")
def filter_lte(t):
    return _gappy_filter(t, "lte", 10.0)


@query("filter_notnull", "SELECT event_id, value FROM events_gappy WHERE value IS NOT NULL AND NOT isnan(value)")
def filter_notnull(t):
    return _gappy_filter(t, "notnull", None)


@query("filter_isnull", "SELECT event_id, value FROM events_gappy WHERE value IS NULL OR isnan(value)")
def filter_isnull(t):
    return _gappy_filter(t, "isnull", None)


@query("filter_isin", f"""
SELECT event_id, event_type FROM events_padded
WHERE {STRIP_SQL.format(c='event_type')} IN ('click', 'view')""")
def filter_isin(t):
    return repair.filter_rows(fx.events_padded(t), "event_type", "isin", ["click", "view"]) \
        .select("event_id", "event_type")


@query("filter_strip_eq", f"""
SELECT event_id, event_type FROM events_padded
WHERE {STRIP_SQL.format(c='event_type')} = 'purchase'""")
def filter_strip_eq(t):
    return repair.filter_rows(fx.events_padded(t), "event_type", "strip_eq", "purchase") \
        .select("event_id", "event_type")


@query("filter_report", """
SELECT rows_before, rows_after, rows_before - rows_after AS dropped
FROM (SELECT count(*) AS rows_before, CAST(count_if(o_totalprice IS NOT NULL) AS BIGINT) AS rows_after
      FROM orders_dirty)""")
def filter_report(t):
    return repair.filter_report(fx.orders_dirty(t), "o_totalprice", "notnull")


@query("valid_share", f"""
SELECT round(avg(CASE WHEN {STRIP_SQL.format(c='event_type')} IN ('click', 'view', 'purchase')
                      THEN 1.0 ELSE 0.0 END), 6) AS valid_share
FROM events_padded""")
def valid_share(t):
    e = fx.events_padded(t)
    ok = strip("event_type").isin(list(fx.VALID_EVENT_TYPES))
    return e.agg(F.round(F.avg(F.coalesce(ok, F.lit(False)).cast("double")), 6).alias("valid_share"))


@query("any_padded", f"""
SELECT coalesce(bool_or(event_type <> {STRIP_SQL.format(c='event_type')}), false) AS any_padded_before,
       coalesce(bool_or({STRIP_SQL.format(c='event_type')} <>
                        {STRIP_SQL.format(c=STRIP_SQL.format(c='event_type'))}), false) AS any_padded_after
FROM events_padded""")
def any_padded(t):
    e = fx.events_padded(t)
    s = strip("event_type")
    return e.agg(F.coalesce(F.bool_or(is_padded("event_type")), F.lit(False)).alias("any_padded_before"),
                 F.coalesce(F.bool_or(is_padded(s)), F.lit(False)).alias("any_padded_after"))


# ---------------------------------------------------------------- fills ----

def _gappy_fill(t, **kw):
    d = repair.fill_nulls(fx.events_gappy(t), "value", **kw)
    return d.select("event_id", F.round("value", 6).alias("value"))


@query("fill_constant", f"""
SELECT event_id, round(CASE WHEN {MISSING_SQL.format(c='value')} THEN 0.0 ELSE value END, 6) AS value
FROM events_gappy""")
def fill_constant(t):
    return _gappy_fill(t, value=0.0)


@query("fill_mean", f"""
SELECT event_id,
       round(CASE WHEN {MISSING_SQL.format(c='value')}
                  THEN (SELECT avg(value) FROM events_gappy WHERE NOT {MISSING_SQL.format(c='value')})
                  ELSE value END, 6) AS value
FROM events_gappy""")
def fill_mean(t):
    return _gappy_fill(t, strategy="mean")


@query("fill_median", f"""
SELECT event_id,
       round(CASE WHEN {MISSING_SQL.format(c='value')}
                  THEN (SELECT median(value) FROM events_gappy WHERE NOT {MISSING_SQL.format(c='value')})
                  ELSE value END, 6) AS value
FROM events_gappy""")
def fill_median(t):
    return _gappy_fill(t, strategy="median")


@query("fill_mode", f"""
SELECT event_id,
       round(CASE WHEN {MISSING_SQL.format(c='value')}
                  THEN (SELECT value FROM events_gappy WHERE NOT {MISSING_SQL.format(c='value')}
                        GROUP BY value ORDER BY count(*) DESC, value ASC LIMIT 1)
                  ELSE value END, 6) AS value
FROM events_gappy""")
def fill_mode(t):
    return _gappy_fill(t, strategy="mode")


@query("fill_ffill", """
SELECT event_id,
       round(last_value(CASE WHEN isnan(value) THEN NULL ELSE value END IGNORE NULLS)
             OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM events_gappy""")
def fill_ffill(t):
    return _gappy_fill(t, strategy="ffill", order_by=["ts", "event_id"])


@query("fill_ffill_grouped", """
SELECT event_id,
       round(last_value(CASE WHEN isnan(value) THEN NULL ELSE value END IGNORE NULLS)
             OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value
FROM events_gappy""")
def fill_ffill_grouped(t):
    return _gappy_fill(t, strategy="ffill", order_by=["ts", "event_id"], partition_by=["user_id"])


@query("null_counts", f"""
SELECT * FROM (
  SELECT 'event_id' AS column_name, CAST(count_if(event_id IS NULL) AS BIGINT) AS nulls FROM events_gappy
  UNION ALL SELECT 'user_id', CAST(count_if(user_id IS NULL) AS BIGINT) FROM events_gappy
  UNION ALL SELECT 'ts', CAST(count_if(ts IS NULL) AS BIGINT) FROM events_gappy
  UNION ALL SELECT 'event_type', CAST(count_if(event_type IS NULL) AS BIGINT) FROM events_gappy
  UNION ALL SELECT 'value', CAST(count_if({MISSING_SQL.format(c='value')}) AS BIGINT) FROM events_gappy)
WHERE nulls > 0""")
def null_counts(t):
    return profile.null_counts(fx.events_gappy(t))


@query("null_improvement", """
SELECT round(rate, 6) AS null_rate, round(greatest(0.0, 0.10 - rate) / 0.10, 6) AS credit
FROM (SELECT count_if(session_id IS NULL OR isnan(session_id)) / count(*) AS rate FROM sessions_dirty)""")
def null_improvement(t):
    s = fx.sessions_dirty(t)
    nc = profile.null_counts(s, only_missing=False).filter(F.col("column_name") == "session_id")
    rows = F.lit(s.count())
    rate = F.col("nulls") / rows
    return nc.select(F.round(rate, 6).alias("null_rate"),
                     F.round(F.greatest(F.lit(0.0), F.lit(0.10) - rate) / 0.10, 6).alias("credit"))


# ---------------------------------------------------------------- dedup ----

@query("dedup_full", "SELECT DISTINCT * FROM orders_dup")
def dedup_full(t):
    return repair.drop_duplicates(fx.orders_dup(t))


@query("dedup_subset_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""")
def dedup_subset_first(t):
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return repair.drop_duplicates(li, subset=["l_orderkey"], order_by=["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"])


@query("duplicate_count", """
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n) - count(*) AS BIGINT) AS dropped
FROM (SELECT count(*) AS n FROM orders_dup GROUP BY o_orderkey, custKey, orderStatus, totalPrice)""")
def duplicate_count(t):
    return repair.dedup_report(fx.orders_dup(t))


@query("dedup_report", """
SELECT CAST(sum(n) AS BIGINT) AS rows_before, count(*) AS rows_after,
       CAST(sum(n) - count(*) AS BIGINT) AS dropped
FROM (SELECT count(*) AS n FROM orders_dup GROUP BY o_orderkey)""")
def dedup_report(t):
    return repair.dedup_report(fx.orders_dup(t), subset=["o_orderkey"])


# ------------------------------------------------------- exactness at the edges ----

_EDGE = 1 << 53  # from here on doubles skip integers

_WIDE_SQL = f"""SELECT o_orderkey + {_EDGE} AS k, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE o_custkey % 2 + {_EDGE} END AS g,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey + {_EDGE} END AS payload,
       CAST(o_orderkey AS DECIMAL(20,2)) + 0.25 AS amount, o_orderdate + INTERVAL 7000 YEAR AS far,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey + {_EDGE} END AS v FROM orders"""


def _wide(t):
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return t["orders"].select(
        (key + _EDGE).alias("k"), F.when(cust % 10 != 0, cust % 2 + _EDGE).alias("g"),
        F.when(key % 3 != 0, cust + _EDGE).alias("payload"),
        (key.cast("decimal(20,2)") + F.expr("0.25BD")).cast("decimal(20,2)").alias("amount"),
        (F.col("o_orderdate") + F.expr("INTERVAL 7000 YEAR")).alias("far"), F.when(key % 4 != 0, key + _EDGE).alias("v"))


@query("ffill_wide_ints", f"""
SELECT k, g, payload, CAST(amount AS DECIMAL(20,2)) AS amount, far, last_value(v IGNORE NULLS) OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS v
FROM ({_WIDE_SQL})""")
def ffill_wide_ints(t):
    return repair.fill_nulls(_wide(t), "v", strategy="ffill", order_by=["k"])


@query("ffill_wide_groups", f"""
SELECT k, g, payload, CAST(amount AS DECIMAL(20,2)) AS amount, far,
       last_value(v IGNORE NULLS) OVER (PARTITION BY g ORDER BY k ROWS UNBOUNDED PRECEDING) AS v
FROM ({_WIDE_SQL})""")
def ffill_wide_groups(t):
    return repair.fill_nulls(_wide(t), "v", strategy="ffill", order_by=["k"], partition_by=["g"])


@query("cast_int_decimal", f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey + {_EDGE + 1} END AS v FROM orders""")
def cast_int_decimal(t):
    key = F.col("o_orderkey")
    v = key.cast("decimal(20,1)") + F.lit(_EDGE + 1).cast("decimal(20,1)") + F.when(key % 5 == 0, F.expr("0.5BD")).otherwise(F.expr("0.0BD"))
    return repair.cast_column(t["orders"].select("o_orderkey", v.alias("v")), "v", "int64")


@query("cast_int_limits", """
SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 9223372036854775807 WHEN 2 THEN 9210000000000000000
       WHEN 3 THEN -9223372036854775807 - 1 WHEN 5 THEN o_orderkey END AS v FROM orders""")
def cast_int_limits(t):
    key = F.col("o_orderkey")
    texts = ["9223372036854775807", "9223372036854775808", "9.21e18", "-9223372036854775808", "1.5"]
    v = key.cast("string")
    for i, x in enumerate(texts):
        v = F.when(key % 6 == i, F.lit(x)).otherwise(v)
    return repair.cast_column(t["orders"].select("o_orderkey", v.alias("v")), "v", "int64")


@query("cast_int32", """
SELECT o_orderkey, CASE WHEN o_custkey * 5000000 <= 2147483647 THEN CAST(o_custkey * 5000000 AS INTEGER) END AS v FROM orders""")
def cast_int32(t):
    wide = t["orders"].select("o_orderkey", (F.col("o_custkey") * 5000000).cast("string").alias("v"))
    return repair.cast_column(wide, "v", "int32")


@query("filter_eq_bool", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def filter_eq_bool(t):
    flagged = t["orders"].select("o_orderkey", (F.col("o_orderkey") % 2 == 0).alias("even"))
    return repair.filter_rows(flagged, "even", "eq", 1).select("o_orderkey")


@query("filter_eq_time", """
SELECT o_orderkey, 'eq' AS kept_by FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28 00:00:00'
UNION ALL SELECT o_orderkey, 'ne' FROM orders""")
def filter_eq_time(t):
    """A time equals a text that names it; a text that names no time equals nothing and differs from all."""
    o = t["orders"].select("o_orderkey", "o_orderdate")
    parts = [repair.filter_rows(o, "o_orderdate", op, value).select("o_orderkey", F.lit(op).alias("kept_by"))
             for op, value in (("eq", "1997-05-28"), ("eq", "nope"), ("ne", "nope"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("fill_text_noop", "SELECT o_orderkey, o_orderstatus FROM orders")
def fill_text_noop(t):
    return repair.fill_nulls(t["orders"].select("o_orderkey", "o_orderstatus"), "o_orderstatus", strategy="mean")


@query("fill_median_grouped", f"""
SELECT event_id, event_type, CASE WHEN {MISSING_SQL.format(c='value')}
       THEN median(value) FILTER (NOT isnan(value)) OVER (PARTITION BY event_type) ELSE value END AS value FROM events_gappy""")
def fill_median_grouped(t):
    return repair.fill_nulls(fx.events_gappy(t).select("event_id", "event_type", "value"), "value",
                             strategy="median", partition_by=["event_type"])


@query("group_order_statistics", """
SELECT l_returnflag, l_linestatus, r AS rank, l_extendedprice AS value FROM (
  SELECT l_returnflag, l_linestatus, l_extendedprice, count(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n,
         row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) - 1 AS r FROM lineitem)
WHERE r IN (0, n // 10, n // 2, n - 1)""")
def group_order_statistics(t):
    """Smallest, tenth, middle and largest price of each group (one of them holds half of all rows)."""
    return quantile.group_order_statistics(t["lineitem"], "l_extendedprice", ["l_returnflag", "l_linestatus"],
                                           lambda n: [F.lit(0), F.floor(n / 10), F.floor(n / 2), n - 1])
