"""Catalogue: versioned tables, profiles kept per part, comparison by digests, rules in SQL, time formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from kintsugi.functions import casts, sqlnames
from kintsugi.operators import compare, digest, profile_state, repair
from kintsugi.plans.join_profile_queries import _profile_sql
from kintsugi.plans.quality_queries import _ORDER_LIVE_COLS, _ORDER_MATCHES, REPAIRED_ORDERS_SQL, keyed_sql, repaired_orders
from kintsugi.plans.registry import ORACLE, query
from kintsugi.plans.score_log_queries import TYPES_ROW_TOL, TYPES_W, _has_type, _repaired_types
from kintsugi.session import scratch_path
from kintsugi.sources import fixtures as fx
from kintsugi.sources.versions import VersionedTable


def _fresh_table(t) -> VersionedTable:
    return VersionedTable(t.spark, scratch_path(t.spark))


@query("snapshot_history", """
SELECT 1 AS version, count(*) AS rows, CAST(count_if(o_totalprice IS NULL) AS BIGINT) AS missing FROM orders_dirty
UNION ALL SELECT 2, count(*), CAST(0 AS BIGINT) FROM orders_dirty WHERE o_totalprice IS NOT NULL
UNION ALL SELECT 3, count(*), CAST(count_if(o_totalprice IS NULL) AS BIGINT) FROM orders_dirty""")
def snapshot_history(t):
    """Orders are stored, filtered in place, and rolled back: rows and gaps of each version."""
    table = _fresh_table(t)
    table.overwrite(fx.orders_dirty(t))
    table.overwrite(repair.filter_rows(table.read(), "o_totalprice", "notnull"))
    table.rollback(1)
    parts = [table.read(v).agg(F.lit(v).alias("version"), F.count(F.lit(1)).alias("rows"),
                               F.count_if(F.col("o_totalprice").isNull()).alias("missing")) for v in table.numbers()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("profile_after_append", _profile_sql("orders_dup", [
    ("o_orderkey", "int64", "o_orderkey IS NULL"), ("custKey", "int64", "custKey IS NULL"),
    ("orderStatus", "object", "orderStatus IS NULL"), ("totalPrice", "object", "totalPrice IS NULL")]))
def profile_after_append(t):
    """All orders but the pending ones are stored and profiled, the others appended: the second profile reads only those."""
    table, d = _fresh_table(t), fx.orders_dup(t)
    pending = F.coalesce(F.col("orderStatus") == "P", F.lit(False))
    table.overwrite(d.where(~pending))
    profile_state.refresh(table)
    table.append(d.where(pending))
    return profile_state.table_profile(table, "orders_dup")


_LIVE_SQL = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS o_totalprice,
       o_orderstatus, o_orderpriority, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, o_orderdate FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01'"""


def _live_orders(t):
    """Orders that lost the prices of pending ones and everything from 1998, and repeat some."""
    o = t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_orderdate") \
        .where("o_orderdate < TIMESTAMP '1998-01-01'")
    pending = F.col("o_orderstatus") == "P"
    lost = o.withColumn("o_totalprice", F.when(pending, F.lit(None)).otherwise(F.col("o_totalprice")))
    return lost.unionByName(o.where(pending & (F.col("o_orderpriority") == "1-URGENT")))


def _by_digest(live, trusted):
    digests = digest.trusted_leaves(trusted, "o_orderkey", live_key_type=live.schema["o_orderkey"].dataType)
    return digest.compare_by_digest(live, trusted, digests)


_TRUSTED = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority, o_orderdate FROM orders"


@query("compare_digest", keyed_sql(_LIVE_SQL, _TRUSTED, "o_orderkey", _ORDER_LIVE_COLS, _ORDER_MATCHES))
def compare_digest(t):
    """The keyed comparison where only leaves that differ are moved."""
    return _by_digest(_live_orders(t), t["orders"].select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                                          "o_orderpriority", "o_orderdate"))


@query("compare_digest_repaired", keyed_sql(REPAIRED_ORDERS_SQL, "SELECT * FROM orders", "o_orderkey", _ORDER_LIVE_COLS, _ORDER_MATCHES))
def compare_digest_repaired(t):
    """The repaired orders against the trusted ones, by digests."""
    return _by_digest(repaired_orders(t), t["orders"])


@query("mean_value_match", "SELECT score / 2 AS value_match FROM (" + keyed_sql(
    REPAIRED_ORDERS_SQL, "SELECT * FROM orders", "o_orderkey", _ORDER_LIVE_COLS, _ORDER_MATCHES) + ")")
def mean_value_match(t):
    """Orders after their repair, and customers that are missing: a missing table scores 0."""
    return compare.mean_value_match({"orders": repaired_orders(t)}, {"orders": t["orders"], "customer": t["customer"]},
                                    {"orders": "o_orderkey", "customer": "c_custkey"})


@query("rubric_sql")
def rubric_sql(t):
    """The rubric of ``rubric_types`` in SQL alone, over the registered functions."""
    spark = t.spark
    sqlnames.register(spark)
    t["orders"].createOrReplaceTempView("kintsugi_orders")
    stages = []
    for stage, df in (("before", fx.orders_dirty(t)), ("after", _repaired_types(t))):
        df.createOrReplaceTempView(f"kintsugi_{stage}")
        typed = sum(_has_type(df, c, x) for c, x in (("o_orderkey", "int64"), ("o_totalprice", "float64"), ("o_custkey", "int64")))
        price = "is_missing(o_totalprice)" if df.schema["o_totalprice"].dataType.simpleString() == "double" else "o_totalprice IS NULL"
        stages.append(spark.sql(f"""
            WITH f AS (SELECT count(*) AS rows, count_if({price}) AS tn, count_if(o_custkey IS NULL) AS cn FROM kintsugi_{stage})
            SELECT '{stage}' AS stage, round(clamp01({typed * TYPES_W['dtype']}D + {TYPES_W['no_nulls']}D * flag(tn = 0)
                   + {TYPES_W['no_nulls']}D * flag(cn = 0)
                   + {TYPES_W['rows']}D * row_credit(rows, (SELECT count(*) FROM kintsugi_orders), {TYPES_ROW_TOL})), 4) AS score
            FROM f"""))
    return stages[0].unionByName(stages[1])


ORACLE["rubric_sql"] = ORACLE["rubric_types"]  # the views are in it already

_FORMAT_SQL = {"yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "yyyy-MM-dd": "%Y-%m-%d", "yyyy/MM/dd": "%Y/%m/%d",
               "dd/MM/yyyy": "%d/%m/%Y", "MM/dd/yyyy": "%m/%d/%Y", "dd.MM.yyyy": "%d.%m.%Y"}


def _dated(t):
    return t["orders"].select("o_orderkey", F.concat(F.lit(" "), F.date_format("o_orderdate", "dd/MM/yyyy")).alias("o_orderdate"))


@query("time_formats", "WITH d AS (SELECT strftime(o_orderdate, '%d/%m/%Y') AS s FROM orders)\n" + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{f}' AS time_format, count(try_strptime(s, '{d}')) AS parsed, count(s) AS present FROM d"
    for i, (f, d) in enumerate(_FORMAT_SQL.items())))
def time_formats(t):
    """How many of the orders' dates, written with the day first, each layout reads."""
    return casts.time_format_counts(_dated(t), "o_orderdate", tuple(_FORMAT_SQL))


@query("cast_inferred_time", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate FROM orders")
def cast_inferred_time(t):
    """Dates written with the day first, read without naming their layout."""
    return repair.cast_column(_dated(t), "o_orderdate", "datetime", formats=None)
