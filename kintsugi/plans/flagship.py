"""Flagship: repair a broken orders table end to end and profile the result.

orders_dirty → keys to int64 (strict) → total to float64 → mean fill →
strip priority → dedup → left join customer → per-column profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from kintsugi.operators import joins, profile, repair
from kintsugi.plans.join_profile_queries import _profile_sql
from kintsugi.plans.quality_queries import REPAIRED_ORDERS_SQL
from kintsugi.plans.registry import query
from kintsugi.sources import fixtures as fx


def repaired_enriched(t) -> DataFrame:
    d = fx.orders_dirty(t)
    d = repair.cast_column(d, "o_orderkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_custkey", "int64", on_error="fail")
    d = repair.cast_column(d, "o_totalprice", "float64")
    d = repair.fill_nulls(d, "o_totalprice", strategy="mean")
    d = repair.strip_column(d, "o_orderpriority")
    d = repair.drop_duplicates(d)
    cust = t["customer"].select("c_custkey", "c_name", "c_mktsegment")
    return joins.safe_join(d, cust, ("o_custkey", "c_custkey"), "left")


_ENRICHED_SQL = f"""(SELECT o.*, c.c_custkey, c.c_name, c.c_mktsegment
 FROM (SELECT DISTINCT * FROM ({REPAIRED_ORDERS_SQL})) o
 LEFT JOIN customer c ON o.o_custkey IS NOT DISTINCT FROM c.c_custkey)"""


@query("repair_and_profile", "WITH enriched AS " + _ENRICHED_SQL + "\n" + _profile_sql("enriched", [
    ("o_orderkey", "int64", "o_orderkey IS NULL"),
    ("o_custkey", "int64", "o_custkey IS NULL"),
    ("o_totalprice", "float64", "(o_totalprice IS NULL OR isnan(o_totalprice))"),
    ("o_orderstatus", "object", "o_orderstatus IS NULL"),
    ("o_orderpriority", "object", "o_orderpriority IS NULL"),
    ("o_orderdate", "datetime64[ns]", "o_orderdate IS NULL"),
    ("c_custkey", "int64", "c_custkey IS NULL"),
    ("c_name", "object", "c_name IS NULL"),
    ("c_mktsegment", "object", "c_mktsegment IS NULL")]).replace("'enriched' AS table_name", "'orders_enriched' AS table_name"))
def repair_and_profile(t):
    # the repaired table is derived (mean fill, dedup, join): materialise it
    # once so the fused profile passes read it instead of replaying it
    return profile.table_profile(repaired_enriched(t), "orders_enriched", materialize=True)
