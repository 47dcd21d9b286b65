"""Randomised invariants (few examples each: every example runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kintsugi.operators import joins, repair
from kintsugi.operators.scan import ScanSpec, segmented_scan

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=0, max_size=25)


@SETTINGS
@given(lk=keys, rk=keys, null_keys=st.sampled_from(["match", "drop"]))
def test_join_report_equals_real_joins(spark, lk, rk, null_keys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lk)], "k long, a long")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rk)], "k long, b long")
    r = joins.join_report(left, right, "k", null_keys=null_keys).first()
    count = lambda how: joins.safe_join(left, right, "k", how, null_keys=null_keys).count()
    assert (r.left_rows or 0, r.right_rows or 0) == (len(lk), len(rk))
    if lk or rk:
        assert r.inner_rows == count("inner") and r.left_join_rows == count("left")
        assert r.right_join_rows == count("right") and r.full_join_rows == count("outer")
        assert r.unmatched_left == joins.unmatched_left(left, right, "k", null_keys=null_keys).count()


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30),
                               st.one_of(st.none(), st.floats(-5, 5, allow_nan=False))),
                     min_size=1, max_size=60))
def test_scan_equals_window(spark, rows):
    df = spark.createDataFrame([(i, g, o, v) for i, (g, o, v) in enumerate(rows)],
                               "id long, g long, o long, v double")
    got = segmented_scan(df, ["o", "id"], [ScanSpec("rn", "count"), ScanSpec("ff", "last", "v")],
                         partition_by=["g"], num_partitions=4)
    w = W.partitionBy("g").orderBy("o", "id")
    exp = df.select("id", F.row_number().over(w).alias("rn"),
                    F.last("v", True).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("ff"))
    assert sorted(map(tuple, got.select("id", "rn", "ff").collect())) == sorted(map(tuple, exp.collect()))


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                               st.sampled_from(["a", "b", None])), min_size=0, max_size=30))
def test_dedup_report_and_idempotence(spark, rows):
    df = spark.createDataFrame(rows, "x long, s string")
    rep = repair.dedup_report(df).first()
    once = repair.drop_duplicates(df)
    assert (rep.rows_before, rep.rows_after) == (len(rows), once.count())
    assert repair.drop_duplicates(once).count() == once.count()
