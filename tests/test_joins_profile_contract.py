import pytest
from pyspark.sql import functions as F

from kintsugi.operators import compare, contract, joins, profile


@pytest.fixture()
def lr(spark):
    left = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (None, 30, "c"), (4, 40, "d")],
                                 "k long, v long, name string")
    right = spark.createDataFrame([(1, "x", 1.5), (1, "y", 2.5), (None, "z", 3.5), (9, "w", 4.5)],
                                  "k long, name string, w double")
    return left, right


def test_join_shapes_and_names(lr):
    left, right = lr
    inner = joins.safe_join(left, right, "k", "inner")
    assert inner.columns == ["k", "v", "name_x", "name_y", "w"]
    assert inner.count() == 3                        # 1 matches twice, NULL matches NULL
    assert joins.safe_join(left, right, "k", "inner", null_keys="drop").count() == 2
    assert joins.safe_join(left, right, "k", "left").count() == 5
    full = joins.safe_join(left, right, "k", "outer")
    assert sorted((r.k is None, r.k) for r in full.collect() if r.k is not None)[-1] == (False, 9)
    assert joins.safe_join(left, right, "k", "right").count() == 4


def test_join_guards(spark, lr):
    left, right = lr
    txt = right.withColumn("k", F.col("k").cast("string"))
    with pytest.raises(TypeError):
        joins.safe_join(left, txt, "k")
    with pytest.raises(ValueError):
        joins.safe_join(left, right, "k", "cross")
    dbl = right.withColumn("k", F.col("k").cast("double"))
    assert joins.safe_join(left, dbl, "k").count() == 3


def test_join_report_arithmetic(lr):
    left, right = lr
    r = joins.join_report(left, right, "k").first()
    assert (r.left_rows, r.right_rows, r.inner_rows) == (4, 4, 3)
    assert r.left_join_rows == joins.safe_join(left, right, "k", "left").count()
    assert r.right_join_rows == joins.safe_join(left, right, "k", "right").count()
    assert r.full_join_rows == joins.safe_join(left, right, "k", "outer").count()
    assert (r.unmatched_left, r.unmatched_right, r.fanout_keys) == (2, 1, 1)
    assert joins.unmatched_left(left, right, "k").count() == 2
    assert joins.matched_left(left, right, "k").count() == 2
    # invariant: a left join never loses left rows
    assert r.left_join_rows >= r.left_rows


def test_profile_and_inspect(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 1.0), (2, float("nan")), (3, None)], "k long, v double")
    nc = {r.column_name: r.nulls for r in profile.null_counts(df).collect()}
    assert nc == {"v": 2}
    p = profile.table_profile(df, "t").collect()
    assert {r.duplicates for r in p} == {1} and {r.rows for r in p} == {4}
    ins = profile.inspect_column(df, "v", order_by=["k"]).first()
    assert (ins.null_count, ins.unique_count, ins.min, ins.max) == (2, 1, 1.0, 1.0)
    assert ins.sample_values == ["1.0", "1.0"]


def test_contract_issues_and_scores(spark):
    t = spark.createDataFrame([(1.0, "a"), (None, "b"), (2.0, "b")], "id double, s string")
    t2 = spark.createDataFrame([(1,), (1,)], "x long")
    c = contract.Contract(schema={"t": {"id": "int64", "s": "object", "gone": "int64"},
                                  "t2": {"x": "int64"}, "absent": {"y": "int64"}},
                          expected_rows={"t": 3, "t2": 2, "absent": 5},
                          initial_rows={"t": 10})
    iss = {(r.table_name, r.column_name, r.check_name) for r in contract.issues({"t": t, "t2": t2}, c).collect()}
    assert iss == {("t", "id", "nulls"), ("t", "gone", "missing_column"), ("t", "id", "dtype"),
                   ("t", None, "over_clean"), ("t2", None, "duplicates"), ("absent", None, "missing_table")}
    s = contract.contract_scores({"t": t, "t2": t2}, c).first()
    assert s.schema_score == pytest.approx(2 / 5)
    # t: s null-free + no duplicates (id has a null); t2: x null-free, duplicates
    assert s.validity_score == pytest.approx((2 + 1) / (3 + 2))
    # t: 3 rows < 0.75 * 10 -> max(0, 0.5 - 0.7) = 0; t2: 1; absent: 0
    assert s.row_integrity == pytest.approx(1 / 3)
    assert contract.schema_mismatches_exact({"t": t}, c)[0] == ("t", "id", "int64", "float64")


def test_compare_self_is_perfect_and_keyed_survives_shuffle(spark):
    df = spark.createDataFrame([(i, float(i) * 1.5, f"n{i}") for i in range(50)], "k long, v double, s string")
    assert compare.compare_keyed(df, df, "k").first().score == 1.0
    shuffled = df.orderBy(F.rand(1))
    assert compare.compare_keyed(shuffled, df, "k").first().score == 1.0
    assert compare.compare_positional(shuffled, df, ["k"], ["k"]).first().score == 1.0
    half = df.filter("k < 25")
    r = compare.compare_keyed(half, df, "k").first()
    assert (r.missing_keys, r.score) == (25, 0.5)
    assert compare.mismatch_ratio(df, df, ["k"], ["k"]).first().mismatch_ratio == 0.0


def test_numeric_tolerance_rule(spark):
    t = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, None)], "k long, v double")
    a = spark.createDataFrame([(1, 100.9), (2, 103.0), (3, 0.0)], "k long, v double")
    cols = {r.column_name: r.matched for r in compare.compare_columns(a, t, "k").collect()}
    assert cols["v"] == 1      # 100.9 within .01 + .01*100.9; 103 not; NULL vs 0 fails the null rule


def test_compare_keyed_counts_with_duplicate_and_null_keys(spark):
    trusted = spark.createDataFrame([(1, 1.0), (1, 1.0), (None, 5.0), (2, 2.0)], "k long, v double")
    live = spark.createDataFrame([(1, 1.0), (1, 9.0), (None, 5.0), (3, 3.0), (3, 3.0)], "k long, v double")
    r = compare.compare_keyed(live, trusted, "k", order_by=["v"]).first()
    assert (r.trusted_rows, r.live_rows, r.missing_keys, r.extra_rows, r.duplicate_live_keys) == (4, 5, 1, 1, 2)
    # key 1 (twice) and the NULL key match on both cells; key 2 has no live row
    assert (r.matched_cells, r.total_cells, r.score) == (6, 8, 0.75)


def test_the_product_of_null_keys_is_made_by_many_tasks(spark):
    left = spark.range(400, numPartitions=2).select(F.when(F.col("id") % 2 == 1, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(300, numPartitions=2).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("w"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        for how, n in (("inner", 20000 + 100), ("left", 20000 + 200), ("right", 20000 + 200), ("outer", 20000 + 300)):
            got = joins.safe_join(left, right, "k", how)
            assert got.count() == n
            nulls = got.where("k is null and v is not null").groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert sum(r["count"] for r in nulls) == 20000 and max(r["count"] for r in nulls) <= 6000
            assert got.where("k is null").groupBy("v", "w").count().where("count > 1").count() == 0
    finally:
        spark.conf.unset(merging)
    none = right.where("k is not null")
    assert joins.safe_join(left, none, "k", "left").where("k is null and w is null").count() == 200
    mapped = left.withColumn("m", F.create_map("v", "v")).select("k", "m")
    assert joins.safe_join(mapped, right, "k").count() == 20100
    assert joins.safe_join(left.select("k"), right, "k").count() == 20100
