import pytest
from pyspark.sql import functions as F

from kintsugi.operators import repair


@pytest.fixture()
def gappy(spark):
    rows = [(1, 1.0, "a"), (2, None, "b"), (3, float("nan"), "b"), (4, 4.0, None), (5, 4.0, "c"),
            (6, None, "c"), (7, 2.0, "c")]
    return spark.createDataFrame(rows, "k long, v double, s string")


def _col(df, c, order="k"):
    return [r[0] for r in df.orderBy(order).select(c).collect()]


def test_fill_strategies(gappy):
    assert _col(repair.fill_nulls(gappy, "v", strategy="mean"), "v") == [1.0, 2.75, 2.75, 4.0, 4.0, 2.75, 2.0]
    assert _col(repair.fill_nulls(gappy, "v", strategy="median"), "v") == [1.0, 3.0, 3.0, 4.0, 4.0, 3.0, 2.0]
    assert _col(repair.fill_nulls(gappy, "v", strategy="mode"), "v")[1] == 4.0
    assert _col(repair.fill_nulls(gappy, "v", strategy="ffill", order_by=["k"]), "v") == \
        [1.0, 1.0, 1.0, 4.0, 4.0, 4.0, 2.0]
    assert _col(repair.fill_nulls(gappy, "v", value=0.0), "v") == [1.0, 0.0, 0.0, 4.0, 4.0, 0.0, 2.0]


def test_mode_ties_take_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "a"), (5, None)], "k long, s string")
    assert _col(repair.fill_nulls(df, "s", strategy="mode"), "s")[-1] == "a"


def test_fill_errors(gappy):
    with pytest.raises(Exception, match="numeric column"):  # when a gap is met; without one nothing happens
        repair.fill_nulls(gappy, "s", strategy="mean").collect()
    with pytest.raises(ValueError):
        repair.fill_nulls(gappy, "v", strategy="ffill")
    with pytest.raises(TypeError):
        repair.fill_nulls(gappy, "v", value="zero")
    with pytest.raises(KeyError):
        repair.fill_nulls(gappy, "nope", value=1)


def test_grouped_fill(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "x", None), (3, "y", 5.0), (4, "y", None),
                                (5, None, 7.0), (6, None, None)], "k long, g string, v double")
    out = repair.fill_nulls(df, "v", strategy="mean", partition_by=["g"])
    assert _col(out, "v") == [1.0, 1.0, 5.0, 5.0, 7.0, 7.0]
    out = repair.fill_nulls(df, "v", strategy="ffill", order_by=["k"], partition_by=["g"])
    assert _col(out, "v") == [1.0, 1.0, 5.0, 5.0, 7.0, 7.0]


def test_strict_int_cast_fails_whole_column(spark):
    df = spark.createDataFrame([("1",), ("2.5",)], "s string")
    bad = repair.cast_column(df, "s", "int64", on_error="fail")
    with pytest.raises(Exception):
        bad.collect()
    rep = repair.cast_report(df, "s", "int64").first()
    assert (rep.rows, rep.failed, rep.cast_ok) == (2, 1, False)


def test_rename_guards(gappy):
    with pytest.raises(ValueError):
        repair.rename_column(gappy, "v", "s")
    assert repair.rename_column(gappy, "v", "value").columns == ["k", "value", "s"]
    df = gappy.withColumnRenamed("s", "someText")
    assert repair.snake_case_columns(df).columns == ["k", "v", "some_text"]


def test_dedup_keep_first_and_report(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (2, 2, "b")], "k long, o long, x string")
    out = repair.drop_duplicates(df, subset=["k"], order_by=["o"])
    assert sorted(map(tuple, out.collect())) == [(1, 1, "a"), (2, 2, "b")]
    assert repair.drop_duplicates(df).count() == 3
    rep = repair.dedup_report(df).first()
    assert (rep.rows_before, rep.rows_after, rep.dropped) == (4, 3, 1)
    again = repair.drop_duplicates(repair.drop_duplicates(df))
    assert again.count() == 3  # idempotent


def test_filter_semantics(spark):
    df = spark.createDataFrame([(1, 1.0, " a "), (2, None, "b"), (3, float("nan"), None), (4, 9.0, "a")],
                               "k long, v double, s string")
    ks = lambda op, col, val: sorted(r.k for r in repair.filter_rows(df, col, op, val).collect())  # noqa
    assert ks("gt", "v", 0.5) == [1, 4]          # NaN excluded even though Spark sorts it high
    assert ks("ne", "v", 1.0) == [2, 3, 4]       # NULL and NaN kept
    assert ks("eq", "v", "1") == []              # other type family: nothing
    assert ks("ne", "s", 5) == [1, 2, 3, 4]      # other type family: everything
    assert ks("isnull", "v", None) == [2, 3]
    assert ks("isin", "s", ["a", 7]) == [1, 4]   # numbers in the list never match
    assert ks("isin", "s", ["None"]) == [3]      # a missing value prints as None
    assert ks("strip_eq", "s", "a") == [1, 4]
    with pytest.raises(TypeError):
        ks("gt", "s", 1)
    with pytest.raises(ValueError):
        ks("like", "s", "a")
    rep = repair.filter_report(df, "v", "notnull").first()
    assert (rep.rows_before, rep.rows_after, rep.dropped) == (4, 2, 2)


def test_duplicate_count_float_edge_cases(spark):
    df = spark.createDataFrame([(0.0, "a"), (-0.0, "a"), (float("nan"), "b"), (float("nan"), "b"),
                                (None, None), (None, None), (1.0, None)], "v double, s string")
    rep = repair.dedup_report(df).first()
    assert (rep.rows_before, rep.dropped) == (7, df.count() - df.dropDuplicates().count())
    assert rep.dropped == 3


def test_isin_with_value_table(spark):
    df = spark.createDataFrame([(1, " a "), (2, "b"), (3, None), (4, "c")], "k long, s string")
    allowed = spark.createDataFrame([("a",), ("c",), (None,)], "v string")
    got = sorted(r.k for r in repair.filter_rows(df, "s", "isin", allowed).collect())
    assert got == sorted(r.k for r in repair.filter_rows(df, "s", "isin", ["a", "c"]).collect()) == [1, 4]
    assert repair.filter_rows(df, "s", "isin", allowed).columns == ["k", "s"]
