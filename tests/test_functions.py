import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kintsugi.functions.casts import cast_expr
from kintsugi.functions.text import camel_to_snake, strip
from kintsugi.functions.types import dtype_matches, dtype_name, resolve_alias


def test_dtype_equivalence_is_one_way():
    assert dtype_matches("int32", "int64")
    assert dtype_matches("int16", "int")
    assert not dtype_matches("int64", "int32")
    assert not dtype_matches("float64", "int64")
    assert dtype_matches("float32", "float64")
    assert dtype_matches("object", "string") and dtype_matches("str", "object")
    assert not dtype_matches("datetime64[ns]", "datetime")
    assert dtype_matches("BOOL", "bool")


def test_alias_and_names():
    assert resolve_alias("int") == "int64" and resolve_alias("str") == "object"
    assert resolve_alias("int16") == "int16"
    assert dtype_name(T.LongType()) == "int64" and dtype_name(T.TimestampNTZType()) == "datetime64[ns]"
    assert camel_to_snake("custKey") == "cust_key" and camel_to_snake("orderStatus") == "order_status"


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([(" a ",), ("\tb ",), ("　c ",), ("d",), (None,)], "s string")
    got = [r[0] for r in df.select(strip("s")).collect()]
    assert got == ["a", "b", "c", "d", None]


def test_int_cast_rules(spark):
    df = spark.createDataFrame([("1.0",), (" 2 ",), ("1e3",), ("1.5",), ("x",), (None,), ("inf",)], "s string")
    e, strict = cast_expr("s", T.StringType(), "int64")
    assert strict
    assert [r[0] for r in df.select(e).collect()] == [1, 2, 1000, None, None, None, None]


def test_double_and_bool_casts(spark):
    df = spark.createDataFrame([(" 2.5 ",), ("1,000",), ("",), (None,), ("False",)], "s string")
    e, _ = cast_expr("s", T.StringType(), "float64")
    assert [r[0] for r in df.select(e).collect()] == [2.5, None, None, None, None]
    b, _ = cast_expr("s", T.StringType(), "bool")
    assert [r[0] for r in df.select(b).collect()] == [True, True, False, False, True]
    f = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (2.0,)], "v double")
    b2, _ = cast_expr("v", T.DoubleType(), "bool")
    assert [r[0] for r in f.select(b2).collect()] == [True, False, False, True]


def test_string_cast_keeps_null_or_prints_it(spark):
    f = spark.createDataFrame([(float("nan"),), (None,), (1.5,)], "v double")
    e, _ = cast_expr("v", T.DoubleType(), "str")
    assert [r[0] for r in f.select(e).collect()] == ["NaN", None, "1.5"]
    e2, _ = cast_expr("v", T.DoubleType(), "str", null_text=True)
    assert [r[0] for r in f.select(e2).collect()] == ["nan", "nan", "1.5"]


def test_timestamp_cast(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02",), ("junk",)], "s string")
    e, _ = cast_expr("s", T.StringType(), "datetime")
    got = [r[0] for r in df.select(F.date_format(e, "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-02 00:00:00", None]


def test_unknown_target_rejected():
    with pytest.raises(ValueError):
        cast_expr("s", T.StringType(), "complex128")
