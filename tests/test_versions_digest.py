"""Versioned tables, profiles per part, comparison by digests, rules in SQL, time formats."""

import datetime
import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from kintsugi.functions import casts, sqlnames
from kintsugi.functions.text import strip
from kintsugi.operators import compare, digest, profile, profile_state, repair
from kintsugi.session import checkpoint_dir
from kintsugi.sources.versions import VersionConflict, VersionedTable


@pytest.fixture
def table(spark):
    return VersionedTable(spark, f"{checkpoint_dir(spark)}/t-{uuid.uuid4().hex}")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_rollback_and_failed_writes(spark, table):
    first = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, s string")
    assert table.overwrite(first) == 1
    with pytest.raises(Exception, match="no good"):
        table.overwrite(table.read().withColumn("s", F.when(F.col("id") == 2, F.raise_error(F.lit("no good"))).otherwise(F.col("s"))))
    assert table.numbers() == [1] and rows(table.read()) == rows(first)
    table.overwrite(table.read().where("s is not null"))  # reads what it replaces
    assert table.append(spark.createDataFrame([("b", 3)], "s string, id int")) == 3
    assert rows(table.read()) == [(1, "a"), (3, "b")]
    assert table.rollback(1) == 4
    assert rows(table.read()) == rows(first) and rows(table.read(3)) == [(1, "a"), (3, "b")]
    with pytest.raises(ValueError, match="types"):
        table.append(spark.createDataFrame([("b", "3")], "s string, id string"))
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)


def test_second_writer_is_refused(spark, table):
    table.overwrite(spark.range(3))
    v = table.version()
    with pytest.raises(VersionConflict):
        table._publish(1, "overwrite", v.schema, v.parts)
    assert table.numbers() == [1] and table.read().count() == 3


def test_empty_versions(spark, table):
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.overwrite(spark.range(0).withColumn("x", F.lit(math.nan)))
    assert table.read().count() == 0
    assert rows(profile_state.table_profile(table, "t")) == rows(profile.table_profile(table.read(), "t"))


def test_profile_reads_changed_parts_only(spark, table):
    values = [(i % 7 if i % 3 else None, math.nan if i % 5 == 0 else -0.0 if i % 2 else 0.0, f"s{i % 4}") for i in range(300)]
    schema = "a int, b double, c string"
    table.overwrite(spark.createDataFrame(values, schema))
    assert len(profile_state.refresh(table)) == 1
    table.append(spark.createDataFrame(values[:40] + [(None, None, None)] * 2, schema))
    assert profile_state.refresh(table) == list(table.version().parts[1:])  # the new part alone
    assert rows(profile_state.table_profile(table, "t")) == rows(profile.table_profile(table.read(), "t"))
    assert all("/profile/" in f for f in profile_state.table_profile(table, "t").inputFiles())
    table.rollback(1)
    assert profile_state.refresh(table) == []
    assert rows(profile_state.table_profile(table, "t")) == rows(profile.table_profile(table.read(), "t"))


def test_profile_of_many_columns(spark, table):
    df = spark.range(20).select(*[F.when(F.col("id") % (i + 2) != 0, F.col("id")).alias(f"c{i}") for i in range(130)])
    table.overwrite(df)
    assert rows(profile_state.table_profile(table, "t")) == rows(profile.table_profile(df, "t"))


TRUSTED = "k long, n double, s string, at timestamp"


def _trusted_rows(rng, n):
    day = datetime.datetime(2024, 1, 1)
    out = [(i, rng.choice([None, math.nan, 0.0, -0.0, float(i)]), rng.choice(["a", None, "b"]),
            rng.choice([None, day + datetime.timedelta(days=i % 50)])) for i in range(n)]
    return out + [(None, 1.0, "x", day), (3, 3.0, "again", None), (3, 3.0, "again", None)]


@pytest.mark.parametrize("leaves", [1, 8, 1 << 12])
def test_digest_equals_keyed(spark, leaves):
    rng = random.Random(leaves)
    base = _trusted_rows(rng, 200)
    live = [r for r in base if r[0] is None or r[0] % 31] + base[10:14] + [(999, 1.0, None, None), (None, 2.0, "y", None)]
    live = [(r[0], 5e9, *r[2:]) if r[0] == 50 else r for r in live]
    t, a = spark.createDataFrame(base, TRUSTED), spark.createDataFrame(live, TRUSTED)
    for one, other in ((a, t), (t, t), (a.where("k is null"), t), (a.where("false"), t), (a, t.where("false"))):
        got = digest.compare_by_digest(one, other, digest.trusted_leaves(other, "k", leaves=leaves))
        assert rows(got) == rows(compare.compare_keyed(one, other, "k"))


def test_digest_with_other_types(spark):
    base = spark.createDataFrame(_trusted_rows(random.Random(5), 60), TRUSTED)
    live = base.select(F.col("k").cast("double").alias("k"), F.col("n").cast("string").alias("n"), "s",
                       F.unix_micros("at").alias("at"), F.lit(1).alias("extra"))
    got = digest.compare_by_digest(live, base, digest.trusted_leaves(base, "k", live_key_type=live.schema["k"].dataType))
    assert rows(got) == rows(compare.compare_keyed(live, base, "k"))
    with pytest.raises(ValueError, match="another type"):
        digest.compare_by_digest(live, base, digest.trusted_leaves(base, "k"))


def test_digest_opens_few_leaves(spark):
    base = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    live = base.withColumn("v", F.when(F.col("k").between(500, 519), F.lit(0)).otherwise(F.col("v")))
    digests = digest.trusted_leaves(base, "k")
    state = digest.open_leaves(live, digests)
    assert state.where("open").count() <= 20
    assert state.where("not open").agg(F.sum("rows")).first()[0] > 19900


def test_sql_functions_match_columns(spark):
    sqlnames.register(spark)
    df = spark.createDataFrame([(s,) for s in [" a ", " b ", "\x1cc\x85", "", None, "d", "\t e\tf \n", "it's"]], "s string")
    df.createOrReplaceTempView("padded_texts")
    got = spark.sql("SELECT s, py_strip(s) AS t, is_padded(s) AS p FROM padded_texts")
    assert rows(got) == rows(df.select("s", strip("s").alias("t"), (F.col("s") != strip("s")).alias("p")))
    got = spark.sql("SELECT row_credit(90, 100, 2), row_credit(101, 100, 2), row_credit(5, 0, 2), row_credit(500, 100, 2), "
                    "flag(null), flag(true), clamp01(3), clamp01(-1), is_missing(double('NaN')), is_missing(null), is_missing(0)").first()
    assert [round(x, 6) for x in got] == [0.9, 1.0, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0, True, True, False]


def test_time_layout_follows_the_values(spark):
    def infer(values):
        return casts.infer_time_formats(spark.createDataFrame([(v,) for v in values], "s string"), "s")
    assert infer(["03/04/2024", "13/04/2024", None, " "])[0] == "dd/MM/yyyy"
    assert infer(["03/04/2024", "04/13/2024"])[0] == "MM/dd/yyyy"
    assert infer(["03/04/2024"])[0] == "dd/MM/yyyy"  # a tie: the earlier candidate
    assert infer(["no time", None]) == () and infer([]) == ()
    df = spark.createDataFrame([(" 04/13/2024",), ("04/05/2024",), (None,), ("?",)], "s string")
    got = [r.s for r in repair.cast_column(df, "s", "datetime", formats=None).collect()]
    assert got == [datetime.datetime(2024, 4, 13), datetime.datetime(2024, 4, 5), None, None]
    with pytest.raises(ValueError, match="no text"):
        casts.time_format_counts(spark.range(1), "id")
