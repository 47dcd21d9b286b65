"""Edge semantics: one test per case that the fixtures do not reach."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kintsugi.functions.casts import to_timestamp
from kintsugi.operators import actionlog, compare, contract, joins, repair, setops
from kintsugi.operators.scan import ScanSpec, segmented_scan, sessionize
from kintsugi.operators.score import Check, Rubric, score_message

BIG = 1 << 53


def test_scan_returns_every_column_unchanged(spark):
    rows = [(i, None if i % 3 == 0 else BIG + i % 2, None if i % 2 else BIG + i, Decimal(i) / 4,
             dt.datetime(9000, 1, 1) + dt.timedelta(i), float("nan") if i % 5 == 0 else (None if i % 5 == 1 else -0.0),
             {"k": i}) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, g long, big long, dec decimal(20,2), far timestamp_ntz, f double, m map<string,long>")
    got = segmented_scan(df, ["o"], [ScanSpec("n", "count"), ScanSpec("s", "sum", "big"), ScanSpec("p", "prev", "big"),
                                     ScanSpec("d", "sum", "dec")], partition_by=["g"], num_partitions=7)
    assert dict(got.dtypes)["s"] == "bigint" and dict(got.dtypes)["d"].startswith("decimal")
    back = {r.o: r for r in got.collect()}
    state: dict = {}
    for o, g, big, dec, far, f, m in rows:
        r, (n, s, prev, d) = back[o], state.get(g, (0, 0, None, Decimal(0)))
        assert (r.g, r.big, r.dec, r.far, r.m) == (g, big, dec, far, m) and repr(r.f) == repr(f)
        assert (r.n, r.s, r.p, r.d) == (n + 1, s + (big or 0), prev, d + dec)
        state[g] = (n + 1, s + (big or 0), big, d + dec)


def test_scan_splits_ties_and_keeps_only_named_columns(spark):
    df = spark.range(400).select(F.lit(1).alias("o"), "id", F.lit("x").alias("wide"))
    got = segmented_scan(df, ["o"], [ScanSpec("n", "count")], num_partitions=8, keep=["id"])
    assert got.columns == ["id", "n"]
    assert sorted(r.n for r in got.collect()) == list(range(1, 401))


def test_sessions_of_null_and_empty(spark):
    df = spark.createDataFrame([(None, 0), (None, 60), (None, 4000), ("a", 10)], "k string, s long") \
        .select("k", F.timestamp_seconds("s").alias("ts"))
    got = sessionize(df, "k", "ts", "30 minutes").collect()
    assert sorted((r.k or "", r.session_no) for r in got) == [("", 1), ("", 1), ("", 2), ("a", 1)]
    assert sessionize(df.limit(0), "k", "ts", "30 minutes").count() == 0


def test_epoch_nanoseconds_are_exact(spark):
    df = spark.createDataFrame([(1700000000123456999,), (-1,)], "v long")
    got = [r.us for r in df.select(F.unix_micros(to_timestamp("v", df.schema["v"].dataType)).alias("us")).collect()]
    assert got == [1700000000123456, -1]


def test_missing_action_type_is_invalid_and_costs(spark):
    log = spark.createDataFrame([("s", 1, 1, None, True, None), ("s", 2, 2, "finish", True, None)],
                                "session_id string, ts long, event_id long, action_type string, valid boolean, params_json string")
    a = actionlog.annotate(log)
    assert [(r.cost, r.invalid, r.active) for r in a.orderBy("step").collect()] == [(1.0, 1, True), (0.0, 0, True)]
    assert actionlog.session_end(a).first().ignored_actions == 0
    assert "None" in actionlog.audit(a).first().line


def test_constant_fill_needs_an_exact_value(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    with pytest.raises(ValueError):
        repair.fill_nulls(df, "v", 1.5)
    with pytest.raises(ValueError):
        repair.fill_nulls(df, "v", 1 << 40)
    assert sorted(r.v for r in repair.fill_nulls(df, "v", 2.0).collect()) == [1, 2]


def test_fill_without_a_gap_does_nothing(spark):
    df = spark.createDataFrame([("a",)], "v string")
    assert repair.fill_nulls(df, "v", strategy="median").first().v == "a"
    with pytest.raises(Exception, match="numeric"):
        repair.fill_nulls(spark.createDataFrame([(None,)], "v string"), "v", strategy="mean").collect()


def test_literals_of_other_families(spark):
    df = spark.createDataFrame([(True, dt.datetime(2020, 1, 1)), (False, dt.datetime(2021, 1, 1)), (None, None)], "b boolean, t timestamp")
    n = lambda c, op, v: repair.filter_rows(df, c, op, v).count()
    assert (n("b", "eq", 1), n("b", "ne", 1), n("b", "gt", 0)) == (1, 2, 1)
    assert (n("t", "eq", "nope"), n("t", "ne", "nope"), n("t", "gt", "2020-06-01")) == (0, 3, 1)


def test_comparison_refuses_keys_of_other_families(spark):
    a, b = spark.createDataFrame([("1", 1)], "k string, v int"), spark.createDataFrame([(1, 1)], "k long, v int")
    with pytest.raises(TypeError):
        compare.compare_keyed(a, b, "k")
    assert compare.mean_value_match({"a": a}, {}, {}).first().value_match is None


def test_contract_without_live_tables(spark):
    c = contract.Contract({"t": {"a": "int64"}}, {"t": 3})
    assert [(r.table_name, r.check_name) for r in contract.issues({}, c).collect()] == [("t", "missing_table")]
    s = contract.contract_scores({}, c).first()
    assert (s.schema_score, s.validity_score, s.row_integrity) == (0.0, 0.0, 0.0)
    assert contract.issues({}, contract.Contract({})).count() == 0


def test_gate_gives_its_score(spark):
    checks = [Check("a", 0.5, F.lit(1.0))]
    total = lambda **k: spark.range(1).select(Rubric(checks, **k).total_expr().alias("x")).first().x
    assert total(gate=F.lit(True), gate_score=0.25) == 0.25
    assert total(gate=F.lit(False), gate_score=0.25) == 0.5 and total(cap=0.15) == 0.15


def test_score_message(spark):
    text = spark.range(1).select(score_message(*[F.lit(float(x)) for x in (1, 0.5, 0, 0.1, 0, 0, 0.345)]).alias("x")).first().x
    assert text == "schema=1.00 | data=0.50 | rows=0.00 | step_pen=0.10 | inv_pen=0.00 | cost_pen=0.00 | total=0.345"


def test_right_join_keeps_rows_without_partner(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, l string")
    b = spark.createDataFrame([(1, "p"), (2, "q"), (None, "r")], "k int, r string")
    got = sorted((r.k or 0, r.l or "", r.r) for r in joins.safe_join(a, b, "k", "right").collect())
    assert got == [(0, "z", "r"), (1, "x", "p"), (1, "y", "p"), (2, "", "q")]


def test_keyed_sample_reads_the_whole_hash(spark):
    df = spark.range(200_000)
    assert setops.sample_rows(df, 1e-9, key=["id"]).count() == 0
    assert 800 < setops.sample_rows(df, 0.005, key=["id"]).count() < 1200


def test_row_facts_shuffle_only_hashes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("wide"))
    plan = repair.row_facts(df)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and all("wide" not in line for line in exchanged)
    assert "Join" not in plan
