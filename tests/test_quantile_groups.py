"""Rank search per group and over wide ranges of values against sorting."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from kintsugi.operators import quantile, repair

INF, NAN = float("inf"), float("nan")


def plain_medians(rows):
    groups = {}
    for g, v in rows:
        if v is not None and v == v:
            groups.setdefault(g, []).append(v)
    return {g: statistics.median(vs) for g, vs in groups.items()}


def wide_values(n, seed):
    rng = random.Random(seed)
    return [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(n)]


def test_group_medians_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"g{rng.randint(0, 25)}", rng.choice([None, NAN, rng.gauss(0, 1), rng.randint(-3, 3) * 1.0, 5e-324]))
            for i in range(6000)]
    rows += [(None, 3.0), (None, 4.0), ("one", -0.0), ("empty", None), ("wide", -INF), ("wide", 1e308), ("wide", INF), ("ties", 2.0), ("ties", 2.0)]
    rows += [("spread", v) for v in wide_values(400, 2)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r["median"] for r in quantile.group_medians(df, "v", ["g"]).collect()}
    assert got == plain_medians(rows)


def test_group_medians_over_two_keys_and_integers(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, NAN, 0.5]), rng.choice([None, rng.randint(-9, 9)])) for _ in range(800)]
    df = spark.createDataFrame(rows, "a int, b double, v long")
    got = {(r.a, str(r.b)): r["median"] for r in quantile.group_medians(df, "v", ["a", "b"]).collect()}
    assert got == plain_medians([((a, str(b)), v) for a, b, v in rows])


def test_group_order_statistics_at_named_ranks(spark):
    rows = [(i % 4, float((i * 7919) % 1000)) for i in range(1200)]
    df = spark.createDataFrame(rows, "g int, v double")
    found = quantile.group_order_statistics(df, "v", ["g"], lambda n: [F.lit(0), F.lit(0), F.floor(n / 3), n - 1, n, F.lit(-1)]).collect()
    plain = {g: sorted(v for k, v in rows if k == g) for g in range(4)}
    assert sorted(map(tuple, found)) == sorted((g, k, vs[k]) for g, vs in plain.items() for k in (0, 100, 299))
    assert quantile.group_order_statistics(df.limit(0), "v", ["g"], lambda n: [n]).count() == 0


@pytest.mark.parametrize("values", [
    [10.0 ** k for k in range(-300, 301)],
    [-(10.0 ** k) for k in range(-300, 301, 2)] + [10.0 ** k for k in range(-300, 301, 3)],
    wide_values(700, 3),
    [1.0 + k * 2.0 ** -52 for k in range(601)],
    [k * 5e-324 for k in range(-300, 301)],
    [-INF] * 3 + [INF] * 5 + [1.7976931348623157e308, 0.0],
    [7.0] * 500 + [float(k) for k in range(400)],
], ids=["powers", "signs", "random", "neighbours", "subnormal", "infinite", "ties"])
def test_six_passes_at_most_for_any_data(spark, values, monkeypatch):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    clean = sorted(values)
    calls = []
    place = quantile._place
    monkeypatch.setattr(quantile, "_place", lambda *a: calls.append(1) or place(*a))
    for rank in (0, len(clean) // 3, len(clean) - 1):
        calls.clear()
        assert quantile.order_statistics(df, "v", [rank]) == [clean[rank]]
        assert len(calls) <= 6
    ranks = sorted({0, 1, len(clean) // 2, len(clean) - 2, len(clean) - 1})
    assert quantile.order_statistics(df, "v", ranks) == [clean[k] for k in ranks]
    calls.clear()
    got = quantile.group_medians(df.withColumn("g", F.lit(1)), "v", ["g"]).collect()
    assert [r["median"] for r in got] == [(clean[(len(clean) - 1) // 2] + clean[len(clean) // 2]) / 2]
    assert len(calls) <= 6


def test_grouped_fill_gathers_no_group(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id") * 1.5).alias("v"))
    filled = repair.fill_nulls(df, "v", strategy="median", partition_by=["g"])
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect" not in plan
    medians = plain_medians([(i % 3, i * 1.5 if i % 7 else None) for i in range(3000)])
    assert sorted(map(tuple, filled.collect())) == sorted((i % 3, i * 1.5 if i % 7 else medians[i % 3]) for i in range(3000))
