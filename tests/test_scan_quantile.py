import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kintsugi.operators.quantile import exact_median, order_statistics
from kintsugi.operators.scan import ScanSpec, segmented_scan, with_ordinal


def test_scan_equals_windows_with_hot_group(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        g = 0 if i % 3 == 0 else rng.randint(1, 40)          # group 0 holds a third of rows
        v = None if rng.random() < 0.3 else float(rng.randint(0, 9))
        rows.append((i, g, rng.randint(0, 500), v))
    df = spark.createDataFrame(rows, "id long, g long, o long, v double")
    # an explicit partition count keeps several range partitions, so the
    # cross-partition carry is exercised even on small data
    got = segmented_scan(df, ["o", "id"], [ScanSpec("rn", "count"), ScanSpec("cs", "sum", "v"),
                                          ScanSpec("ff", "last", "v")], partition_by=["g"],
                         num_partitions=8)
    w = W.partitionBy("g").orderBy("o", "id")
    run = w.rowsBetween(W.unboundedPreceding, 0)
    exp = df.select("id", F.row_number().over(w).alias("rn"),
                    F.coalesce(F.sum("v").over(run), F.lit(0.0)).alias("cs"),
                    F.last("v", True).over(run).alias("ff"))
    a = {r.id: (r.rn, r.cs, r.ff) for r in got.select("id", "rn", "cs", "ff").collect()}
    b = {r.id: (r.rn, r.cs, r.ff) for r in exp.collect()}
    assert a == b


def test_global_ordinal_is_dense(spark):
    df = spark.range(0, 2000).withColumn("o", (F.col("id") * 7919) % 2003)
    got = segmented_scan(df, ["o"], [ScanSpec("pos", "count")], num_partitions=8).collect()
    assert sorted(r.pos for r in got) == list(range(1, 2001))
    by_o = sorted(got, key=lambda r: r.o)
    assert [r.pos for r in by_o] == list(range(1, 2001))


def test_exact_median_matches_sort(spark):
    rng = random.Random(3)
    vals = [float(rng.randint(0, 50)) for _ in range(2001)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    clean = sorted(v for v in vals if v is not None and v == v)
    n = len(clean)
    assert exact_median(df, "v") == (clean[(n - 1) // 2] + clean[n // 2]) / 2
    # force several refinement passes with a tiny band
    assert order_statistics(df, "v", [0, n // 3, n - 1]) == \
        [clean[0], clean[n // 3], clean[n - 1]]


def test_float_group_keys_keep_null_and_nan_apart(spark):
    rows = [(i, None if i % 2 else float("nan"), i) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, g double, o long")
    got = segmented_scan(df, ["o"], [ScanSpec("rn", "count")], partition_by=["g"], num_partitions=3)
    w = W.partitionBy("g").orderBy("o")
    exp = df.select("id", F.row_number().over(w).alias("rn"))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, exp.collect()))


def test_scan_keeps_nan_in_passthrough_columns(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.5)], "k long, x double")
    got = {r.k: r.x for r in segmented_scan(df, ["k"], [ScanSpec("rn", "count")], num_partitions=2).collect()}
    assert got[1] != got[1] and got[2] is None and got[3] == 1.5   # NaN stays NaN, NULL stays NULL


def test_order_statistics_with_heavy_ties(spark):
    # a third of the values share one number: bounds stop shrinking on ties
    vals = [7.0] * 700 + [float(i) for i in range(1400)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    clean = sorted(vals)
    ks = [0, 500, 1049, 1050, 1400, 2099]
    assert order_statistics(df, "v", ks) == [clean[k] for k in ks]
    same = spark.createDataFrame([(3.0,)] * 500, "v double")
    assert order_statistics(same, "v", [0, 250, 499]) == [3.0, 3.0, 3.0]


def test_prev_equals_lag(spark):
    rng = random.Random(11)
    rows = [(i, 0 if i % 3 == 0 else rng.randint(1, 9), rng.randint(0, 300)) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g long, o long") \
        .withColumn("ts", F.timestamp_seconds(F.col("o") * 60).cast("timestamp_ntz"))
    got = segmented_scan(df, ["o", "id"], [ScanSpec("p", "prev", "ts"), ScanSpec("po", "prev", "o")],
                         partition_by=["g"], num_partitions=6)
    w = W.partitionBy("g").orderBy("o", "id")
    exp = df.select("id", F.lag("ts").over(w).alias("p"), F.lag("o").over(w).alias("po"))
    assert sorted(map(tuple, got.select("id", "p", "po").collect())) == sorted(map(tuple, exp.collect()))


def test_rows_are_shuffled_and_windowed_once(spark, tables):
    from kintsugi.operators import actionlog
    from kintsugi.sources import fixtures as fx
    scanned = actionlog.annotate(fx.action_log(tables))
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    # what is exchanged after the layout are the states at partition borders, behind an aggregate
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastExchange") == 1
    rows_side = plan[plan.index("BroadcastHashJoin"):plan.index("BroadcastExchange")]
    assert rows_side.count("Window [") == 1 and "Exchange" not in rows_side


def test_every_range_partition_has_a_bucket_of_its_own(spark):
    from kintsugi.operators.scan import _slots
    for n in (1, 7, 64):
        slots = _slots(n)
        got = spark.createDataFrame([(s,) for s in slots], "s long").select(F.pmod(F.hash("s"), F.lit(n)).alias("b")).collect()
        assert [r.b for r in got] == list(range(n))
