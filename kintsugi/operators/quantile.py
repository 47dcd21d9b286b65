"""Exact order statistics of a numeric column, of the whole table or per group, without one huge task.

``F.median`` merges a map of every distinct value into one task.  Here the wanted
ranks are found by histogram: the interval that holds a rank is cut into
``BUCKETS`` buckets, Spark counts each and notes its smallest and largest value,
and the bucket that holds the rank becomes the next interval.  An interval over
several magnitudes is cut by the logarithm (signed), so its buckets reach less
than a factor of three; any other one is cut evenly.  After one logarithmic pass, even
ones shrink an interval 4096-fold down to neighbouring doubles: at most six passes
for any data, whatever the number of rows, their spread or their ties.

For groups, the same search runs for all of them at once: a table of open
intervals (at most one row per group and rank) is joined with the group's
values, and one aggregate per pass counts (group, interval, bucket).  Partial
aggregation leaves at most ``BUCKETS + 2`` rows per interval and task, so a group
that holds a third of all rows is counted by many tasks and never gathered.

Values are compared as doubles.  Missing values (NULL, NaN) do not count;
infinite ones do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from kintsugi.functions.nulls import is_missing
from kintsugi.session import materialize

BUCKETS = 4096
# |ln| of a finite double stays below 746; infinite values get a place of their own beyond
_LOG_ZERO, _LOG_INF = 746.0, 2000.0


def _magnitude(v: Column) -> Column:
    """A value on a signed logarithmic scale: monotone, 0 at 0, finite for every value."""
    size = F.least(F.ln(F.abs(v)) + _LOG_ZERO, F.lit(_LOG_INF))
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * size)


def _place(v: Column, lo: Column, hi: Column) -> Column:
    """Bucket of ``v`` in the interval from ``lo`` to ``hi`` (lo < hi): lo falls into the first, hi into the last."""
    narrow = (F.signum(lo) == F.signum(hi)) & (F.abs(hi) <= 4 * F.abs(lo)) & (F.abs(lo) <= 4 * F.abs(hi)) \
        & (F.abs(lo) != float("inf")) & (F.abs(hi) != float("inf"))
    even = (v - lo) / (hi - lo)
    low, high = _magnitude(lo), _magnitude(hi)
    share = F.when(narrow, even).otherwise((_magnitude(v) - low) / (high - low))
    inner = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    return F.when(v == lo, -1).when(v == hi, BUCKETS).otherwise(inner)


def _values(df: DataFrame, column: str) -> DataFrame:
    dt = df.schema[column].dataType
    return materialize(df.filter(~is_missing(column, dt)).select(F.col(column).cast("double").alias("v")))


def _at_ranks(values: DataFrame, stats, ranks: list[int]) -> dict[int, float]:
    """Values at 0-based ranks; ``stats`` has the column's n, lo and hi.  One job per pass, for all open intervals."""
    found: dict[int, float] = {}
    todo = [(stats.lo, stats.hi, 0, sorted(set(ranks)))]  # interval, values below it, ranks inside
    while todo:
        for lo, _, _, inside in (x for x in todo if x[0] == x[1]):
            found.update(dict.fromkeys(inside, lo))
        todo = [x for x in todo if x[0] < x[1]]
        if not todo:
            break
        v, slot = F.col("v"), None
        for i, (lo, hi, _, _) in enumerate(todo):
            here = F.struct(F.lit(i).alias("i"), _place(v, F.lit(lo), F.lit(hi)).alias("b"))
            slot = F.when(v.between(lo, hi), here) if slot is None else slot.when(v.between(lo, hi), here)
        counts = values.select("v", slot.alias("s")).where("s is not null").groupBy("s").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        after = []
        for i, (_, _, below, inside) in enumerate(todo):
            for row in sorted((r for r in counts if r.s.i == i), key=lambda r: r.s.b):
                mine = [k for k in inside if below <= k < below + row.n]
                if mine:
                    after.append((row.lo, row.hi, below, mine))
                below += row.n
        todo = after
    return found


def order_statistics(df: DataFrame, column: str, ranks: list[int]) -> list[float]:
    """Values at 0-based ``ranks`` among the non-missing values, ascending."""
    values = _values(df, column)
    found = _at_ranks(values, _stats(values), ranks)
    return [found[k] for k in ranks]


def _stats(values: DataFrame):
    return values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()


def exact_median(df: DataFrame, column: str) -> float | None:
    values = _values(df, column)
    stats = _stats(values)
    if not stats.n:
        return None
    middle = [(stats.n - 1) // 2, stats.n // 2]
    found = _at_ranks(values, stats, middle)
    return (found[middle[0]] + found[middle[1]]) / 2.0


def group_order_statistics(df: DataFrame, column: str, groups: list[str],
                           ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(groups..., rank, value) of the non-missing values at the 0-based ranks that ``ranks`` names, given the column
    with the number of a group's values (bigint expressions; ranks outside 0 to n - 1 have no row, equal ones have
    one).  NULL is a group like any other; groups without a value have no row."""
    dt = df.schema[column].dataType
    names = [f"__g{i}" for i in range(len(groups))]
    keyed = df.filter(~is_missing(column, dt)).select(*[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)],
                                                      F.col(column).cast("double").alias("v"))
    # equal values of a group become one row with their number before anything is stored
    values = materialize(keyed.groupBy(*names, "v").agg(F.count(F.lit(1)).alias("n")))
    total = values.groupBy(*names).agg(F.sum("n").alias("__n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    wanted = F.array_distinct(F.filter(F.array(*[k.cast("long") for k in ranks(F.col("__n"))]), lambda k: (k >= 0) & (k < F.col("__n"))))
    state = materialize(total.select(*names, "lo", "hi", F.lit(0).cast("long").alias("below"), wanted.alias("ranks")).where(F.size("ranks") > 0))
    done = [state.where("lo = hi")]
    open_ = state.where("lo < hi")
    while open_.limit(1).count():
        same = F.lit(True)
        for n in names:
            same = same & F.col(f"x.{n}").eqNullSafe(F.col(f"s.{n}"))
        met = values.alias("x").join(open_.alias("s"), same & F.col("x.v").between(F.col("s.lo"), F.col("s.hi")))
        counted = met.groupBy(*[F.col(f"x.{n}") for n in names], F.col("s.lo").alias("from"), F.col("s.below"), F.col("s.ranks"),
                              _place(F.col("x.v"), F.col("s.lo"), F.col("s.hi")).alias("b")) \
            .agg(F.sum("x.n").alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
        # at most BUCKETS + 2 rows per window
        before = Window.partitionBy(*names, "from").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("below", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = F.filter("ranks", lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("n")))
        state = materialize(placed.withColumn("ranks", inside).where(F.size("ranks") > 0).select(*names, "lo", "hi", "below", "ranks"))
        done.append(state.where("lo = hi"))
        open_ = state.where("lo < hi")
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.select(*[F.col(n).alias(g) for g, n in zip(groups, names, strict=True)], F.explode("ranks").alias("rank"), F.col("lo").alias("value"))


def group_medians(df: DataFrame, column: str, groups: list[str]) -> DataFrame:
    """(groups..., median) of the non-missing values of each group that has one."""
    middle = group_order_statistics(df, column, groups, lambda n: [F.floor((n - 1) / 2), F.floor(n / 2)])
    least, most = F.min("value"), F.max("value")
    return middle.groupBy(*groups).agg(F.when(least == most, least).otherwise((least + most) / 2).alias("median"))


def median_column(df: DataFrame, column: str, exact: bool = True) -> Column:
    """The median as a literal (exact) or as a scalar subquery (approximate)."""
    if exact:
        return F.lit(exact_median(df, column))
    dt = df.schema[column].dataType
    return df.filter(~is_missing(column, dt)).select(
        F.percentile_approx(F.col(column).cast("double"), 0.5, 10000)).scalar()
