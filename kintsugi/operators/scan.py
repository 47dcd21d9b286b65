"""Ordered running computations without an unpartitioned window.

Row numbers, running sums and forward fill need an order.  A plain
``Window.orderBy(...)`` with no partition key moves every row into one task,
and ``Window.partitionBy(g)`` puts a hot group (say a third of all rows) into
one task.  ``segmented_scan`` instead:

1. range-partitions on ``(group keys, order keys, hash of the row)``, so a hot
   group, and even a hot tie in the order, is spread over many partitions, numbers
   the sorted rows and writes them once as a table in the shared folder, with one
   bucket per range partition.  This is the only shuffle of whole rows: later
   passes see the same layout, also after executor loss, read only the columns
   they need, and group by bucket without another exchange;
2. sums up each (partition, group) by plain aggregates.  Only the first and the
   last group of a partition can reach into another one; windows over those
   states, at most two per partition, give the carry into each partition;
3. computes the running values with windows over (partition, group), so no
   window holds more than one range partition, and adds the carry, a table of
   fewer rows than there are partitions, which is broadcast.

All of it is Spark SQL expressions: values of every type come back as they were.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from kintsugi.functions.nulls import nullify_nan
from kintsugi.functions.types import is_float
from kintsugi.session import materialize_bucketed

_SLOT, _POS, _TIE, _NUMBER = "__scan_slot", "__scan_pos", "__scan_tie", "__scan_nth"


@dataclass(frozen=True)
class ScanSpec:
    """``kind`` is ``count`` (1-based row number), ``sum`` (running sum, NULL
    and NaN counted as 0), ``last`` (last value so far that is neither: forward
    fill) or ``prev`` (the previous row's value in the group: lag 1)."""

    out: str
    kind: str
    src: str | None = None


def _source(df: DataFrame, spec: ScanSpec) -> Column:
    """What a spec runs over; integer sums stay integers, decimal sums decimals."""
    if spec.kind == "count":
        return F.lit(1).cast("long")
    dt = df.schema[spec.src].dataType
    if spec.kind == "prev":
        return F.col(spec.src)
    plain = nullify_nan(spec.src, dt)
    if spec.kind == "last":
        return plain
    if spec.kind != "sum":
        raise ValueError(f"unknown scan kind {spec.kind!r}")
    if isinstance(dt, T.BooleanType):
        plain = plain.cast("long")
    elif not is_float(dt) and not isinstance(dt, T.NumericType):
        plain = plain.cast("double")
    return F.coalesce(plain, F.lit(0))


@lru_cache(maxsize=32)
def _slots(buckets: int) -> tuple[int, ...]:
    """For each bucket the smallest number that Spark places in it, so that every range partition gets its own."""
    spark, reach, found = SparkSession.getActiveSession(), 8 * buckets, {}
    while len(found) < buckets:
        reach *= 4
        rows = spark.range(reach).groupBy(F.pmod(F.hash("id"), F.lit(buckets)).alias("b")).agg(F.min("id").alias("id")).collect()
        found = {r.b: r.id for r in rows}
    return tuple(found[b] for b in range(buckets))


class _Layout:
    """Rows in range partitions, numbered in order, one bucket per partition."""

    def __init__(self, df: DataFrame, order_by: list[str | Column], groups: list[str],
                 num_partitions: int | None):
        hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
        self.groups = groups
        order = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order_by] + [F.col(_TIE)]
        keys = [F.col(g).asc_nulls_first() for g in groups] + order
        tied = df.withColumn(_TIE, F.xxhash64(*hashable))
        # without an explicit count AQE sizes the range partitions by volume
        ranged = tied.repartitionByRange(num_partitions, *keys) if num_partitions else tied.repartitionByRange(*keys)
        buckets = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slots = F.array(*[F.lit(x) for x in _slots(buckets)])
        # the number of a sorted row: its partition's in the high bits, then its place in it
        numbered = ranged.sortWithinPartitions(*keys).drop(_TIE).withColumn(_POS, F.monotonically_increasing_id())
        placed = numbered.withColumn(_SLOT, F.get(slots, F.shiftright(_POS, 33).cast("int")))
        self.rows = materialize_bucketed(placed, _SLOT, buckets)

    def _carries(self, rows: DataFrame, specs: list[ScanSpec], names: list[str]) -> DataFrame:
        """(slot, group) that continue a group of an earlier partition, with what reaches them from there."""
        pos = F.col(_POS)
        state = {"sum": F.sum, "count": F.sum, "last": lambda x: F.max_by(x, F.when(x.isNotNull(), pos)),
                 "prev": lambda x: F.max_by(x, pos)}
        keys = [F.col(g).alias(n) for g, n in zip(self.groups, names, strict=True)]
        left = rows.groupBy(F.col(_SLOT).alias("__s"), *keys).agg(
            F.min(pos).alias("__first"), F.max(pos).alias("__last"),
            *[state[s.kind](_source(rows, s)).alias(f"__state{i}") for i, s in enumerate(specs)])
        of_slot = Window.partitionBy("__s")
        edge = left.withColumn("__from", F.min("__first").over(of_slot)).withColumn("__to", F.max("__last").over(of_slot)) \
            .where((F.col("__first") == F.col("__from")) | (F.col("__last") == F.col("__to")))
        in_order = Window.partitionBy(*names).orderBy("__first")
        before = in_order.rowsBetween(Window.unboundedPreceding, -1)
        carry = edge.select("__s", *names, F.lag("__first").over(in_order).alias("__earlier"), *[
            (F.last(f"__state{i}", ignorenulls=True).over(before) if s.kind == "last"
             else F.lag(f"__state{i}").over(in_order) if s.kind == "prev"
             else F.sum(f"__state{i}").over(before)).alias(f"__carry{i}") for i, s in enumerate(specs)])
        return carry.where(F.col("__earlier").isNotNull()).drop("__earlier")

    def scan(self, rows: DataFrame, specs: list[ScanSpec]) -> DataFrame:
        """``rows`` (those of the layout, perhaps with more columns) with the specs' columns."""
        within = Window.partitionBy(_SLOT, *self.groups).orderBy(_POS)
        upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {_NUMBER: F.row_number().over(within)}
        for s in specs:
            src = _source(rows, s)
            local[s.out] = {"count": lambda _: F.row_number().over(within).cast("long"),
                            "sum": lambda x: F.sum(x).over(upto),
                            "last": lambda x: F.last(x, ignorenulls=True).over(upto),
                            "prev": lambda x: F.lag(x).over(within)}[s.kind](src)
        done = rows.withColumns(local)
        names = [f"__g{i}" for i in range(len(self.groups))]
        on = _all([F.col(_SLOT) == F.col("__s")] + [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(self.groups, names, strict=True)])
        # fewer rows than partitions: bounded whatever the data
        met = done.join(F.broadcast(self._carries(rows, specs, names)), on, "left")
        kinds = done.schema
        values = []
        for i, s in enumerate(specs):
            own, came = F.col(s.out), F.col(f"__carry{i}")
            if s.kind == "prev":
                own = F.when(F.col(_NUMBER) == 1, came).otherwise(own)
            elif s.kind == "last":
                own = F.coalesce(own, came)
            else:
                own = F.when(came.isNull(), own).otherwise(own + came)
            values.append(own.cast(kinds[s.out].dataType).alias(s.out))
        return met.select(*[c for c in rows.columns if c not in {s.out for s in specs}], *values)


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def segmented_scan(df: DataFrame, order_by: list[str | Column], specs: list[ScanSpec],
                   partition_by: list[str] | None = None,
                   num_partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add running columns ``specs`` over ``order_by`` within ``partition_by``.

    ``keep`` names the columns of ``df`` that the result needs (all, if not
    given); others than these and the keys are not carried along.  Rows that tie in
    the order come in the order of a hash of the kept row, the same on every run."""
    groups = list(partition_by or [])
    if keep is not None:
        named = {*keep, *groups, *(s.src for s in specs if s.src), *(o for o in order_by if isinstance(o, str))}
        if all(isinstance(o, str) for o in order_by):
            df = df.select(*[c for c in df.columns if c in named])
    laid = _Layout(df, order_by, groups, num_partitions)
    out = laid.scan(laid.rows, specs)
    wanted = [c for c in df.columns if keep is None or c in keep]
    return out.select(*[c for c in wanted if c not in {s.out for s in specs}], *[s.out for s in specs])


def with_ordinal(df: DataFrame, order_by: list[str | Column], name: str = "ordinal",
                 partition_by: list[str] | None = None) -> DataFrame:
    """1-based position of each row in ``order_by`` (within ``partition_by``)."""
    return segmented_scan(df, order_by, [ScanSpec(name, "count")], partition_by)


def sessionize(df: DataFrame, key: str, ts: str, gap: str, tiebreak: list[str] | None = None,
               name: str = "session_no") -> DataFrame:
    """Number the sessions of each ``key``: a new session starts when the
    time since the key's previous event is at least ``gap`` (an interval
    such as ``"30 minutes"``), the rule of Spark's ``session_window``.

    Both steps (previous timestamp, running count of session starts) scan the
    same layout, so there is one range shuffle and one stored table, and one key
    holding a third of all events is still spread over many tasks.
    """
    laid = _Layout(df, [ts, *(tiebreak or [])], [key], None)
    x = laid.scan(laid.rows, [ScanSpec("__prev_ts", "prev", ts)])
    t, p = F.col(ts).cast("timestamp"), F.col("__prev_ts").cast("timestamp")
    starts = p.isNull() | ((t - p) >= F.expr(f"INTERVAL {gap}"))
    x = laid.scan(x.withColumn("__start", starts.cast("long")).drop("__prev_ts"), [ScanSpec(name, "sum", "__start")])
    return x.select(*df.columns, name)
