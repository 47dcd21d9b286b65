"""Single-key equi-joins with the guards the repair contract needs.

* text keys never join number keys (``TypeError`` at plan time): Spark
  would otherwise convert text to numbers implicitly and, under ANSI, fail
  at run time on bad text;
* int and float keys do join, on the double value;
* NULL matches NULL by default (``null_keys="match"``, planned as an
  equi-join on ``<=>``); ``null_keys="drop"`` keeps NULL keys unmatched.
  Every NULL row of one side meets every NULL row of the other: the left ones
  are dealt over ``NULL_SHARES`` shares by a hash of the row, the right ones go
  to each share, so this product is made by many tasks, not by one;
* non-key columns present on both sides get ``_x`` / ``_y`` suffixes;
* a same-name key appears once: left key for inner/left, right key for
  right, ``coalesce`` for full.

Where NULL may match NULL the join is sort-merge, with AQE splitting skewed
partitions: a broadcast would leave the product of the NULL rows to the few
tasks that read the left table.  Otherwise the physical strategy is left to
Catalyst and AQE: a side is broadcast only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (checked at plan time from statistics,
and again at run time by AQE from the actual shuffle size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from kintsugi.functions.types import family, field_type, is_float

#: Shares that the left rows with a NULL key are dealt over where NULL matches NULL.
NULL_SHARES = 64

HOWS = {"inner": "inner", "left": "left", "right": "right", "outer": "full", "full": "full"}


def _keys(on) -> tuple[str, str]:
    if isinstance(on, str):
        return on, on
    if isinstance(on, dict):
        return on["left"], on["right"]
    if isinstance(on, (tuple, list)) and len(on) == 2:
        return on[0], on[1]
    raise ValueError("on must be a column name, {'left': .., 'right': ..} or a pair")


def require_same_family(left: DataFrame, right: DataFrame, lk: str, rk: str | None = None) -> None:
    """Keys of different type families never join by accident."""
    rk = rk or lk
    lt, rt = field_type(left, lk), field_type(right, rk)
    if family(lt) != family(rt):
        raise TypeError(f"join key types differ: {lk} is {lt.simpleString()}, "
                        f"{rk} is {rt.simpleString()}; cast one side first")


def _key_exprs(left: DataFrame, right: DataFrame, lk: str, rk: str) -> tuple[Column, Column]:
    require_same_family(left, right, lk, rk)
    lc, rc = F.col(lk), F.col(rk)
    if _needs_double(left, right, lk, rk):
        lc, rc = lc.cast("double"), rc.cast("double")
    return lc, rc


def join_condition(lc: Column, rc: Column, null_keys: str) -> Column:
    if null_keys == "match":
        return lc.eqNullSafe(rc)
    if null_keys == "drop":
        return lc == rc
    raise ValueError("null_keys must be 'match' or 'drop'")


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    return not isinstance(dt, (T.MapType, T.VariantType))


def _join_dealt(L: DataFrame, R: DataFrame, lkey: Column, rkey: Column, null_keys: str, how: str) -> DataFrame:
    """Inner or left join; where NULL matches NULL, its rows are dealt over ``NULL_SHARES`` shares."""
    if null_keys != "match":
        return L.join(R, join_condition(lkey, rkey, null_keys), how)
    by = [F.col(f.name) for f in L.schema.fields if _hashable(f.dataType)]
    share = F.pmod(F.xxhash64(*by), F.lit(NULL_SHARES)) if by else F.lit(0)
    dealt = L.withColumn("__lshare", F.when(lkey.isNull(), share.cast("int")).otherwise(F.lit(-1)))
    shares = F.when(rkey.isNull(), F.sequence(F.lit(0), F.lit(NULL_SHARES - 1))).otherwise(F.array(F.lit(-1)))
    copied = R.withColumn("__rshare", F.explode(shares))
    met = join_condition(lkey, rkey, null_keys) & (F.col("__lshare") == F.col("__rshare"))
    return dealt.join(copied.hint("merge"), met, how).drop("__lshare", "__rshare")


def safe_join(left: DataFrame, right: DataFrame, on, how: str = "inner", *,
              null_keys: str = "match", suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    if how == "cross":
        raise ValueError("a cross join takes no key; not offered by safe_join")
    if how not in HOWS:
        raise ValueError(f"unknown join type {how!r}")
    lk, rk = _keys(on)
    for df, k, side in ((left, lk, "left"), (right, rk, "right")):
        if k not in df.columns:
            raise KeyError(f"join key {k!r} not found in {side} table; columns: {df.columns}")
    lkey, rkey = _key_exprs(left, right, lk, rk)
    same = lk == rk
    shared = (set(left.columns) & set(right.columns)) - ({lk} if same else set())

    lmap = {c: f"__l{i}" for i, c in enumerate(left.columns)}
    rmap = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    L = left.select(*[F.col(c).alias(lmap[c]) for c in left.columns])
    R = right.select(*[F.col(c).alias(rmap[c]) for c in right.columns])
    cast_keys = _needs_double(left, right, lk, rk)
    lkey_i = F.col(lmap[lk]).cast("double") if cast_keys else F.col(lmap[lk])
    rkey_i = F.col(rmap[rk]).cast("double") if cast_keys else F.col(rmap[rk])
    if HOWS[how] in ("full", "right"):
        # AQE splits a hot left key for inner and left joins, but not for
        # full and right ones, so those are planned as a left or inner join
        # plus the right rows without a partner (anti join against the
        # distinct left keys); both parts are skew-splittable
        lj = _join_dealt(L, R, lkey_i, rkey_i, null_keys, "left" if HOWS[how] == "full" else "inner")
        lkeys = L.select(lkey_i.alias("__lk")).distinct()
        orphans = R.join(lkeys, join_condition(rkey_i, F.col("__lk"), null_keys), "left_anti")
        orphans = orphans.select(*[F.lit(None).cast(left.schema[c].dataType).alias(lmap[c])
                                   for c in left.columns], *R.columns)
        joined = lj.unionByName(orphans)
    else:
        joined = _join_dealt(L, R, lkey_i, rkey_i, null_keys, HOWS[how])

    out = []
    for c in left.columns:
        if same and c == lk:
            if HOWS[how] == "right":
                key = F.col(rmap[rk])
            elif HOWS[how] == "full":
                key = F.coalesce(lkey_i, rkey_i)
            else:
                key = F.col(lmap[lk])
            out.append(key.alias(lk))
        else:
            out.append(F.col(lmap[c]).alias(c + suffixes[0] if c in shared else c))
    for c in right.columns:
        if same and c == rk:
            continue
        out.append(F.col(rmap[c]).alias(c + suffixes[1] if c in shared else c))
    return joined.select(*out)


def _needs_double(left: DataFrame, right: DataFrame, lk: str, rk: str) -> bool:
    lt, rt = field_type(left, lk), field_type(right, rk)
    return family(lt) == "number" and (is_float(lt) or is_float(rt)) and lt != rt


def join_report(left: DataFrame, right: DataFrame, on, *, null_keys: str = "match") -> DataFrame:
    """One row describing every join type's outcome, from key counts only.

    Each side is first reduced to ``(key, count)`` (map-side pre-aggregated,
    so a hot key costs one row per partition); the two count tables are
    joined on the key.  Row counts of inner/left/right/full joins follow by
    arithmetic, without materialising any join result.
    """
    from kintsugi.operators.compare import null_safe_key
    lk, rk = _keys(on)
    lkey, rkey = _key_exprs(left, right, lk, rk)
    lt = T.DoubleType() if _needs_double(left, right, lk, rk) else field_type(left, lk)
    rt = T.DoubleType() if _needs_double(left, right, lk, rk) else field_type(right, rk)
    if null_keys == "match":
        # group on the null-safe key pair so the join reuses the grouping's
        # hash partitioning (no second shuffle of either count table)
        (lkc, lkn), (rkc, rkn) = null_safe_key(lkey, lt), null_safe_key(rkey, rt)
    else:
        (lkc, lkn), (rkc, rkn) = (lkey, F.lit(False)), (rkey, F.lit(False))
    lc = left.groupBy(lkc.alias("kc"), lkn.alias("kn")).agg(F.count(F.lit(1)).alias("lc"))
    rc = right.groupBy(rkc.alias("kc"), rkn.alias("kn")).agg(F.count(F.lit(1)).alias("rc"))
    cond = (lc["kc"] == rc["kc"]) & (lc["kn"] == rc["kn"])
    both = lc.join(rc, cond, "full").select(
        F.coalesce("lc", F.lit(0)).alias("lc"), F.coalesce("rc", F.lit(0)).alias("rc"))
    l, r = F.col("lc"), F.col("rc")
    return both.agg(
        F.sum(l).cast("long").alias("left_rows"),
        F.sum(r).cast("long").alias("right_rows"),
        F.sum(l * r).cast("long").alias("inner_rows"),
        F.sum(F.when(r > 0, l * r).otherwise(l)).cast("long").alias("left_join_rows"),
        F.sum(F.when(l > 0, l * r).otherwise(r)).cast("long").alias("right_join_rows"),
        F.sum(F.when((l > 0) & (r > 0), l * r).otherwise(l + r)).cast("long").alias("full_join_rows"),
        F.sum(F.when(r == 0, l).otherwise(0)).cast("long").alias("unmatched_left"),
        F.sum(F.when(l == 0, r).otherwise(0)).cast("long").alias("unmatched_right"),
        F.count_if((l > 0) & (r > 1)).alias("fanout_keys"))


def unmatched_left(left: DataFrame, right: DataFrame, on, *, null_keys: str = "match") -> DataFrame:
    """Left rows without a partner (``left_anti``)."""
    lk, rk = _keys(on)
    lkey, rkey = _key_exprs(left, right, lk, rk)
    R = right.select(rkey.alias("__rk")).distinct()
    return left.join(R, join_condition(lkey, F.col("__rk"), null_keys), "left_anti")


def matched_left(left: DataFrame, right: DataFrame, on, *, null_keys: str = "match") -> DataFrame:
    """Left rows with at least one partner (``left_semi``)."""
    lk, rk = _keys(on)
    lkey, rkey = _key_exprs(left, right, lk, rk)
    R = right.select(rkey.alias("__rk")).distinct()
    return left.join(R, join_condition(lkey, F.col("__rk"), null_keys), "left_semi")
