"""Cell-by-cell comparison of a live table with a trusted copy.

Cell rules, chosen by the trusted column's type:

* numbers: both sides read as numbers (unparsable text and NULL read as 0),
  ``|t - a| <= atol + rtol * |a|`` with ``a`` the live value, and the two
  raw values must agree on being missing;
* timestamps: live text is parsed; the difference must be under two whole
  days; NULL never matches;
* anything else: equality of the printed values (NULL prints alike on both
  sides, so two NULLs match).

The score is ``matched cells / (trusted rows * compared columns)``.

Keyed mode (default) joins on a key, so shuffled rows still line up; a
trusted key absent from the live table counts as all cells wrong, duplicate
live keys are counted and the first row in ``order_by`` is used.
Positional mode numbers both sides in a given order (``segmented_scan``,
never an unpartitioned window) and compares the first ``min(rows)`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from kintsugi.functions.casts import to_double, to_text, to_timestamp
from kintsugi.functions.nulls import is_missing, nullify_nan
from kintsugi.functions.types import family
from kintsugi.operators.joins import require_same_family
from kintsugi.operators.scan import with_ordinal

TWO_DAYS_US = 2 * 86400 * 10 ** 6


def cell_match(t_col: str, t_type: T.DataType, a_col: str, a_type: T.DataType,
               rtol: float = 0.01, atol: float = 0.01, null_rule: bool = True) -> Column:
    """Boolean: does live cell ``a_col`` match trusted cell ``t_col``?"""
    tf = family(t_type)
    if tf in ("number", "bool"):
        t = F.coalesce(nullify_nan(to_double(t_col, t_type), T.DoubleType()), F.lit(0.0))
        a = F.coalesce(nullify_nan(to_double(a_col, a_type), T.DoubleType()), F.lit(0.0))
        close = F.abs(t - a) <= F.lit(atol) + F.lit(rtol) * F.abs(a)
        if null_rule:
            close = close & (is_missing(t_col, t_type) == is_missing(a_col, a_type))
        return F.coalesce(close, F.lit(False))
    if tf == "time":
        t = F.unix_micros(to_timestamp(t_col, t_type))
        a = F.unix_micros(to_timestamp(a_col, a_type))
        return F.coalesce(F.abs(t - a) < F.lit(TWO_DAYS_US), F.lit(False))
    return to_text(t_col, t_type, null_text=True) == to_text(a_col, a_type, null_text=True)


def _common(live: DataFrame, trusted: DataFrame, columns: list[str] | None) -> list[str]:
    cols = [c for c in trusted.columns if c in live.columns]
    if columns is not None:
        cols = [c for c in cols if c in columns]
    return cols


def null_safe_key(col: Column, dt: T.DataType) -> tuple[Column, Column]:
    """``(coalesce(k, default), isnull(k))``: equal pairs exactly when the
    keys are equal or both NULL.  Grouping and joining on this pair with
    plain ``==`` lets the join reuse the grouping's hash partitioning."""
    fam = family(dt)
    if fam in ("number", "bool"):
        default = F.lit(0).cast(dt)
    elif fam == "text":
        default = F.lit("")
    else:
        col, default = col.cast("string"), F.lit("")
    return F.coalesce(col, default), col.isNull()


def _picked_live(live: DataFrame, key: str, order_by: list[str] | None):
    """One live row per null-safe key pair: the first in ``order_by``, with
    the number of live rows of that key.  Partial aggregation keeps a hot
    key to one candidate per partition."""
    lmap = {c: f"__a{i}" for i, c in enumerate(live.columns)}
    L = live.select(*[F.col(c).alias(lmap[c]) for c in live.columns])
    allc = [lmap[c] for c in live.columns]
    order = [lmap[o] for o in (order_by or [])] or allc
    lkc, lkn = null_safe_key(F.col(lmap[key]), live.schema[key].dataType)
    picked = L.groupBy(lkc.alias("__kc"), lkn.alias("__kn")).agg(
        F.count(F.lit(1)).alias("__dups"),
        F.min_by(F.struct(*[F.col(c) for c in allc]), F.struct(*[F.col(o) for o in order]))
        .alias("__row"))
    picked = picked.select("__kc", "__kn", "__dups", *[F.col(f"__row.{c}").alias(c) for c in allc],
                           F.lit(True).alias("__present"))
    return picked, lmap


def _trusted_keyed(trusted: DataFrame, key: str):
    tmap = {c: f"__t{i}" for i, c in enumerate(trusted.columns)}
    tkc, tkn = null_safe_key(F.col(key), trusted.schema[key].dataType)
    Tt = trusted.select(*[F.col(c).alias(tmap[c]) for c in trusted.columns],
                        tkc.alias("__tkc"), tkn.alias("__tkn"))
    return Tt, tmap


def _keyed_cells(live: DataFrame, trusted: DataFrame, key: str, cols: list[str],
                 order_by: list[str] | None, rtol: float, atol: float):
    """Trusted rows left-joined with the picked live row of their key (a
    left join: AQE can split a hot trusted key, NULL keys included)."""
    require_same_family(live, trusted, key)
    # only what is compared travels; a caller's order decides which row is picked
    needed = {key, *cols, *(order_by or live.columns)}
    picked, lmap = _picked_live(live.select(*[c for c in live.columns if c in needed]), key, order_by)
    Tt, tmap = _trusted_keyed(trusted.select(*[c for c in trusted.columns if c in {key, *cols}]), key)
    joined = Tt.join(picked, (Tt["__tkc"] == picked["__kc"]) & (Tt["__tkn"] == picked["__kn"]),
                     "left")
    present = F.coalesce(F.col("__present"), F.lit(False))
    matches = [present & cell_match(tmap[c], trusted.schema[c].dataType,
                                    lmap[c], live.schema[c].dataType, rtol, atol) for c in cols]
    return joined, matches, present, picked, Tt


def compare_keyed(live: DataFrame, trusted: DataFrame, key: str,
                  columns: list[str] | None = None, order_by: list[str] | None = None,
                  rtol: float = 0.01, atol: float = 0.01) -> DataFrame:
    """One row: trusted_rows, live_rows, compared_columns, matched_cells,
    total_cells, missing_keys, extra_rows, duplicate_live_keys, score.

    The live side is grouped once (dedup + per-key counts).  Cells come from
    a left join of the trusted rows; live keys absent from the trusted copy
    from an anti join against its distinct keys.  Both one-row aggregates
    sit in one plan (union, then sum), so the live grouping is computed once.
    """
    if key not in live.columns or key not in trusted.columns:
        raise KeyError(f"key {key!r} must exist on both sides")
    cols = _common(live, trusted, columns)
    if not cols:
        raise ValueError("no common column to compare")
    joined, matches, present, picked, Tt = _keyed_cells(live, trusted, key, cols, order_by,
                                                        rtol, atol)
    cells = sum((m.cast("long") for m in matches), F.lit(0))
    zero = F.lit(0).cast("long")
    names = ["trusted_rows", "live_rows", "matched_cells", "missing_keys", "extra_rows",
             "duplicate_live_keys"]

    def part(frame, **aggs):
        return frame.agg(*[(aggs[c] if c in aggs else zero).cast("long").alias(c) for c in names])

    # trusted side: rows, matching cells, keys without a live row
    part_t = part(joined, trusted_rows=F.count(F.lit(1)), matched_cells=F.sum(cells),
                  missing_keys=F.count_if(~present))
    # live side, from its own grouping (one row per key)
    part_l = part(picked, live_rows=F.sum("__dups"),
                  duplicate_live_keys=F.count_if(F.col("__dups") > 1))
    # live keys the trusted copy does not have
    tkeys = Tt.select("__tkc", "__tkn").distinct()
    extra = picked.join(tkeys, (picked["__kc"] == tkeys["__tkc"]) & (picked["__kn"] == tkeys["__tkn"]),
                        "left_anti")
    part_x = part(extra, extra_rows=F.count(F.lit(1)))
    agg = part_t.unionByName(part_l).unionByName(part_x).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in names])
    n = len(cols)
    total = F.col("trusted_rows") * n
    return agg.select(
        "trusted_rows", "live_rows", F.lit(n).alias("compared_columns"), "matched_cells",
        total.cast("long").alias("total_cells"), "missing_keys", "extra_rows",
        "duplicate_live_keys",
        F.when(total > 0, F.round(F.col("matched_cells") / total, 4)).otherwise(F.lit(0.0))
        .alias("score"))


def compare_columns(live: DataFrame, trusted: DataFrame, key: str,
                    columns: list[str] | None = None, order_by: list[str] | None = None,
                    rtol: float = 0.01, atol: float = 0.01) -> DataFrame:
    """Per-column breakdown ``(column_name, matched, total)`` of the keyed comparison."""
    cols = _common(live, trusted, columns)
    joined, matches, _, _, _ = _keyed_cells(live, trusted, key, cols, order_by, rtol, atol)
    agg = joined.agg(F.count(F.lit(1)).alias("__n"),
                     *[F.count_if(m).alias(f"__m{i}") for i, m in enumerate(matches)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__m{i}").alias("matched"),
                 F.col("__n").alias("total")) for i, c in enumerate(cols)])))


def _positional(live, trusted, live_order, trusted_order, cols):
    a = with_ordinal(live.select(*live.columns), live_order, "__pos")
    t = with_ordinal(trusted.select(*trusted.columns), trusted_order, "__pos")
    amap = {c: f"__a{i}" for i, c in enumerate(live.columns)}
    tmap = {c: f"__t{i}" for i, c in enumerate(trusted.columns)}
    A = a.select(F.col("__pos").alias("__apos"), *[F.col(c).alias(amap[c]) for c in live.columns])
    Tt = t.select("__pos", *[F.col(c).alias(tmap[c]) for c in trusted.columns])
    counts = [F.coalesce(x.select(F.max("__pos")).scalar(), F.lit(0)).cast("long") for x in (t, a)]
    return Tt.join(A, Tt["__pos"] == A["__apos"], "inner"), amap, tmap, counts


def compare_positional(live: DataFrame, trusted: DataFrame, live_order: list[str],
                       trusted_order: list[str], columns: list[str] | None = None,
                       rtol: float = 0.01, atol: float = 0.01) -> DataFrame:
    """Compare row i of ``live`` (in ``live_order``) with row i of ``trusted``.

    One row: trusted_rows, live_rows, compared_rows, matched_cells, score
    with score = matched / (trusted_rows * columns); 0 when either is empty.
    """
    cols = _common(live, trusted, columns)
    if not cols:
        raise ValueError("no common column to compare")
    joined, amap, tmap, (t_rows, l_rows) = _positional(live, trusted, live_order, trusted_order, cols)
    cells = sum((cell_match(tmap[c], trusted.schema[c].dataType, amap[c],
                            live.schema[c].dataType, rtol, atol).cast("long") for c in cols),
                F.lit(0))
    n = len(cols)
    agg = joined.agg(F.count(F.lit(1)).alias("compared_rows"), F.sum(cells).alias("m")) \
        .withColumns({"trusted_rows": t_rows, "live_rows": l_rows})
    t_rows = F.col("trusted_rows")
    return agg.select(
        "trusted_rows", "live_rows", "compared_rows",
        F.coalesce("m", F.lit(0)).cast("long").alias("matched_cells"),
        F.when((F.col("compared_rows") > 0) & (t_rows > 0),
               F.round(F.col("m") / (t_rows * n), 4)).otherwise(F.lit(0.0)).alias("score"))


def mismatch_ratio(live: DataFrame, trusted: DataFrame, live_order: list[str],
                   trusted_order: list[str], rtol: float = 0.01, atol: float = 0.01) -> DataFrame:
    """Share of differing cells over the first ``min(rows)`` rows: numbers
    by tolerance without the missing-flag test, others by printed text.
    0 rows gives 0.0 (nothing differs); no common column gives 1.0."""
    cols = _common(live, trusted, None)
    if not cols:
        return trusted.agg(F.lit(1.0).alias("mismatch_ratio"))
    joined, amap, tmap, _ = _positional(live, trusted, live_order, trusted_order, cols)
    diffs = sum(((~cell_match(tmap[c], trusted.schema[c].dataType, amap[c],
                              live.schema[c].dataType, rtol, atol, null_rule=False)).cast("long")
                 for c in cols), F.lit(0))
    n = len(cols)
    return joined.agg(F.count(F.lit(1)).alias("r"), F.sum(diffs).alias("d")).select(
        F.when(F.col("r") > 0, F.round(F.col("d") / (F.col("r") * n), 6))
        .otherwise(F.lit(0.0)).alias("mismatch_ratio"))


def mean_value_match(live: dict[str, DataFrame], trusted: dict[str, DataFrame],
                     keys: dict[str, str]) -> DataFrame:
    """Mean keyed score over the trusted tables; a trusted table with no
    live counterpart scores 0.  One row ``value_match`` (NULL when no
    trusted table is configured)."""
    if not trusted:
        spark = next(iter(live.values())).sparkSession if live else SparkSession.active()
        return spark.range(1).select(F.lit(None).cast("double").alias("value_match"))
    frames = []
    for name, t in trusted.items():
        if name in live:
            frames.append(compare_keyed(live[name], t, keys[name]).select(
                F.lit(name).alias("table_name"), F.col("score")))
        else:
            frames.append(t.agg(F.count(F.lit(1)).alias("__n")).select(
                F.lit(name).alias("table_name"), F.lit(0.0).alias("score")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.agg(F.avg("score").alias("value_match"))
