"""Repairs: cast, rename, strip, project, fill, deduplicate, filter.

All functions are lazy DataFrame → DataFrame transforms, except where a
report (a one-row DataFrame) is asked for.  Errors that the schema alone
reveals (unknown column, name clash, wrong literal type) raise while the
plan is built; errors that depend on values surface when the plan runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from kintsugi.functions.casts import DEFAULT_TIME_FORMATS, cast_expr, infer_time_formats
from kintsugi.functions.nulls import is_missing, nullify_nan
from kintsugi.functions.text import camel_to_snake, strip
from kintsugi.functions.types import family, field_type, is_float, resolve_alias, value_family
from kintsugi.operators.quantile import exact_median, group_medians
from kintsugi.operators.scan import ScanSpec, segmented_scan


def _require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"column(s) {missing} not found; columns: {df.columns}")


def _replace(df: DataFrame, column: str, expr: Column) -> DataFrame:
    """Replace a column in place, keeping the column order."""
    return df.select(*[expr.alias(c) if c == column else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- casts ----

def cast_column(df: DataFrame, column: str, target: str, *, on_error: str = "null",
                null_text: bool = False, truthy: bool = True,
                formats: tuple[str, ...] | None = DEFAULT_TIME_FORMATS) -> DataFrame:
    """Cast one column.  For integer targets ``on_error="fail"`` makes the
    job fail on the first value without an integer form (all-or-nothing);
    ``"null"`` leaves such values NULL.  ``formats=None`` takes the time layouts
    of a text from its values (one aggregate, see ``casts.infer_time_formats``)."""
    _require(df, column)
    dt = field_type(df, column)
    if formats is None:
        infer = family(dt) == "text" and resolve_alias(target) == "datetime64[ns]"
        formats = (infer and infer_time_formats(df, column)) or DEFAULT_TIME_FORMATS
    src, pre = _prestrip(df, column, target)
    expr, strict = cast_expr(column, dt, target, null_text=null_text, truthy=truthy,
                             formats=formats, stripped_col=pre)
    if strict and on_error == "fail":
        msg = f"cannot cast {column!r} to {target}: missing, non-numeric or fractional value"
        expr = F.when(expr.isNull(), F.raise_error(F.lit(msg))).otherwise(expr)
    return _replace(src, column, expr).select(*df.columns)


_STRIP_TMP = "__stripped"


def _prestrip(df: DataFrame, column: str, target: str) -> tuple[DataFrame, str | None]:
    """Text parsed into numbers or times is stripped first; the stripped
    value is projected once so the parse expressions reuse it."""
    if family(field_type(df, column)) != "text" or resolve_alias(target) in ("object", "bool"):
        return df, None
    return df.withColumn(_STRIP_TMP, strip(column)), _STRIP_TMP


def cast_report(df: DataFrame, column: str, target: str, **kw) -> DataFrame:
    """One row: rows, values missing before, values that fail (strict
    targets) or turn NULL (coercing targets), and whether a strict cast
    would succeed."""
    _require(df, column)
    dt = field_type(df, column)
    src, pre = _prestrip(df, column, target)
    expr, strict = cast_expr(column, dt, target, stripped_col=pre, **kw)
    present = ~is_missing(column, dt)
    lost = present & expr.isNull()
    rep = src.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~present).alias("missing_before"),
                 F.count_if(lost).alias("failed"))
    if strict:
        ok = (F.col("failed") == 0) & (F.col("missing_before") == 0)
    else:
        ok = F.lit(True)
    return rep.select(F.lit(column).alias("column_name"), F.lit(target).alias("target"),
                      "rows", "missing_before", "failed", ok.alias("cast_ok"))


# --------------------------------------------------------------- rename ----

def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    _require(df, old)
    if new != old and new in df.columns:
        raise ValueError(f"cannot rename {old!r} to {new!r}: name already used")
    return df.withColumnRenamed(old, new)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    _require(df, *mapping)
    final = [mapping.get(c, c) for c in df.columns]
    if len(set(final)) != len(final):
        raise ValueError(f"renaming would duplicate a column name: {final}")
    return df.withColumnsRenamed(mapping)


def snake_case_columns(df: DataFrame) -> DataFrame:
    return rename_columns(df, {c: camel_to_snake(c) for c in df.columns
                               if camel_to_snake(c) != c})


def strip_column(df: DataFrame, column: str) -> DataFrame:
    _require(df, column)
    if family(field_type(df, column)) != "text":
        raise TypeError(f"strip needs a text column; {column!r} is {field_type(df, column)}")
    return _replace(df, column, strip(column))


def project_common(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of ``columns`` that ``df`` has, in the order of ``columns``."""
    return df.select(*[c for c in columns if c in df.columns])


# ----------------------------------------------------------------- fill ----

def mode_value(df: DataFrame, column: str) -> Column:
    """Most frequent non-missing value, the smallest on ties (scalar subquery).

    ``groupBy(value)`` is pre-aggregated map-side, so a hot value costs one
    row per partition; the final pick is a global aggregate of candidates."""
    dt = field_type(df, column)
    counts = df.filter(~is_missing(column, dt)).groupBy(column).count()
    return counts.select(F.min_by(F.col(column), F.struct(-F.col("count"), F.col(column)))).scalar()


def fill_nulls(df: DataFrame, column: str, value=None, strategy: str | None = None, *,
               order_by: list[str] | None = None, partition_by: list[str] | None = None,
               exact_median_fill: bool = True) -> DataFrame:
    """Fill missing values (NULL, and NaN in float columns).

    strategy: ``mean`` | ``median`` | ``mode`` | ``ffill`` | None (constant
    ``value``).  ``ffill`` needs ``order_by`` because DataFrames have no row
    order; ``partition_by`` restricts mean/mode/ffill to groups.
    """
    _require(df, column, *(partition_by or []), *(order_by or []))
    dt = field_type(df, column)
    c = F.col(column)
    miss = is_missing(column, dt)
    numeric = family(dt) in ("number", "bool")
    out_t = T.DoubleType() if (strategy in ("mean", "median") and not is_float(dt)) else dt

    if strategy in ("mean", "median") and not numeric:
        # nothing missing is nothing to fill; a value without a mean fails the job when it is met
        msg = f"{strategy} fill needs a numeric column; {column!r} is {dt.simpleString()}"
        return _replace(df, column, F.when(miss, F.raise_error(F.lit(msg)).cast(dt)).otherwise(c))

    if strategy == "mean":
        if partition_by:
            stats = df.groupBy(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(partition_by)]).agg(
                F.avg(nullify_nan(column, dt).cast("double")).alias("__fill"))
            return _join_group_fill(df, stats, column, partition_by, miss, c.cast(out_t))
        fill = df.select(F.avg(nullify_nan(column, dt).cast("double"))).scalar()
        return _replace(df, column, F.when(miss, fill).otherwise(c.cast(out_t)))

    if strategy == "median":
        if partition_by:
            named = [F.col(g).alias(f"__g{i}") for i, g in enumerate(partition_by)]
            stats = group_medians(df, column, partition_by).select(*named, F.col("median").alias("__fill"))
            return _join_group_fill(df, stats, column, partition_by, miss, c.cast(out_t))
        m = exact_median(df, column) if exact_median_fill else None
        fill = F.lit(m).cast("double") if exact_median_fill else df.filter(~miss).select(
            F.percentile_approx(c.cast("double"), 0.5, 10000)).scalar()
        return _replace(df, column, F.when(miss, fill).otherwise(c.cast(out_t)))

    if strategy == "mode":
        if partition_by:
            gk = [F.col(g).alias(f"__g{i}") for i, g in enumerate(partition_by)]
            counts = df.filter(~miss).groupBy(*gk, F.col(column).alias("__v")).count()
            modes = counts.groupBy(*[f"__g{i}" for i in range(len(partition_by))]).agg(
                F.min_by(F.col("__v"), F.struct(-F.col("count"), F.col("__v"))).alias("__fill"))
            return _join_group_fill(df, modes, column, partition_by, miss, c)
        fill = mode_value(df, column)
        guarded = F.coalesce(fill, F.raise_error(
            F.lit(f"mode of {column!r} is undefined: no value present")).cast(dt))
        return _replace(df, column, F.when(miss, guarded).otherwise(c))

    if strategy == "ffill":
        if not order_by:
            raise ValueError("ffill needs order_by: DataFrames have no row order")
        src = "__ffill_src"
        prepared = df.withColumn(src, nullify_nan(column, dt))
        scanned = segmented_scan(prepared, order_by, [ScanSpec("__ffill", "last", src)],
                                 partition_by=partition_by)
        return scanned.select(*[F.col("__ffill").alias(x) if x == column else F.col(x)
                                for x in df.columns])

    # constant
    if value is None:
        raise ValueError("a constant fill needs a value")
    vf, cf = value_family(value), family(dt)
    if not (vf == cf or (vf == "number" and cf == "number") or (vf == "text" and cf == "time")):
        raise TypeError(f"fill value {value!r} does not fit column {column!r} ({dt.simpleString()})")
    if isinstance(dt, T.IntegralType) and not isinstance(value, bool):
        bits = 8 * {"tinyint": 1, "smallint": 2, "int": 4}.get(dt.simpleString(), 8) - 1
        if value != value or value in (float("inf"), -float("inf")) or int(value) != value or not -(1 << bits) <= value < 1 << bits:
            raise ValueError(f"fill value {value!r} has no {dt.simpleString()} form; column {column!r} would change it")
    return _replace(df, column, F.when(miss, F.lit(value).cast(dt)).otherwise(c))


def _join_group_fill(df: DataFrame, stats: DataFrame, column: str, partition_by: list[str],
                     miss: Column, keep: Column) -> DataFrame:
    """Attach per-group fill values (one row per group) and fill.  Skewed
    groups are split by AQE's skew-join handling; a small stats side is
    broadcast by AQE from its measured size."""
    cond = None
    for i, g in enumerate(partition_by):
        e = F.col(g).eqNullSafe(F.col(f"__g{i}"))
        cond = e if cond is None else cond & e
    joined = df.join(stats, on=cond, how="left")
    expr = F.when(miss, F.col("__fill")).otherwise(keep)
    return joined.select(*[expr.alias(x) if x == column else F.col(x) for x in df.columns])


# ---------------------------------------------------------------- dedup ----

def drop_duplicates(df: DataFrame, subset: list[str] | None = None,
                    order_by: list[str] | None = None) -> DataFrame:
    """Keep one row per distinct ``subset`` (all columns when None).

    With ``order_by`` the first row in that order is kept, via a ``min_by``
    aggregate: partial aggregation runs map-side, so a key holding a third
    of all rows costs one candidate row per partition, not one huge task.
    """
    if subset:
        _require(df, *subset)
    if not subset or set(subset) == set(df.columns):
        return df.dropDuplicates()
    if not order_by:
        return df.dropDuplicates(subset)
    _require(df, *order_by)
    rest = [c for c in df.columns if c not in subset]
    picked = df.groupBy(*subset).agg(
        F.min_by(F.struct(*[F.col(c) for c in rest]),
                 F.struct(*[F.col(o) for o in order_by])).alias("__row"))
    return picked.select(*[F.col(c) if c in subset else F.col(f"__row.{c}").alias(c)
                           for c in df.columns])


def row_hash(df: DataFrame, cols: list[str], salt: str | None = None) -> Column:
    """64-bit hash of the row; -0.0 is folded into 0.0 (grouping treats
    them as equal) and NaN hashes canonically.  NULLs are told apart from
    values by position; a salt gives another hash."""
    parts = [] if salt is None else [F.lit(salt)]
    for c in cols:
        dt = field_type(df, c)
        col = F.col(c)
        if is_float(dt):
            col = F.when(col == 0, F.lit(0.0).cast(dt)).otherwise(col)
        parts += [col, col.isNull()]
    return F.xxhash64(*parts)


def row_facts(df: DataFrame, null_columns: list[str] | None = None,
              subset: list[str] | None = None) -> DataFrame:
    """One row: ``rows``, ``duplicates`` (rows minus distinct rows over
    ``subset``, NULLs equal) and ``__n{i}`` missing counts of ``null_columns``.

    One pass groups rows by two independent 64-bit hashes and carries the
    missing counts in the same map-side pre-aggregation, so whole rows are
    never shuffled.  Two different rows count as equal with a chance below
    rows^2 / 2^128.
    """
    keys = subset or df.columns
    null_columns = null_columns or []
    hashed = df.select(row_hash(df, keys).alias("__h"), row_hash(df, keys, "second").alias("__h2"), *[
        is_missing(c, field_type(df, c)).cast("long").alias(f"__n{i}")
        for i, c in enumerate(null_columns)])
    per_hash = hashed.groupBy("__h", "__h2").agg(F.count(F.lit(1)).alias("__rows"), *[
        F.sum(f"__n{i}").alias(f"__n{i}") for i in range(len(null_columns))])
    return per_hash.agg(
        F.coalesce(F.sum("__rows"), F.lit(0)).cast("long").alias("rows"),
        *[F.coalesce(F.sum(f"__n{i}"), F.lit(0)).cast("long").alias(f"__n{i}") for i in range(len(null_columns))],
        F.coalesce(F.sum(F.col("__rows") - 1), F.lit(0)).cast("long").alias("duplicates"))


def dedup_report(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """One row: rows before, rows after, rows dropped (NULLs equal); rows are
    counted by two 64-bit hashes, see ``row_facts``."""
    f = row_facts(df, subset=subset)
    return f.select(F.col("rows").alias("rows_before"),
                    (F.col("rows") - F.col("duplicates")).alias("rows_after"),
                    F.col("duplicates").alias("dropped"))


def duplicate_count(df: DataFrame, subset: list[str] | None = None) -> Column:
    """Rows minus distinct rows, as a scalar subquery column."""
    return dedup_report(df, subset).select("dropped").scalar()


# --------------------------------------------------------------- filter ----

FILTER_OPERATORS = ("eq", "ne", "gt", "lt", "gte", "lte", "notnull", "isnull", "isin", "strip_eq")


def _text_of(column: str, dt: T.DataType) -> Column:
    return strip(F.col(column).cast("string"))


def filter_predicate(df: DataFrame, column: str, op: str, value=None) -> Column:
    """Boolean Column for the filter semantics of the repair contract.

    Comparisons never convert between text and numbers: ``eq`` with a
    literal of another family keeps no row, ``ne`` keeps all, ordering
    operators raise.  NaN never satisfies an ordering comparison, and NULL
    rows survive ``ne``.
    """
    _require(df, column)
    dt = field_type(df, column)
    c = F.col(column)
    cf, vf = family(dt), value_family(value)
    comparable = (cf == vf) or (cf == "time" and vf == "text") or (cf == "bool" and vf == "number")
    not_nan = ~F.isnan(c) if is_float(dt) else F.lit(True)
    miss = is_missing(column, dt)

    if cf == "bool" and vf == "number":
        c, lit = c.cast("double"), F.lit(float(value))  # true is 1, false is 0
    elif cf == "time" and vf == "text":
        lit = F.lit(value).try_cast(dt)  # a text that is no time equals nothing
    else:
        lit = F.lit(value)
    if op == "eq":
        if value is None or not comparable:
            return F.lit(False)
        return F.coalesce((c == lit) & not_nan, F.lit(False)) if lit is not None else F.lit(False)
    if op == "ne":
        if value is None or not comparable:
            return F.lit(True)
        return lit.isNull() | ~c.eqNullSafe(lit) | (F.isnan(c) if is_float(dt) else F.lit(False))
    if op in ("gt", "lt", "gte", "lte"):
        if value is None or not comparable:
            raise TypeError(f"cannot compare {column!r} ({dt.simpleString()}) with {value!r}")
        cmp = {"gt": c > lit, "lt": c < lit, "gte": c >= lit, "lte": c <= lit}[op]
        return F.coalesce(cmp & not_nan, F.lit(False))
    if op == "notnull":
        return ~miss
    if op == "isnull":
        return miss
    if op in ("isin", "strip_eq"):
        vals = value if (op == "isin" and isinstance(value, (list, tuple, set))) else [value]
        words = [v for v in vals if isinstance(v, str)] if op == "isin" else [str(value)]
        null_word = "nan" if is_float(dt) else "None"
        hit_null = F.lit(null_word in words)
        if not words:
            return F.lit(False)
        txt = _text_of(column, dt)
        return F.when(miss, hit_null).otherwise(F.coalesce(txt.isin(words), F.lit(False)))
    raise ValueError(f"unknown filter operator {op!r}; known: {FILTER_OPERATORS}")


def filter_rows(df: DataFrame, column: str, op: str, value=None) -> DataFrame:
    """Keep the rows where ``column op value`` holds.  For ``isin`` the
    value may be a DataFrame (first column = allowed text values): the test
    becomes a ``left_semi`` join on the stripped text, broadcast by AQE
    only when the value set is measured small."""
    if op == "isin" and isinstance(value, DataFrame):
        _require(df, column)
        allowed = value.select(F.col(value.columns[0]).cast("string").alias("__allowed")) \
            .filter(F.col("__allowed").isNotNull()).distinct()
        keyed = df.withColumn("__txt", _text_of(column, field_type(df, column)))
        return keyed.join(allowed, keyed["__txt"] == allowed["__allowed"], "left_semi").drop("__txt")
    return df.filter(filter_predicate(df, column, op, value))


def filter_report(df: DataFrame, column: str, op: str, value=None) -> DataFrame:
    pred = filter_predicate(df, column, op, value)
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(pred).alias("rows_after")) \
        .withColumn("dropped", F.col("rows_before") - F.col("rows_after"))
