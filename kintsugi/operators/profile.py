"""Profiling: fused per-table statistics, column inspection, previews.

One aggregate per table computes the row count and the missing count of
every column together; duplicates need one grouping of whole rows.  Both
are pre-aggregated map-side, so skewed values cost nothing extra.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from kintsugi.functions.nulls import is_missing, nullify_nan
from kintsugi.functions.types import dtype_name, family, field_type, is_float


def _missing_aggs(df: DataFrame) -> list[Column]:
    return [F.count_if(is_missing(c, df.schema[c].dataType)).alias(f"__n_{i}")
            for i, c in enumerate(df.columns)]


def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """``(column_name, nulls)`` per column; by default only columns with any."""
    if not df.columns:
        raise ValueError("table has no columns")
    agg = df.agg(*_missing_aggs(df))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n_{i}").alias("nulls"))
                      for i, c in enumerate(df.columns)])
    out = agg.select(F.inline(pairs))
    return out.filter(F.col("nulls") > 0) if only_missing else out


def table_profile(df: DataFrame, table: str, materialize: bool = False) -> DataFrame:
    """One row per column: table, column, dtype, rows, nulls, plus the
    table-level ``n_columns`` and ``duplicates`` (rows minus distinct rows).

    Row count, missing counts and the duplicate count come from one fused
    pass over the input (``repair.row_facts``)."""
    from kintsugi.operators.repair import row_facts
    if materialize:
        from kintsugi.session import materialize as _mat
        df = _mat(df)
    facts = row_facts(df, null_columns=df.columns)
    per_col = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.lit(dtype_name(df.schema[c].dataType)).alias("dtype"),
                                 F.col(f"__n{i}").alias("nulls"))
                        for i, c in enumerate(df.columns)])
    return facts.select(F.lit(table).alias("table_name"), "rows",
                        F.lit(len(df.columns)).alias("n_columns"), "duplicates",
                        F.inline(per_col))


def profile_tables(tables: dict[str, DataFrame], materialize: bool = False) -> DataFrame:
    frames = [table_profile(df, name, materialize) for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def inspect_column(df: DataFrame, column: str, order_by: list[str] | None = None,
                   n_samples: int = 5, exact_distinct: bool = True) -> DataFrame:
    """dtype, null count, distinct non-null count, first ``n_samples``
    non-null values (in ``order_by`` order), and min/max/mean for numbers."""
    dt = field_type(df, column)
    miss = is_missing(column, dt)
    val = nullify_nan(column, dt)
    distinct = F.count_distinct(val) if exact_distinct else F.approx_count_distinct(val)
    present = df.filter(~miss)
    if order_by:
        # top-n by the order, then an explicit sort of the n collected
        # values: collect_list itself promises no order
        first = present.orderBy(*order_by).limit(n_samples)
        sample = first.agg(F.array_sort(F.collect_list(F.struct(
            *[F.col(o) for o in order_by], F.col(column).cast("string").alias("__v"))))
            .alias("s")).select(F.transform("s", lambda x: x["__v"])).scalar()
    else:
        sample = present.limit(n_samples).agg(
            F.collect_list(F.col(column).cast("string")).alias("s")).select("s").scalar()
    aggs = [F.count_if(miss).alias("null_count"), distinct.alias("unique_count")]
    numeric = family(dt) in ("number", "bool")
    if numeric:
        num = val.cast("double")
        aggs += [F.min(num).alias("min"), F.max(num).alias("max"), F.avg(num).alias("mean")]
    else:
        aggs += [F.lit(None).cast("double").alias(x) for x in ("min", "max", "mean")]
    return df.agg(*aggs).select(F.lit(column).alias("column_name"),
                                F.lit(dtype_name(dt)).alias("dtype"),
                                "null_count", "unique_count", sample.alias("sample_values"),
                                "min", "max", "mean")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in ``order_by`` order, JSON-safe: timestamps as
    ``yyyy-MM-dd`` text, NaN and infinities as NULL; plus the row as JSON."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif is_float(f.dataType):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    head = df.orderBy(*order_by).limit(n).select(*cols)
    return head.withColumn("row_json", F.to_json(F.struct(*[F.col(f) for f in df.columns])))


def health_report(tables: dict[str, DataFrame], schema: dict[str, dict[str, str]] | None = None
                  ) -> DataFrame:
    """One row per table: rows, column count, columns, ``col:dtype`` list,
    ``col=n`` missing counts of every column, duplicates, and the contract
    type mismatches of present columns (``col: expected=e, actual=a``).
    Each table costs one fused pass (``repair.row_facts``)."""
    from kintsugi.functions.types import dtype_matches
    from kintsugi.operators.repair import row_facts
    frames = []
    for name, df in tables.items():
        facts = row_facts(df, null_columns=df.columns)
        dts = {c: dtype_name(df.schema[c].dataType) for c in df.columns}
        mism = [f"{c}: expected={e}, actual={dts[c]}" for c, e in (schema or {}).get(name, {}).items()
                if c in df.columns and not dtype_matches(dts[c], e)]
        nulls = F.array(*[F.concat(F.lit(f"{c}="), F.col(f"__n{i}").cast("string"))
                          for i, c in enumerate(df.columns)])
        frames.append(facts.select(
            F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("n_columns"),
            F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
            F.array(*[F.lit(f"{c}:{dts[c]}") for c in df.columns]).alias("dtypes"),
            nulls.alias("null_counts"), "duplicates",
            F.array(*[F.lit(m) for m in mism]).cast("array<string>").alias("schema_issues")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
