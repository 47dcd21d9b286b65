"""Contract validation: issues and the schema / validity / row scores.

A contract names, per table, the expected columns with dtype names, the
expected row count after repair, and the initial row count (over-cleaning
guard).  Row counts may be ints or scalar-subquery Columns (for example the
row count of a clean table), so a contract can be derived from data.

Schema facts come from ``df.schema`` on the driver (no job); data facts come
from one fused aggregate per table plus one whole-row grouping for
duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kintsugi.functions.types import dtype_matches, dtype_name

# Issue message layouts.
MSG_NULLS = "'%s'.'%s' has %d null value(s)"
MSG_MISSING_COLUMN = "'%s' is missing expected column '%s'"
MSG_DTYPE = "'%s'.'%s' dtype mismatch: expected=%s, actual=%s"
MSG_DUPLICATES = "'%s' has %d duplicate row(s)"
MSG_OVERCLEAN = "WARNING: '%s' lost %d rows (%d%% of original) — possible over-filtering"
MSG_MISSING_TABLE = "'%s' is missing"

OVERCLEAN_SHARE = 0.75


@dataclass
class Contract:
    schema: dict[str, dict[str, str]]
    expected_rows: dict[str, int | Column] = field(default_factory=dict)
    initial_rows: dict[str, int | Column] = field(default_factory=dict)


def _session(tables: dict[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession if tables else SparkSession.active()


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def table_facts(df: DataFrame, name: str, contract: Contract) -> DataFrame:
    """One row: table_name, rows, duplicates, and per contract column that
    exists, its missing count (array ``nulls`` of (column_name, n)); one
    fused pass (``repair.row_facts``)."""
    from kintsugi.operators.repair import row_facts
    expected = contract.schema.get(name, {})
    present = [c for c in expected if c in df.columns]
    facts = row_facts(df, null_columns=present)
    nulls = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("n"))
                      for i, c in enumerate(present)]) if present else \
        F.array().cast("array<struct<column_name:string,n:bigint>>")
    return facts.select(F.lit(name).alias("table_name"), "rows", "duplicates",
                        nulls.alias("nulls"))


@dataclass(frozen=True)
class SchemaRow:
    """One column a contract asks for; ``actual`` is None where table or column is absent."""
    table: str
    column: str
    expected: str
    actual: str | None

    @property
    def fits(self) -> bool:
        return self.actual is not None and dtype_matches(self.actual, self.expected)


def schema_rows(tables: dict[str, DataFrame], contract: Contract) -> list[SchemaRow]:
    """Every (table, column) of the contract with its expected and actual dtype (schemas only)."""
    actual = {(t, f.name): dtype_name(f.dataType) for t, df in tables.items() for f in df.schema.fields}
    return [SchemaRow(t, c, expected, actual.get((t, c)))
            for t, columns in contract.schema.items() for c, expected in columns.items()]


def _issue(table, column, check, expected, actual, n, message, include) -> Column:
    return F.struct(F.lit(table).alias("table_name"), _as_str(column).alias("column_name"),
                    F.lit(check).alias("check_name"), _as_str(expected).alias("expected"),
                    _as_str(actual).alias("actual"), _as_long(n).alias("n"),
                    _as_str(message).alias("message"), _as_bool(include).alias("include"))


def _as_str(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast("string")


def _as_long(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(v)).cast("long")


def _as_bool(v) -> Column:
    return v if isinstance(v, Column) else F.lit(bool(v))


def issues(tables: dict[str, DataFrame], contract: Contract,
           report_missing_tables: bool = True) -> DataFrame:
    """``(table_name, column_name, check, expected, actual, n, message)``.

    Checks: ``nulls`` (contract columns that exist and hold missing values),
    ``missing_column``, ``dtype``, ``duplicates`` (any table), ``over_clean``
    (rows < 75% of the initial count) and, ours, ``missing_table``.
    """
    frames = []
    for name, df in tables.items():
        expected = contract.schema.get(name, {})
        facts = table_facts(df, name, contract)
        entries = []
        for i, (col, exp) in enumerate(expected.items()):
            if col in df.columns:
                n = F.col("nulls")[[c for c in expected if c in df.columns].index(col)]["n"]
                entries.append(_issue(name, col, "nulls", 0, n, n,
                                      F.format_string(MSG_NULLS, F.lit(name), F.lit(col), n), n > 0))
        for row in schema_rows({name: df}, Contract({name: expected})):
            if row.actual is None:
                entries.append(_issue(name, row.column, "missing_column", row.expected, None, None,
                                      MSG_MISSING_COLUMN % (name, row.column), True))
            elif not row.fits:
                entries.append(_issue(name, row.column, "dtype", row.expected, row.actual, None,
                                      MSG_DTYPE % (name, row.column, row.expected, row.actual), True))
        d = F.col("duplicates")
        entries.append(_issue(name, None, "duplicates", 0, d, d,
                              F.format_string(MSG_DUPLICATES, F.lit(name), d), d > 0))
        if name in contract.initial_rows:
            init = _lit(contract.initial_rows[name]).cast("long")
            rows = F.col("rows")
            lost = init - rows
            pct = F.round(lost * 100.0 / init).cast("long")
            entries.append(_issue(name, None, "over_clean", init, rows, lost,
                                  F.format_string(MSG_OVERCLEAN, F.lit(name), lost, pct),
                                  (init > 0) & (rows < init * OVERCLEAN_SHARE)))
        frames.append(facts.select(F.inline(F.array(*entries))))
    if report_missing_tables:
        absent = [t for t in contract.schema if t not in tables]
        if absent or not frames:  # constants: a literal frame, no table is read for them
            entries = [_issue(t, None, "missing_table", "present", "absent", None, MSG_MISSING_TABLE % t, True)
                       for t in absent] or [_issue("", None, "none", None, None, None, None, False)]
            frames.append(_session(tables).range(1).select(F.inline(F.array(*entries))))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.filter("include").drop("include")


def validate_table(tables: dict[str, DataFrame], contract: Contract, table: str) -> DataFrame:
    """The issues of one table; no other table is read."""
    own = replace(contract, schema={t: cols for t, cols in contract.schema.items() if t == table})
    if table not in tables and table not in own.schema:
        raise KeyError(f"{table!r} is neither a table nor in the contract")
    return issues({t: df for t, df in tables.items() if t == table}, own)


# ---------------------------------------------------------------- scores ----

def schema_score(tables: dict[str, DataFrame], contract: Contract) -> float:
    """Share of the contract's schema rows that fit; absent ones do not, and
    an empty contract is fulfilled (schemas only)."""
    fits = [row.fits for row in schema_rows(tables, contract)]
    return sum(fits) / len(fits) if fits else 1.0


def contract_scores(tables: dict[str, DataFrame], contract: Contract) -> DataFrame:
    """One row: schema_score, validity_score, row_integrity.

    The per-table facts (one fused aggregate + one duplicate count per
    table) are computed once, unioned, and both data scores come from one
    final aggregate over that small union.
    """
    live = [n for n in tables if n in contract.schema or n in contract.expected_rows]
    facts = None
    for name in live:
        f = table_facts(tables[name], name, contract)
        in_schema = name in contract.schema
        has_exp = name in contract.expected_rows
        exp = _lit(contract.expected_rows.get(name, 0)).cast("double")
        init = _lit(contract.initial_rows.get(name, contract.expected_rows.get(name, 0))).cast("double")
        rows = F.col("rows").cast("double")
        rscore = (F.when((init > 0) & (rows < init * OVERCLEAN_SHARE),
                         F.greatest(F.lit(0.0), F.lit(0.5) - (1 - rows / init)))
                   .when(exp == 0, F.when(rows == 0, 1.0).otherwise(0.5))
                   .otherwise(F.greatest(F.lit(0.0), 1 - F.abs(rows / exp - 1))))
        passed = F.aggregate(F.col("nulls"), F.lit(0), lambda acc, x: acc + F.when(x["n"] == 0, 1)
                             .otherwise(0)) + F.when(F.col("duplicates") == 0, 1).otherwise(0)
        f = f.select(F.when(F.lit(in_schema), passed).otherwise(0).alias("passed"),
                     F.when(F.lit(in_schema), F.size("nulls") + 1).otherwise(0).alias("total"),
                     F.when(F.lit(has_exp), rscore).alias("row_score"))
        facts = f if facts is None else facts.unionByName(f)
    if facts is None:  # nothing to check the contract against
        facts = _session(tables).range(0).select(F.lit(0).alias("passed"), F.lit(0).alias("total"),
                                                 F.lit(None).cast("double").alias("row_score"))
    n_expected = len(contract.expected_rows)
    nothing = 0.0 if contract.schema else 1.0  # tables that are asked for but absent earn nothing
    validity = F.when(F.sum("total") > 0, F.sum("passed") / F.sum("total")).otherwise(F.lit(nothing))
    row_int = (F.coalesce(F.sum("row_score"), F.lit(0.0)) / n_expected) if n_expected else F.lit(1.0)
    return facts.agg(F.lit(schema_score(tables, contract)).alias("schema_score"),
                     validity.cast("double").alias("validity_score"),
                     row_int.cast("double").alias("row_integrity"))


def schema_mismatches_exact(tables: dict[str, DataFrame], contract: Contract) -> list[tuple]:
    """(table, column, expected, actual) where names differ exactly; absent
    columns read ``MISSING`` (no type equivalence).  Driver only."""
    return [(r.table, r.column, r.expected, r.actual or "MISSING")
            for r in schema_rows(tables, contract) if r.actual != r.expected]
