"""Profiles that are kept up to date from changed parts only.

Each part of a versioned table gets a state once: its distinct rows as two 64-bit hashes
with their number and their missing columns (a bit each).  States of different parts merge
by adding numbers per hash pair, so the profile of any version, with its exact duplicate
count across parts, comes from the states: after an append only the new part's rows are
read, after a rollback none.  A state is narrow (hashes, a number and one long per 63
columns) and never larger than its part's distinct rows.

Defined results: as ``profile.table_profile`` (NULL and NaN are missing, NULLs are equal in
duplicates, two different rows count as equal with a chance below rows^2 / 2^128); an empty
version has 0 rows and a row per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kintsugi.functions.nulls import is_missing
from kintsugi.functions.types import dtype_name
from kintsugi.operators.repair import row_hash
from kintsugi.sources.versions import VersionedTable

BITS = 63


def _masks(df: DataFrame) -> list[Column]:
    """The missing columns of a row, 63 to a long."""
    out = []
    for i in range(0, len(df.columns), BITS):
        bits = [F.when(is_missing(c, df.schema[c].dataType), F.lit(1 << j)).otherwise(F.lit(0)).cast("long")
                for j, c in enumerate(df.columns[i:i + BITS])]
        mask = bits[0]
        for b in bits[1:]:
            mask = mask.bitwiseOR(b)
        out.append(mask.alias(f"m{i // BITS}"))
    return out


def part_state(df: DataFrame) -> DataFrame:
    """(h1, h2, n, m0, ...): the distinct rows of ``df``; equal rows miss the same columns."""
    masks = _masks(df)
    rows = df.select(row_hash(df, df.columns).alias("h1"), row_hash(df, df.columns, "second").alias("h2"), *masks)
    return rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), *[F.max(f"m{i}").alias(f"m{i}") for i in range(len(masks))])


def merge(states: DataFrame) -> DataFrame:
    """One state of several."""
    masks = [c for c in states.columns if c not in ("h1", "h2", "n")]
    return states.groupBy("h1", "h2").agg(F.sum("n").alias("n"), *[F.max(m).alias(m) for m in masks])


def profile_of(state: DataFrame, schema, table: str) -> DataFrame:
    """The columns of ``profile.table_profile`` from a merged state."""
    names = schema.names
    missing = [F.coalesce(F.sum(F.when(F.getbit(f"m{i // BITS}", F.lit(i % BITS)) == 1, F.col("n"))), F.lit(0)).cast("long").alias(f"__n{i}")
               for i in range(len(names))]
    facts = state.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"), *missing)
    per_col = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(dtype_name(schema[c].dataType)).alias("dtype"),
                                 F.col(f"__n{i}").alias("nulls")) for i, c in enumerate(names)])
    return facts.select(F.lit(table).alias("table_name"), "rows", F.lit(len(names)).alias("n_columns"), "duplicates",
                        F.inline(per_col))


def refresh(table: VersionedTable, number: int | None = None) -> list[str]:
    """Stores the states that a version's parts still lack; returns those parts."""
    version, fs = table.version(number), table._fs()
    lacking = [p for p in version.parts if not fs.exists(table._hadoop(f"profile/{p}/_SUCCESS"))]
    for part in lacking:
        part_state(table.read_parts(version, [part])).write.mode("overwrite").parquet(f"{table.path}/profile/{part}")
    return lacking


def table_profile(table: VersionedTable, name: str, number: int | None = None) -> DataFrame:
    """The profile of a version; reads rows only of parts that have no state yet."""
    refresh(table, number)
    version = table.version(number)
    states = table.spark.read.parquet(*[f"{table.path}/profile/{p}" for p in version.parts])
    return profile_of(merge(states), version.schema, name)
