"""Set operations and per-group tails."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from kintsugi.functions.text import strip
from kintsugi.operators.quantile import order_statistics
from kintsugi.operators.scan import ScanSpec, segmented_scan


def union_by_name(*frames: DataFrame, allow_missing: bool = False) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out


def invalid_values(df: DataFrame, column: str, valid: list[str] | DataFrame,
                   trim: bool = True) -> DataFrame:
    """Distinct (stripped) values of ``column`` outside ``valid``.

    A short literal list is a JVM ``isin``; a DataFrame of valid values is
    used through ``left_anti`` (broadcast only if Spark measures it small)."""
    v = strip(column) if trim else F.col(column)
    vals = df.select(v.alias(column)).filter(F.col(column).isNotNull()).distinct()
    if isinstance(valid, DataFrame):
        ref = valid.select(F.col(valid.columns[0]).alias("__v")).distinct()
        return vals.join(ref, vals[column] == ref["__v"], "left_anti")
    return vals.filter(~F.col(column).isin(list(valid)))


def last_n_per_group(df: DataFrame, group: list[str], order_by: list[str], n: int,
                     name: str = "pos_from_end") -> DataFrame:
    """The last ``n`` rows of each group in ``order_by`` order, numbered from the end (1 = last); ties come in the
    order of a hash of the row.

    Spark limits the groups before the shuffle (``WindowGroupLimit``, for n up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``): a task hands on at most n rows of each group, so a group that
    holds a third of all rows makes n rows per task."""
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order: list[Column] = [F.col(o).desc_nulls_last() for o in order_by] + [F.xxhash64(*hashable)]
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(name) <= n).withColumn(name, F.col(name).cast("long"))


def shuffle_rows(df: DataFrame, key: list[str], seed: int = 42) -> DataFrame:
    """Deterministic permutation: order by a seeded hash of ``key`` (a
    distributed range sort, reproducible across runs and retries)."""
    return df.orderBy(F.xxhash64(F.lit(seed), *[F.col(k) for k in key]), *key)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42,
                key: list[str] | None = None) -> DataFrame:
    """Seeded sample.  With ``key`` the choice is a hash threshold, so the
    same rows are chosen whatever the partitioning (and on recomputation)."""
    if key:
        # all 64 bits of the hash against the fraction's place in their range
        h = F.xxhash64(F.lit(seed), *[F.col(k) for k in key]).cast("decimal(20,0)")
        return df.filter(h < F.lit(Decimal(-(1 << 63)) + Decimal(fraction) * (1 << 64)).cast("decimal(38,6)"))
    return df.sample(fraction=fraction, seed=seed)


def sample_exact(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement (all, if there are fewer): those with the smallest md5 of seed and key.

    The choice depends on the keys alone, not on the partitioning.  The n-th smallest hash is found by rank search
    over 52 bits of it, one narrow column, so nothing is sorted and no row moves; only rows that share these bits with
    the n-th one (repeated keys, mostly) are numbered, in the order of hash, key and row, by a segmented scan."""
    if n < 0:
        raise ValueError("a sample has no negative size")
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    hashed = df.withColumn("__hash", F.md5(text)).withColumn("__place", F.conv(F.substring("__hash", 1, 13), 16, 10).cast("long"))
    total = df.count()
    if n >= total:
        return df
    if n == 0:
        return df.limit(0)
    place = F.col("__place")
    # 52 bits are exact in a double
    last = F.lit(int(order_statistics(hashed.select("__place"), "__place", [n - 1])[0]))
    seen = hashed.agg(F.count_if(place < last).alias("below"), F.count_if(place == last).alias("ties")).first()
    if seen.below + seen.ties == n:
        return hashed.where(place <= last).select(*df.columns)
    numbered = segmented_scan(hashed.where(place == last), ["__hash", *key], [ScanSpec("__number", "count")])
    return hashed.where(place < last).select(*df.columns) \
        .unionByName(numbered.where(F.col("__number") <= n - seen.below).select(*df.columns))
