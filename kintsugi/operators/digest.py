"""Keyed comparison that moves only rows which can differ.

Both sides are cut into leaves by a hash of the key, and each leaf gets a digest: its number
of rows and sums of two 64-bit row hashes, added up in the tasks before anything is
shuffled.  Where the digests of a leaf agree, both sides hold the same rows, and if the
trusted side's keys are distinct there, every row meets its own copy: its cells are judged
on the trusted row alone.  Only rows of the other leaves go through
``compare.compare_keyed``, whose result is additive over leaves.

The trusted copy's side (``trusted_leaves``) is computed and stored once and serves every
later comparison; that is also where its keys are grouped.  The shuffled bytes of a
comparison are the digests (at most ``leaves`` rows a task) plus the rows of the leaves that
differ.  ``leaves`` should exceed the number of differing keys by some factor; the set of
open leaves is broadcast, eight bytes each, at most ``MAX_LEAVES``.

Defined results: those of ``compare_keyed`` for nulls, NaN, repeated and missing keys and
empty tables.  Columns of different types on both sides make all their rows differ, so
nothing is saved then.  Two different leaves count as equal with a chance below
leaves / 2^64.  Extra columns are ignored unless ``order_by`` is left out and the live
table has repeated keys: then they decide, as there, which row is picked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kintsugi.functions.types import family, is_float
from kintsugi.operators.compare import _common, cell_match, compare_keyed, null_safe_key
from kintsugi.operators.joins import require_same_family
from kintsugi.operators.repair import row_hash
from kintsugi.session import materialize

LEAVES = 1 << 16
MAX_LEAVES = 1 << 20
_LOW = (1 << 32) - 1


@dataclass(frozen=True)
class TrustedLeaves:
    """The stored digests of a trusted copy: (leaf, rows, s0..s3, keys, cells)."""
    frame: DataFrame
    key: str
    columns: tuple[str, ...]
    leaves: int
    key_type: T.DataType


def _key_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which keys of both sides are hashed alike where a join calls them equal."""
    if a == b:
        return a
    if family(a) == family(b) == "number":
        if is_float(a) or is_float(b):
            return T.DoubleType()
        if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            return T.LongType()
    elif family(a) == family(b) == "text":
        return T.StringType()
    raise ValueError(f"keys of types {a.simpleString()} and {b.simpleString()} have no common hash; cast one side first")


def _leaf(df: DataFrame, key: str, key_type: T.DataType, leaves: int) -> Column:
    value, missing = null_safe_key(F.col(key).cast(key_type), key_type)
    return F.pmod(F.xxhash64(value, missing), F.lit(leaves)).alias("leaf")


def _sums(df: DataFrame, columns: list[str]) -> list[Column]:
    """The halves of two row hashes, salted with the types; sums of halves do not overflow below 2^31 rows a leaf."""
    out, types = [], ",".join(df.schema[c].dataType.simpleString() for c in columns)
    for i in range(2):
        h = row_hash(df, columns, f"{i}:{types}")
        out += [F.shiftright(h, 32).alias(f"s{2 * i}"), h.bitwiseAND(F.lit(_LOW)).alias(f"s{2 * i + 1}")]
    return out


_DIGEST = [f"s{i}" for i in range(4)]


def _digests(df: DataFrame, key: str, columns: list[str], key_type: T.DataType, leaves: int) -> DataFrame:
    rows = df.select(_leaf(df, key, key_type, leaves), *_sums(df, columns))
    return rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(s).alias(s) for s in _DIGEST])


def trusted_leaves(trusted: DataFrame, key: str, columns: list[str] | None = None, leaves: int = LEAVES,
                   live_key_type: T.DataType | None = None, rtol: float = 0.01, atol: float = 0.01) -> TrustedLeaves:
    """Digests of the trusted copy, its distinct keys per leaf and the cells that match themselves, stored once.

    ``columns`` are the compared ones and ``live_key_type`` the type of the live table's key where it is another."""
    if not 1 <= leaves <= MAX_LEAVES:
        raise ValueError(f"leaves must be between 1 and {MAX_LEAVES}")
    cols = [c for c in trusted.columns if columns is None or c in columns]
    key_type = _key_type(trusted.schema[key].dataType, live_key_type or trusted.schema[key].dataType)
    value, missing = null_safe_key(F.col(key).cast(key_type), key_type)
    # two equal columns under two names: a cell is compared with itself, by the rules for its type
    own = sum((cell_match(c, trusted.schema[c].dataType, c, trusted.schema[c].dataType, rtol, atol).cast("long") for c in cols), F.lit(0))
    rows = trusted.select(_leaf(trusted, key, key_type, leaves), value.alias("k"), missing.alias("kn"), own.cast("long").alias("own"),
                          *_sums(trusted, list(dict.fromkeys([key, *cols]))))
    by_key = rows.groupBy("leaf", "k", "kn").agg(F.count(F.lit(1)).alias("rows"), F.sum("own").alias("own"), *[F.sum(s).alias(s) for s in _DIGEST])
    frame = by_key.groupBy("leaf").agg(F.sum("rows").alias("rows"), *[F.sum(s).alias(s) for s in _DIGEST],
                                       F.count(F.lit(1)).alias("keys"), F.sum("own").alias("cells"))
    return TrustedLeaves(materialize(frame), key, tuple(cols), leaves, key_type)


def open_leaves(live: DataFrame, digests: TrustedLeaves) -> DataFrame:
    """(leaf, open, rows, cells): per leaf of either side whether its rows have to be compared; closed leaves with
    their rows and matching cells."""
    columns = list(dict.fromkeys([digests.key, *digests.columns]))
    a = _digests(live, digests.key, columns, digests.key_type, digests.leaves)
    b = digests.frame
    same = [a[c].eqNullSafe(b[c]) for c in ("rows", *_DIGEST)]
    agree = same[0]
    for s in same[1:]:
        agree = agree & s
    return a.join(b, a["leaf"] == b["leaf"], "full").select(
        F.coalesce(a["leaf"], b["leaf"]).alias("leaf"), (~(agree & (b["keys"] == b["rows"]))).alias("open"), b["rows"], b["cells"]) \
        .withColumn("open", F.coalesce("open", F.lit(True)))


def compare_by_digest(live: DataFrame, trusted: DataFrame, digests: TrustedLeaves, order_by: list[str] | None = None,
                      rtol: float = 0.01, atol: float = 0.01) -> DataFrame:
    """The row of ``compare.compare_keyed`` (``digests`` must come from ``trusted`` and the same tolerances)."""
    key = digests.key
    if key not in live.columns:
        raise KeyError(f"key {key!r} must exist on both sides")
    require_same_family(live, trusted, key)
    if _key_type(trusted.schema[key].dataType, live.schema[key].dataType) != digests.key_type:
        raise ValueError("the digests were made for another type of the live key (live_key_type)")
    cols = _common(live, trusted, list(digests.columns))
    if set(cols) != set(digests.columns):
        raise ValueError(f"the live table lacks compared columns {sorted(set(digests.columns) - set(cols))}")
    state = materialize(open_leaves(live, digests))
    wanted = F.broadcast(state.where("open").select(F.col("leaf").alias("__open")))  # at most MAX_LEAVES longs

    def touched(df: DataFrame) -> DataFrame:
        return df.join(wanted, _leaf(df, key, digests.key_type, digests.leaves) == F.col("__open"), "left_semi")

    moved = compare_keyed(touched(live), touched(trusted), key, list(cols), order_by, rtol, atol)
    names = ["trusted_rows", "live_rows", "matched_cells", "missing_keys", "extra_rows", "duplicate_live_keys"]
    zero = F.lit(0).cast("long")
    closed = state.where("not open").agg(F.coalesce(F.sum("rows"), zero).alias("rows"), F.coalesce(F.sum("cells"), zero).alias("cells")) \
        .select(F.col("rows").alias("trusted_rows"), F.col("rows").alias("live_rows"), F.col("cells").alias("matched_cells"),
                *[zero.alias(c) for c in names[3:]])
    n = len(cols)
    both = moved.select(*names).unionByName(closed).agg(*[F.sum(c).cast("long").alias(c) for c in names])
    total = F.col("trusted_rows") * n
    return both.select("trusted_rows", "live_rows", F.lit(n).alias("compared_columns"), "matched_cells", total.cast("long").alias("total_cells"),
                       "missing_keys", "extra_rows", "duplicate_live_keys",
                       F.when(total > 0, F.round(F.col("matched_cells") / total, 4)).otherwise(F.lit(0.0)).alias("score"))
