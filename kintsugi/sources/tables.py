"""Named table sets read from Parquet, and the table sink."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables(dict):
    """``dict[str, DataFrame]`` that reads a table on first use."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark, self.root = spark, root

    def __missing__(self, name: str) -> DataFrame:
        path = os.path.join(self.root, f"{name}.parquet")
        df = self.spark.read.parquet(path)
        self[name] = df
        return df


def load_tables(spark: SparkSession, root: str, views: bool = False) -> Tables:
    """Lazy table set over ``{root}/{name}.parquet``; optionally temp views."""
    tables = Tables(spark, root)
    if views:
        for name in TABLE_NAMES:
            if os.path.exists(os.path.join(root, f"{name}.parquet")):
                tables[name].createOrReplaceTempView(name)
    return tables


def save_table(tables: dict, name: str, df: DataFrame, *, overwrite: bool = False,
               path: str | None = None, fmt: str = "parquet") -> dict:
    """Store a result under ``name``; refuses to replace a table silently.

    Returns a new dict (the input is not modified).  With ``path`` the
    result is also written out (``mode=overwrite`` only when asked)."""
    if name in tables and not overwrite:
        raise ValueError(f"table {name!r} exists; pass overwrite=True to replace it")
    if path is not None:
        df.write.mode("overwrite" if overwrite else "errorifexists").format(fmt).save(path)
    out = dict(tables)
    out[name] = df
    return out
