"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours should carry.  AQE re-plans joins and
# splits skewed join partitions at run time; UTC keeps timestamp maths equal
# between Spark and the DuckDB oracle.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "kintsugi",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors must all reach it, so none is invented here, on any master:
    tests, the bench and the entry module set their own where it is unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a folder that all "
                "executors share (HDFS/S3/ABFS) before running ordered operators")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir() or configured
    return current


_WRITTEN: list[tuple[SparkSession, str, str | None]] = []


def scratch_path(spark: SparkSession) -> str:
    """A new folder's path in the shared folder, removed by ``release``."""
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path, None))
    return path


def materialize(df, layout: dict[str, str] | None = None):
    """Write ``df`` once as Parquet into the shared folder and read it back.

    For a derived table that several passes read (scan layouts, profiles, contract
    facts): its lineage runs once, a lost executor does not replay it, and later
    readers read only their columns.  ``layout`` holds options of the Parquet writer.
    ``release`` removes what was written."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.options(**(layout or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_bucketed(df, column: str, buckets: int):
    """As ``materialize``, as a table bucketed by ``column``: what later groups, windows or joins by it (and others)
    needs no shuffle."""
    spark = df.sparkSession
    name = f"kintsugi_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/table-{name}"
    _WRITTEN.append((spark, path, name))
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    return spark.table(name)


def release() -> None:
    """Delete the tables that ``materialize`` has written so far (run at exit too)."""
    while _WRITTEN:
        spark, path, name = _WRITTEN.pop()
        try:
            if name:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(target, True)
        except Exception:  # the JVM has gone; the folder's own lifetime ends the tables
            return


atexit.register(release)


def row_counts(*frames) -> list[int]:
    """Row counts of several DataFrames in one job (a union of one-row
    aggregates), for constants such as contract row counts."""
    from pyspark.sql import functions as F
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "n")
             for i, df in enumerate(frames)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    got = {r.i: r.n for r in u.collect()}
    return [int(got[i]) for i in range(len(frames))]
