"""Scratch tables under ``spark.checkpoint.dir``, the folder every executor shares: a lost executor never takes intermediate results with it."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Lets Spark remove the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder; only a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="voxloom-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def store(df: DataFrame, label: str) -> DataFrame:
    """Write df to a scratch table and read it back: this cuts the lineage.

    The files go when the session ends, or earlier through :func:`drop`; the
    shuffle files behind them go at once.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/voxloom-{label}-{uuid.uuid4().hex}"
    fs, p = _hadoop(spark, path)
    fs.deleteOnExit(p)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(df: DataFrame) -> None:
    """Remove a scratch table that nothing reads any more."""
    if path := getattr(df, "_scratch", None):
        fs, p = _hadoop(df.sparkSession, path)
        fs.delete(p, True)


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't use."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name
