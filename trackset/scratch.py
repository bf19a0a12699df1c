"""Intermediate tables that several branches of a query read: written once below spark.checkpoint.dir, and read back.

A plan that is read by ten branches is computed ten times if it stays lazy. Written, it costs one pass and cuts the
lineage, so that a lost executor costs a task.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: str | None = None


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a session in local mode may go without spark.checkpoint.dir."""
    global _own
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/tracks"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _own is None:
        _own = tempfile.mkdtemp(prefix="tracks-")
        atexit.register(shutil.rmtree, _own, True)
    return _own


def written(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(spark: SparkSession) -> None:
    """Delete all tables that have been written here; what still reads them fails."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder(spark))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
