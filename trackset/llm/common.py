"""Shared helpers: input tables, the shared scratch folder, and written intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes that are none of these (`[^\x20\x09-\x0D]+`), which is how bytes.split() splits.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of an Arrow batch handed to Python. Texts are large, so the batches are small.
ARROW_ROWS = 128

_own_scratch: str | None = None
#: What has been written since each open `freed_after` began.
_scopes: list[list[str]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, run: Callable[[Iterator], Iterator], schema: str, rows: int = ARROW_ROWS) -> DataFrame:
    """mapInArrow whose function sees batches of at most `rows` rows. The session's settings stay as they are: Spark
    bounds the bytes that it sends at once (spark.sql.execution.arrow.maxBytesPerBatch), and they are sliced here."""

    def small(batches):
        return run(batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))

    return df.mapInArrow(small, schema)


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local-mode session may go without it; a cluster must name one.
    """
    global _own_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/trackset"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if _own_scratch is None:
        _own_scratch = tempfile.mkdtemp(prefix="trackset-")
        atexit.register(shutil.rmtree, _own_scratch, True)
    return _own_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes[-1:]:
        scope.append(path)
    return path


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Shuffle files of the actions inside go as soon as each action ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffle_files_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._trackset_path = path
    return out


@contextmanager
def freed_after(spark: SparkSession):
    """Scratch tables that are written inside go at the end, but for those in the list that the block is given."""
    kept: list[DataFrame] = []
    _scopes.append([])
    try:
        yield kept
    finally:
        spared = {getattr(df, "_trackset_path", None) for df in kept}
        written = _scopes.pop()
        for path in written:
            if path not in spared:
                _delete(spark, path)
        if _scopes:
            _scopes[-1].extend(p for p in written if p in spared)


def free_scratch(spark: SparkSession) -> None:
    """Delete all that operators have written below the scratch folder; results that have not been written go with it."""
    _delete(spark, scratch(spark))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*frames: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_trackset_path", None)
        if path:
            _delete(df.sparkSession, path)


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct text: cls (16-byte digest), first_id (smallest id, null last), text.

    Copies are merged before the shuffle as well as after it, so a hot text costs one row per task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), text_or_empty(text_col).alias("_text"))
    return rows.groupBy(text_class("_text").alias("cls")).agg(
        F.min("_id").alias("first_id"), F.first("_text").alias("text")
    )


def text_class(col: str):
    """A 16-byte digest that stands for a whole text."""
    return F.unhex(F.substring(F.sha2(F.col(col).cast("binary"), 256), 1, 32))


def text_class_of(text_col: str):
    """The same for a column that may hold nulls, which count as empty."""
    return F.unhex(F.substring(F.sha2(text_or_empty(text_col).cast("binary"), 256), 1, 32))
