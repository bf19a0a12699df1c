"""Writing records, tables, the ledger and manifests so that readers never see half of them, and never lose what was there
before the new is in place."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, staged: str, path: str) -> None:
    """Put `staged` in the place of `path`: the old is moved aside, the new moved in, and only then the old deleted. If the
    new cannot be moved in, the old comes back; what has been staged is left where it is."""
    target, fs = _fs(spark, path)
    aside = _fs(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}")[0]
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {path} aside; the new is in {staged}")
    if not fs.rename(_fs(spark, staged)[0], target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot rename {staged} to {path}")
    if had:
        fs.delete(aside, True)


def publish(df: DataFrame, path: str, form: str = "parquet", **options) -> None:
    """Write beside `path` and swap once all is written; a failed write leaves nothing behind."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.part-{uuid.uuid4().hex[:8]}"
    try:
        df.write.format(form).options(**options).save(staged)
    except Exception:
        where, fs = _fs(spark, staged)
        fs.delete(where, True)
        raise
    _swap(spark, staged, path)


def parquet(df: DataFrame, path: str) -> None:
    publish(df, path, "parquet", compression="zstd")


def json_lines(df: DataFrame, path: str) -> int:
    """One folder of JSON lines for each video, nulls written. Only the folders of the videos in `df` are replaced, each at
    once when all of them are written. The number of rows."""
    spark, staged = df.sparkSession, f"{path.rstrip('/')}.part-{uuid.uuid4().hex[:8]}"
    where, fs = _fs(spark, staged)
    try:
        df.write.option("ignoreNullFields", "false").partitionBy("vid").json(staged)
        n = spark.read.text(staged, recursiveFileLookup=True).count() if fs.exists(where) and len(fs.listStatus(where)) > 1 else 0
        fs.mkdirs(_fs(spark, path)[0])
        for status in fs.listStatus(where):  # a folder for each video
            name = status.getPath().getName()
            if name.startswith("vid="):
                _swap(spark, f"{staged}/{name}", f"{path.rstrip('/')}/{name}")
        return n
    finally:
        fs.delete(where, True)


def csv(df: DataFrame, path: str) -> None:
    """A small table (a row for each unit) as one file with a header; nulls are empty."""
    publish(df.coalesce(1), path, "csv", header="true", nullValue="", emptyValue="")


def manifest(spark: SparkSession, path: str, facts: dict) -> None:
    """One JSON document with sorted keys, swapped in when it is complete."""
    text, staged = json.dumps(facts, sort_keys=True, indent=1), f"{path}.part-{uuid.uuid4().hex[:8]}"
    target, fs = _fs(spark, staged)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    _swap(spark, staged, path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))  # one document


def payload(anchors: Column, ref: Column, policy: Column, direction: Column, extras: dict[str, Column] | None = None) -> Column:
    """A prompt payload as JSON text: keys in order, nulls written, forward runs without a direction."""
    fields = {"anchor_fids": anchors, "anchor_policy": policy, "ref_anchor_fid": ref} | (extras or {})

    def text(more: dict[str, Column]) -> Column:
        every = fields | more
        return F.to_json(F.struct(*(every[k].alias(k) for k in sorted(every))), {"ignoreNullFields": "false"})

    return F.when(direction == "forward", text({})).otherwise(text({"direction": direction}))
