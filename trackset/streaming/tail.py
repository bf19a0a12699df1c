"""Following a folder of records while workers still write it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """Records as they arrive, each (vid, tid, fid) once. State ends with `arrived`, a day after the latest."""
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withWatermark("arrived", "1 day").dropDuplicatesWithinWatermark(["vid", "tid", "fid"])


def progress(records: DataFrame) -> DataFrame:
    """vid, masks, refusals so far."""
    return records.groupBy("vid").agg(
        F.count_if(F.col("reason").isNull()).alias("masks"), F.count_if(F.col("reason").isNotNull()).alias("refusals")
    )


def export(records: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Add what has arrived to the masks and refusals below `out`, then end; run it again for the rest."""

    def both(batch: DataFrame, n: int) -> None:
        batch.persist()
        for name, kept in (("masks", "reason IS NULL"), ("refusals", "reason IS NOT NULL")):
            # named by batch, so that a repeated batch replaces itself
            batch.where(kept).write.mode("overwrite").parquet(f"{out}/{name}/batch={n}")
        batch.unpersist()

    return records.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
