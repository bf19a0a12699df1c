"""Operator 9: mixing sources to target weights by hash-threshold histograms, DataFrame operations only.

Sources in code point order, null last, weigh 3, 1, 2, repeating, and share SHARE times all words. No target passes
MOST times its source's size; what is over is shared again by weight until no target is above. Ascending by size per
weight, the sources that are capped come first, so one pass of running sums finds the level of the rest.

A source is taken whole as often as its target allows, and then the documents whose hash lies under a threshold once
more. Hashes fall into nested buckets: a histogram of words by source and leading bits finds the bucket in which the
remaining budget ends, only that bucket is counted again by the next bits, and so on. Documents are then kept by
comparing their hash with their source's threshold; nothing is sorted. The last bucket is taken if that comes nearer.

Defined results: null and empty texts have size 0, are taken as 0 words, and come as often as others of their hash; a source without words has target 0; rows
with equal ids share their fate; null ids share one hash; repeated rows each get a row; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Bits of a hash, and how many of them each histogram resolves: about a billion buckets of a source in the end.
HASH_BITS, LEVELS = 60, (10, 10, 10)


def id_hash(id_col: str = "doc_id") -> Column:
    """The leading 60 bits of the MD5 of the id as text."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def word_count(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(common.WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target of one row for each source (source, source_size)."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place - 1) % len(WEIGHTS) + 1).cast("double")
    ranked = sizes.withColumn("place", place).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", MOST * F.col("source_size").cast("double"))
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    total = SHARE * F.sum("source_size").over(everything).cast("double")
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    ranked = ranked.withColumn("level", level).withColumn("nth", F.row_number().over(rising))
    open_at = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))
    level = F.min(open_at).over(everything)["level"]  # of the first source that is not capped
    return ranked.select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"),
    )


def thresholds(sized: DataFrame) -> DataFrame:
    """source, source_size, target, passes, cut: of sized documents (source, size, h), a source is taken `passes`
    times, and once more where the leading bits of h are under `cut`."""
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.withColumn("passes", passes.cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    # what is under half a word is met by taking nothing more
    edge = goals.where("rest >= 0.5").select("source", "rest", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("bucket"))
    shift = HASH_BITS
    for bits in LEVELS:
        coarse, shift = shift, shift - bits
        inside = sized.alias("d").join(
            edge.alias("e"),
            F.col("d.source").eqNullSafe(F.col("e.source")) & (F.shiftright("d.h", coarse) == F.col("e.bucket")),
        )
        counted = inside.groupBy(
            F.col("d.source").alias("source"), F.shiftright("d.h", shift).alias("bucket"), "e.rest", "e.base"
        ).agg(F.sum("d.size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("upto", F.col("base") + F.sum("words").over(running))
        ends = counted.where("upto > rest AND upto - words <= rest")
        edge = ends.select("source", "rest", (F.col("upto") - F.col("words")).alias("base"), "bucket", "upto")
    nearer = (F.col("upto") - F.col("rest")) < (F.col("rest") - F.col("base"))
    cuts = edge.select(
        F.col("source").alias("of"), (F.col("bucket") + F.when(nearer, 1).otherwise(0)).alias("cut")
    )
    return goals.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "passes", F.coalesce("cut", F.lit(0).cast("long")).alias("cut")
    )


def copies(h: Column, passes: Column, cut: Column) -> Column:
    """How often a document is taken."""
    once_more = F.when(F.shiftright(h, HASH_BITS - sum(LEVELS)) < cut, 1).otherwise(0)
    return (passes + once_more).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, copies, taken of every row."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text_col).alias("size"),
        id_hash(id_col).alias("h"),
    )
    sized = common.materialise(sized, "sized")
    cuts = common.materialise(thresholds(sized), "thresholds")
    out = sized.alias("d").join(cuts.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    out = out.withColumn("copies", copies(F.col("h"), F.col("passes"), F.col("cut")))
    return out.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it."""
    sized = docs.select(
        F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), id_hash(id_col).alias("h")
    )
    cuts = common.materialise(thresholds(common.materialise(sized, "sized")), "thresholds")
    nested = docs.select(F.struct("*").alias("row"), id_hash(id_col).alias("h"))
    joined = nested.join(cuts, F.col(f"row.{source_col}").cast("string").eqNullSafe(F.col("source")))
    times = copies(F.col("h"), F.col("passes"), F.col("cut"))
    taken = joined.select("row", times.alias("times")).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
