"""Object tracks, relations and mask passes derived from the `lineitem` table by integer arithmetic.

They stand for annotation files where there are none, so that every operator can run at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackset.config import Merge, Settings

#: Caps that bite on these tracks, which are denser and shorter than real ones.
SETTINGS = Settings(max_objects=6, max_anchors=8, max_gap=8, merge=Merge(score=0.95))
FRAMES = 125


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    return lines.select(
        F.col("l_suppkey").alias("vid"),
        F.floor(days / 20).alias("fid"),
        F.col("l_linenumber").cast("long").alias("tid"),
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        F.col("l_quantity").cast("long").alias("qty"),
        "l_returnflag",
        "l_linestatus",
        F.struct("l_orderkey", "l_partkey", "l_extendedprice").alias("ord"),
        F.round(F.col("l_tax") * 100).cast("long").alias("tax"),
        F.round(F.col("l_discount") * 100).cast("long").alias("discount"),
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vid, frame_count, width, height: videos differ in length and size."""
    vid = F.col("vid")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_suppkey").alias("vid")).distinct().select(
        "vid", (FRAMES + vid % 7).alias("frame_count"), width_of(vid).alias("width"), height_of(vid).alias("height")
    )


def width_of(vid: Column) -> Column:
    return 64 + 8 * (vid % 3)


def height_of(vid: Column) -> Column:
    return 48 + 4 * (vid % 2)


def raw_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vid, fid, tid, box, generated, tracker, ord (place in its frame's list), and seeds for masks and scores."""
    part_seventh = F.floor(F.col("l_partkey") / 7)
    human = F.col("l_returnflag") == "R"
    xmin, ymin = F.col("l_partkey") % 24, F.col("l_orderkey") % 18
    return _lines(spark, sf_dir).select(
        "vid",
        "fid",
        "tid",
        xmin.alias("xmin"),
        ymin.alias("ymin"),
        (xmin + 8 + F.col("qty") % 24).alias("xmax"),
        (ymin + 6 + part_seventh % 18).alias("ymax"),
        F.when(human, 0).otherwise(1).cast("long").alias("generated"),
        F.when(human, "none").otherwise(F.col("l_linestatus")).alias("tracker"),
        "ord",
        ((F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("fid")) % 20).alias("h"),
        (F.lit(90) + F.col("l_partkey") % 10).alias("fscore"),
        (F.lit(90) + F.col("l_orderkey") % 10).alias("bscore"),
        ((F.col("l_partkey") * 13 + F.col("l_orderkey")) % 100).alias("blur"),
    )


def split_of(vid: Column) -> Column:
    return F.when(vid % 10 < 8, "train").when(vid % 10 == 8, "val").otherwise("test")


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vid, split, s, p, o, begin, end, ord, cats (array of tid, category): one row for each relation record."""
    s, o = F.col("tid"), (F.col("tid") - 1 + F.col("l_partkey") % 3) % 7 + 1
    named = lambda t: F.concat(F.lit("cat"), ((t + F.col("l_orderkey")) % 4).cast("string"), F.lit("/sub"))
    return (
        _lines(spark, sf_dir)
        .where("qty <= 1")
        .select(
            "vid",
            split_of(F.col("vid")).alias("split"),
            s.alias("s"),
            F.concat("l_returnflag", "l_linestatus").alias("p"),
            o.alias("o"),
            F.col("tax").alias("begin"),
            (F.lit(124) - F.col("discount")).alias("end"),
            "ord",
            # the last entry names an object that takes no part in any relation
            F.array(*(F.struct(t.alias("tid"), named(t).alias("category")) for t in (s, o, F.lit(8).cast("long") + s % 3))).alias("cats"),
        )
    )


def columns_of(x0: Column, y0: Column, x1: Column, y1: Column, height: Column) -> Column:
    """A rectangle as half-open intervals over the column-major pixel index, one for each column."""
    return F.transform(
        F.sequence(x0, x1), lambda x: F.struct((x * height + y0).alias("s"), (x * height + y1 + 1).alias("e"))
    )


def mask_seeds(boxes: DataFrame) -> DataFrame:
    """What both passes' masks and scores of a box are made from; small, so that it is this that is joined."""
    return boxes.select("vid", "fid", "tid", "xmin", "ymin", "xmax", "ymax", "height", "h", "fscore", "bscore")


def mask_passes(seeds: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Of rows with seeds: vid, fid, tid, fwd, bwd (intervals, null where the pass has no mask), fconf, bconf, and the
    seeds named in `also`."""
    h, height = F.col("h"), F.col("height")
    x0, y0, x1, y1 = (F.col(c) for c in ("xmin", "ymin", "xmax", "ymax"))
    corner = columns_of(x0, y0, x0 + 1, y0 + 2, height)
    thin = columns_of(x0, y0, x0, y1, height)
    moved = (x0 + 25) % 32
    fwd = (
        F.when(h.isNull() | h.isin(0, 4, 9), F.lit(None))
        .when(h.isin(2, 5, 8), corner)
        .when(h == 7, thin)
        .otherwise(columns_of(x0, y0, x1, y1, height))
    )
    bwd = (
        F.when(h.isNull() | h.isin(1, 4, 8), F.lit(None))
        .when(h.isin(3, 5, 9), corner)
        .when(h == 6, columns_of(moved, y0, moved + x1 - x0, y1, height))
        .otherwise(columns_of(x0 + 1, y0, x1 + 1, y1, height))
    )
    return seeds.select(
        "vid",
        "fid",
        "tid",
        fwd.alias("fwd"),
        bwd.alias("bwd"),
        F.when(~h.isin(0, 4, 9), F.col("fscore") / F.lit(100.0)).alias("fconf"),
        F.when(~h.isin(1, 4, 8), F.col("bscore") / F.lit(100.0)).alias("bconf"),
        *also,
    )
