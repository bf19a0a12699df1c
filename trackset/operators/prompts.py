"""Prompts: anchor boxes, negative clicks on contained objects, co-prompts, and the order they are sent in.

`boxes` are tracks with their `inners`: for each box the boxes of its frame that lie inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackset.functions import geometry

KEY = ["vid", "fid", "tid"]
#: Fixed value: most points of one prompt, the box's two corners included.
MOST_POINTS = 16


def contained_pairs(boxes: DataFrame) -> DataFrame:
    """vid, fid, outer, inner, generated (of the outer box): in each frame, the small boxes inside another object's box."""
    rows = boxes.select("vid", "fid", F.col("tid").alias("outer"), "generated", F.explode("inners").alias("i"))
    return rows.select("vid", "fid", "outer", F.col("i.tid").alias("inner"), "generated")


def negative_clicks(prompted: DataFrame, boxes: DataFrame) -> DataFrame:
    """vid, fid, tid, inner, x, y: a click at the centre of each object inside a prompted one ("it is not here")."""
    inside = boxes.where(F.size("inners") > 0).select(*KEY, "width", "height", F.explode("inners").alias("i"))
    own = inside.join(prompted.select(*KEY), KEY)
    x, y = F.col("i.x") / F.col("width").cast("double"), F.col("i.y") / F.col("height").cast("double")
    return own.select(*KEY, F.col("i.tid").alias("inner"), x.alias("x"), y.alias("y"))


def co_prompts(anchors: DataFrame, boxes: DataFrame) -> DataFrame:
    """vid, fid, tid, generated: containers to prompt in the frames where an object inside them is prompted.

    Objects take their turns in ascending order: a container that is added before its own turn passes the prompt on to
    its own containers, one that is added later does not. Frames are independent, so each is one fold over its pairs.
    """
    prompted = anchors.select("vid", F.col("tid").alias("outer")).distinct()
    first = anchors.groupBy("vid", "fid").agg(F.collect_set("tid").alias("given"))
    able = contained_pairs(boxes).join(prompted, ["vid", "outer"], "left_semi")
    turn = F.struct("inner", "outer", "generated")
    turns = able.groupBy("vid", "fid").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    pass_on = lambda held, t: F.when(
        F.array_contains(held, t["inner"]) & ~F.array_contains(held, t["outer"]), F.array_append(held, t["outer"])
    ).otherwise(held)
    rows = turns.join(first, ["vid", "fid"]).withColumn("held", F.aggregate("turns", F.col("given"), pass_on))
    new = lambda t: F.array_contains("held", t["outer"]) & ~F.array_contains("given", t["outer"])
    outer = lambda t: F.struct(t["outer"].alias("tid"), t["generated"].alias("generated"))
    added = F.array_distinct(F.transform(F.filter("turns", new), outer))
    return rows.select("vid", "fid", F.inline(added))


def prompts(anchors: DataFrame, boxes: DataFrame) -> DataFrame:
    """vid, tid, seq, fid, box: an object's prompts, the reference first and then by frame, in relative coordinates."""
    seq = F.row_number().over(Window.partitionBy("vid", "tid").orderBy(F.col("is_ref").desc(), "fid")).cast("long")
    rows = anchors.join(boxes.select(*KEY, *geometry.SIDES, "width", "height"), KEY)
    box = geometry.relative_box(F.col("width"), F.col("height"))
    return rows.select("vid", "tid", seq.alias("seq"), "fid", box.alias("box"))


def schedule(anchors: DataFrame, co: DataFrame, clicks: DataFrame) -> DataFrame:
    """vid, seq, tid, fid, is_ref, n_points: references by object, then the rest by frame and object."""
    every = anchors.select(*KEY, "is_ref").unionByName(co.select(*KEY, F.lit(False).alias("is_ref")))
    points = clicks.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    every = every.join(points, KEY, "left")
    first = F.when(F.col("is_ref"), F.lit(-1)).otherwise(F.col("fid"))
    seq = F.row_number().over(Window.partitionBy("vid").orderBy(first, "tid")).cast("long")
    return every.select("vid", seq.alias("seq"), "tid", "fid", "is_ref", (2 + F.coalesce("n", F.lit(0))).alias("n_points"))


def over_cap(scheduled: DataFrame, most: int = MOST_POINTS) -> DataFrame:
    """Prompts with more points than a session takes, which must be none."""
    return scheduled.where(F.col("n_points") > most).select(*KEY, "n_points")


def checked(scheduled: DataFrame, most: int = MOST_POINTS) -> DataFrame:
    """The schedule; a prompt of too many points, or a second reference of an object, is an error when it is read."""
    refs = F.sum(F.col("is_ref").cast("int")).over(Window.partitionBy("vid", "tid"))
    bad = F.when(F.col("n_points") > most, F.lit("too many points")).when(refs > 1, F.lit("two references"))
    text = F.concat_ws(" ", bad, F.col("vid").cast("string"), F.col("tid").cast("string"), F.col("fid").cast("string"))
    seq: Column = F.when(bad.isNull(), F.col("seq")).otherwise(F.raise_error(text))
    return scheduled.select("vid", seq.alias("seq"), "tid", "fid", "is_ref", "n_points")


def negatives_totals(co: DataFrame, clicks: DataFrame) -> DataFrame:
    """vid, negative_clicks, co_prompts, co_prompts_at_tracker_boxes of every video that has any."""
    n = lambda df, *more: df.groupBy("vid").agg(*more)
    of_clicks = n(clicks, F.count(F.lit(1)).alias("negative_clicks"))
    of_co = n(co, F.count(F.lit(1)).alias("co_prompts"), F.count_if(F.col("generated") != 0).alias("co_prompts_at_tracker_boxes"))
    names = ("negative_clicks", "co_prompts", "co_prompts_at_tracker_boxes")
    return of_clicks.join(of_co, "vid", "full").select("vid", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in names))
