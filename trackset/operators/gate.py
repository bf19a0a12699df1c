"""The keyframe quality gate: metrics, flags, and the anchors that it leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackset.config import Settings
from trackset.functions import geometry
from trackset.operators import coverage, planning

OBJECT = ("vid", "tid")


def with_motion(boxes: DataFrame) -> DataFrame:
    """Adds motion: mean centre displacement per frame to the boxes before and after, in box diagonals.

    Over all boxes of an object, not only its keyframes; null for a lone box.
    """
    x, y = geometry.centre()
    own = Window.partitionBy(*OBJECT).orderBy("fid")

    def speed(step) -> Column:
        far = F.hypot(x - step(x), y - step(y))
        return far / (F.abs(F.col("fid") - step(F.col("fid"))) * geometry.diagonal())

    rows = boxes.withColumn("before", speed(lambda c: F.lag(c).over(own))).withColumn("after", speed(lambda c: F.lead(c).over(own)))
    motion = F.coalesce((F.col("before") + F.col("after")) / 2, "before", "after")
    return rows.withColumn("motion", motion).drop("before", "after")


def metrics(boxes: DataFrame, settings: Settings) -> DataFrame:
    """Boxes in span with edge, motion, rel_size, medians over their object's keyframes, and the flags (in a fixed order)
    and n_flags of keyframes, null for other boxes.

    `boxes` are tracks with max_iou and overlap; they may have a `blur` score, without which the blur flag is never set.
    """
    g = settings.gate
    rows = planning.in_span(with_motion(boxes))
    if "blur" not in rows.columns:
        rows = rows.withColumn("blur", F.lit(None))
    rows = rows.withColumn("blur", F.col("blur").cast("double")).withColumn("area", geometry.area().cast("double"))
    rows = rows.withColumn("human", planning.is_human())
    for name in ("area", "overlap", "blur"):
        rows = rows.withColumn(f"mid_{name}", F.median(F.when(F.col("human"), F.col(name))).over(Window.partitionBy(*OBJECT)))
    rows = rows.withColumn("edge", geometry.edge_touches(F.col("width"), F.col("height"), g.edge_tol))
    rows = rows.withColumn("rel_size", F.col("area") / F.col("mid_area"))
    tests = {
        "edge": (F.col("edge") > g.edge_touches) | ((F.col("edge") > 0) & (F.col("rel_size") < g.edge_size)),
        "overlap": (F.col("overlap") > g.overlap_most)
        | (F.col("overlap") > F.col("mid_overlap") + g.overlap_over_median),
        "motion": F.coalesce(F.col("motion") > g.motion_most, F.lit(False)),
        "small": F.col("rel_size") < g.size_least,
        "blur": F.coalesce((F.col("blur") < g.blur_least) | (F.col("blur") < g.blur_of_median * F.col("mid_blur")), F.lit(False)),
    }
    flags = F.array_compact(F.array(*(F.when(t, F.lit(name)) for name, t in tests.items())))
    rows = rows.withColumn("flags", F.when(F.col("human"), flags))
    return rows.withColumn("n_flags", F.when(F.col("human"), F.size("flags")).cast("long"))


def candidate(fallback: str) -> Column:
    """Keyframes without flags; of objects without any, those with the fewest, or none under `refuse`."""
    if fallback == "refuse":
        return F.col("n_flags") == 0
    return F.col("n_flags") == F.min("n_flags").over(Window.partitionBy(*OBJECT))


def flagged(plan) -> DataFrame:
    """Boxes in span with flags, candidate, is_ref and kept (span edges that are kept anyway included)."""
    s = plan.settings
    rows = planning.chosen(metrics(plan.tracks("max_iou", "overlap"), s), candidate(s.fallback), s.max_anchors)
    if s.gate.keep_span_edges:
        own = Window.partitionBy(*OBJECT)
        fid = F.when(F.col("human"), F.col("fid"))
        end = F.col("human") & ((F.col("fid") == F.min(fid).over(own)) | (F.col("fid") == F.max(fid).over(own)))
        rows = rows.withColumn("kept", F.col("kept") | (end & (F.col("n") > 0)))
    return rows


def anchors(plan) -> DataFrame:
    """The anchors that the gate leaves, gap fills included (as of coverage.anchored)."""
    s = plan.settings
    return coverage.anchored(flagged(plan), s.max_gap, s.gap_fill == "any")


def refusals(plan) -> DataFrame:
    """vid, tid, reason: no_human_keyframe, or, under the fallback `refuse`, no_hq_anchor where all keyframes are flagged."""
    rows = metrics(plan.tracks("max_iou", "overlap"), plan.settings)
    clean = rows.groupBy(*OBJECT).agg(F.count_if("human").alias("n"), F.count_if(F.col("n_flags") == 0).alias("clean"))
    bare = plan.refused
    if plan.settings.fallback != "refuse":
        return bare
    return bare.unionByName(clean.where("n > 0 AND clean = 0").select(*OBJECT, F.lit("no_hq_anchor").alias("reason")))


def summary(flagged: DataFrame, anchors: DataFrame) -> DataFrame:
    """vid, tid, n_candidates, n_clean, n_kept, fallback (no keyframe is clean), flags_ignored (of the candidates then,
    sorted), dropped (reason:count, sorted)."""
    held = anchors.select("vid", "tid", "fid", F.lit(True).alias("held"))
    rows = flagged.where("human").join(held, ["vid", "tid", "fid"], "left")
    used = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("candidate"), F.col("flags"))))))
    base = rows.groupBy(*OBJECT).agg(
        F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("n_flags") == 0).alias("n_clean"), used.alias("used")
    )
    n_kept = anchors.groupBy(*OBJECT).agg(F.count(F.lit(1)).alias("n_kept"))
    why = F.when(F.size("flags") > 0, F.col("flags")).otherwise(F.array(F.lit("thinned")))
    lost = rows.where("held IS NULL").select("vid", "tid", F.explode(why).alias("reason"))
    lost = lost.groupBy("vid", "tid", "reason").agg(F.count(F.lit(1)).alias("n"))
    text = F.concat_ws(":", "reason", F.col("n").cast("string"))
    lost = lost.groupBy(*OBJECT).agg(F.concat_ws(",", F.sort_array(F.collect_list(text))).alias("dropped"))
    out = base.join(n_kept, list(OBJECT), "left").join(lost, list(OBJECT), "left")
    return out.select(
        "vid",
        "tid",
        "n_candidates",
        "n_clean",
        F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
        (F.col("n_clean") == 0).alias("fallback"),
        F.concat_ws(",", "used").alias("flags_ignored"),
        F.coalesce("dropped", F.lit("")).alias("dropped"),
    )
