"""Planning: tracks of relation objects, spans, human keyframes, reference anchors, thinning and refusals.

Everything here is about one video at a time. Boxes are dealt out by video once, and every later step (first box of a
frame, overlaps within a frame, spans of an object, windows over an object's frames) groups by the video and something
else, which that partitioning serves: one exchange for all of them. A video has a bounded number of boxes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackset import scratch
from trackset.config import Settings
from trackset.functions import geometry
from trackset.operators import units

OBJECT = ("vid", "tid")
KEY = ("vid", "fid", "tid")
#: What can be measured of a box against the other boxes of its frame.
MEASURES = ("max_iou", "overlap", "inners")


def _measures(boxes: Column, x: Column, wanted: tuple[str, ...]) -> list[Column]:
    """Of box x among the boxes of its frame: the largest IoU and the largest covered share (0 without others), and
    the boxes inside it with their centres."""

    def largest(measure) -> Column:
        more = lambda most, y: F.when(y["tid"] == x["tid"], most).otherwise(F.greatest(most, measure(x, y)))
        return F.aggregate(boxes, F.lit(0.0), more)

    def inner(y: Column) -> Column:
        cx, cy = geometry.centre(y)
        return F.struct(y["tid"].alias("tid"), cx.alias("x"), cy.alias("y"))

    inside = F.filter(boxes, lambda y: (y["tid"] != x["tid"]) & geometry.contains(x, y))
    how = {"max_iou": lambda: largest(geometry.iou), "overlap": lambda: largest(geometry.covered), "inners": lambda: F.transform(inside, inner)}
    return [how[m]().alias(m) for m in wanted]


def tracks(raw: DataFrame, clips: DataFrame, measures: tuple[str, ...] = ()) -> DataFrame:
    """The boxes of relation objects, one for each (vid, fid, tid): the first in its frame's list (`ord`). Beside raw's
    columns: the clip's, the object's span (lo, hi: the segment cut to its first and last box), and `measures`."""
    rest = [c for c in raw.columns if c not in (*KEY, "ord")]
    of_clip = [c for c in clips.columns if c not in ("vid", "tids")]
    rows = raw.repartition("vid").join(clips, "vid").where(F.array_contains("tids", F.col("tid")))
    listed = F.sort_array(F.collect_list(F.struct("tid", "ord", *rest)))
    frames = rows.groupBy("vid", "fid", *of_clip).agg(listed.alias("listed"))
    again = lambda x, i: F.get("listed", i - 1)["tid"].eqNullSafe(x["tid"])
    frames = frames.withColumn("boxes", F.filter("listed", lambda x, i: ~again(x, i))).drop("listed")
    if measures:
        one = lambda x: F.struct(x["tid"].alias("tid"), *(x[c].alias(c) for c in rest), *_measures(F.col("boxes"), x, measures))
        frames = frames.withColumn("boxes", F.transform("boxes", one))
    boxes = frames.select("vid", "fid", *of_clip, F.inline_outer("boxes")).drop("ord")
    own = Window.partitionBy(*OBJECT)
    lo = F.greatest("seg_begin", F.min("fid").over(own)).alias("lo")
    return boxes.select("*", lo, F.least("seg_end", F.max("fid").over(own)).alias("hi"))


def unboxed(tids: DataFrame, boxes: DataFrame) -> DataFrame:
    """Relation objects without any box, which a plan cannot be made for."""
    return tids.join(boxes, list(OBJECT), "left_anti").select(*OBJECT)


def spans(boxes: DataFrame) -> DataFrame:
    """vid, tid, lo, hi."""
    return boxes.select(*OBJECT, "lo", "hi").distinct()


def in_span(boxes: DataFrame) -> DataFrame:
    """The boxes within their object's span: exactly the frames that get a record."""
    return boxes.where("fid BETWEEN lo AND hi")


def is_human() -> Column:
    """Boxes that a person has drawn."""
    return F.coalesce(F.col("generated"), F.lit(0)) == 0


def references(measured: DataFrame) -> DataFrame:
    """vid, tid, ref, ref_max_iou, n_human: the keyframe with the least overlap, the earliest of equals."""
    best = F.min(F.struct("max_iou", "fid"))
    return (
        measured.groupBy(*OBJECT)
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n_human"))
        .select(*OBJECT, F.col("best.fid").alias("ref"), F.col("best.max_iou").alias("ref_max_iou"), "n_human")
    )


def chosen(rows: DataFrame, candidate: Column, most: int) -> DataFrame:
    """Adds candidate, n (candidates of the object), is_ref (the candidate with the least overlap) and kept (candidates
    spread evenly over `most`, and the reference; 0 keeps all). Windows over an object's frames serve all."""
    own = Window.partitionBy(*OBJECT)
    rows = rows.withColumn("candidate", F.coalesce(candidate, F.lit(False)))
    one = F.when(F.col("candidate"), 1)
    best = F.min(F.when(F.col("candidate"), F.struct("max_iou", "fid"))).over(own)
    rows = rows.withColumn("is_ref", F.coalesce(F.col("candidate") & (F.col("fid") == best["fid"]), F.lit(False)))
    rows = rows.withColumn("nth", F.count(one).over(own.orderBy("fid")) - 1).withColumn("n", F.count(one).over(own))
    kept = F.lit(True)
    if most:
        step = (F.col("n") - 1) / F.lit(float(most - 1))
        picks = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.rint(i * step).cast("long"))
        kept = (F.col("n") <= most) | F.array_contains(picks, F.col("nth")) | F.col("is_ref")
    return rows.withColumn("kept", F.col("candidate") & kept)


def thinned(measured: DataFrame, most: int) -> DataFrame:
    """vid, tid, fid, is_ref: the anchors of measured keyframes."""
    return chosen(measured, F.lit(True), most).where("kept").select(*OBJECT, "fid", "is_ref")


def refusals(boxes: DataFrame) -> DataFrame:
    """vid, tid, reason: objects without a keyframe within their span."""
    keyframe = is_human() & F.col("fid").between(F.col("lo"), F.col("hi"))
    none = boxes.groupBy(*OBJECT).agg(F.bool_or(keyframe).alias("any")).where("NOT any")
    return none.select(*OBJECT, F.lit("no_human_keyframe").alias("reason"))


def prop_spans(spans: DataFrame) -> DataFrame:
    """vid, lo, hi, n_frames: what is propagated through, over all objects, refused ones too."""
    out = spans.groupBy("vid").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return out.withColumn("n_frames", F.col("hi") - F.col("lo") + 1)


class Plan:
    """The tables of one plan, from boxes, relation records and the videos' sizes.

    They are lazy, and a measure is worked out only where it is asked for. `shared` writes the tracks once, with all
    measures, for work with many branches.
    """

    def __init__(self, raw: DataFrame, relations: DataFrame, videos: DataFrame, settings: Settings):
        self.raw, self.relations, self.settings = raw, relations, settings
        self.clips = units.clips(relations, videos)
        self._written: DataFrame | None = None

    def shared(self) -> Plan:
        if self._written is None:
            self._written = scratch.written(self.tracks(*MEASURES), "tracks")
        return self

    def tracks(self, *measures: str) -> DataFrame:
        return tracks(self.raw, self.clips, measures) if self._written is None else self._written

    @property
    def tids(self) -> DataFrame:
        return units.relation_tids(self.relations)

    @property
    def segments(self) -> DataFrame:
        return self.clips.select("vid", "seg_begin", "seg_end")

    @property
    def boxes(self) -> DataFrame:
        return self.tracks()

    @property
    def spans(self) -> DataFrame:
        return spans(self.tracks())

    @property
    def records(self) -> DataFrame:
        return in_span(self.tracks())

    @property
    def keyframes(self) -> DataFrame:
        return self.records.where(is_human())

    @property
    def measured(self) -> DataFrame:
        """Keyframes with max_iou."""
        return in_span(self.tracks("max_iou")).where(is_human())

    @property
    def refused(self) -> DataFrame:
        return refusals(self.tracks())

    @property
    def references(self) -> DataFrame:
        return references(self.measured)

    @property
    def human(self) -> DataFrame:
        """The anchors of the policy `human`."""
        return thinned(self.measured, self.settings.max_anchors)
