"""The coverage rule: no stretch of an object's span longer than max_gap frames without an anchor."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANCHORS = ("tid long", "fid long", "is_ref boolean", "fill string", "n_flags long", "gap_lo long", "gap_hi long")


def fill_object(lo: int, hi: int, kept: list[int], boxed: dict[int, int | None], max_gap: int, any_box: bool) -> list[tuple]:
    """(fid, source, n_flags, gap_lo, gap_hi) of the anchors to add.

    `boxed` has the flags of human keyframes and None for other boxes. A gap's fill is the human keyframe with the
    fewest flags, then the one nearest the middle, then the earliest; without one, and if `any_box`, the nearest box.
    Gaps don't touch each other, so the order in which they are split does not matter.
    """
    if not max_gap or not kept:
        return []
    anchors = sorted(kept)
    # a span's edge may be filled itself, if it is no anchor
    todo = [(a, b, False, False) for a, b in zip(anchors, anchors[1:])]
    todo += [(lo, anchors[0], True, False), (anchors[-1], hi, False, True)]
    out = []
    while todo:
        a, b, with_a, with_b = todo.pop()
        if b - a <= max_gap:
            continue
        inside = [f for f in boxed if (a < f or with_a and f == a) and (f < b or with_b and f == b)]
        human = [f for f in inside if boxed[f] is not None]
        if not human and not (any_box and inside):
            continue
        rank = lambda f: (boxed[f] or 0, abs(2 * f - a - b), f)
        fid = min(human or inside, key=rank)
        out.append((fid, "human" if human else "tracker", boxed[fid] or 0, a, b))
        todo += [(a, fid, with_a, False), (fid, b, False, with_b)]
    return out


def anchored(rows: DataFrame, max_gap: int, any_box: bool) -> DataFrame:
    """vid, tid, fid, is_ref, fill (null: kept anyway; human or tracker: added to close a gap), n_flags, gap_lo, gap_hi of
    every anchor.

    `rows` are the boxes in span (with lo, hi), with n_flags (null if a tracker drew the box), kept and is_ref. A row of an
    object holds frame numbers only, at most one for each frame of its video.
    """
    boxes = rows.groupBy("vid", "tid", "lo", "hi").agg(
        F.collect_list(F.struct("fid", F.col("n_flags").cast("long").alias("n_flags"))).alias("boxed"),
        F.collect_list(F.when(F.col("kept"), F.col("fid"))).alias("kept"),
        F.min(F.when(F.col("is_ref"), F.col("fid"))).alias("ref"),
    )

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                boxed = {x["fid"]: x["n_flags"] for x in r["boxed"]}
                found = fill_object(r["lo"], r["hi"], r["kept"], boxed, max_gap, any_box)
                out += [(r["vid"], r["tid"], f, f == r["ref"], None, None, None, None) for f in r["kept"]]
                out += [(r["vid"], r["tid"], f, False, *more) for f, *more in found]
            names = ["vid", *(x.split()[0] for x in ANCHORS)]
            cols = list(zip(*out)) or [()] * len(names)
            of = {"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}
            kinds = [batch.schema.field("vid").type, *(of[x.split()[1]] for x in ANCHORS)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    kind = boxes.schema["vid"].dataType.simpleString()
    return boxes.mapInArrow(run, ", ".join((f"vid {kind}", *ANCHORS)))


def human_gap(plan, any_box: bool | None = None) -> DataFrame:
    """Anchors under the plain rule: every human keyframe counts as clean."""
    from trackset.operators import planning

    s = plan.settings
    human = planning.is_human()
    rows = planning.chosen(planning.in_span(plan.tracks("max_iou")), human, s.max_anchors)
    rows = rows.withColumn("n_flags", F.when(human, 0))
    return anchored(rows, s.max_gap, (s.gap_fill == "any") if any_box is None else any_box)
