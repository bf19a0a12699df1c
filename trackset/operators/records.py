"""Mask records and refusals, unit status, ledger and campaign totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackset.config import Settings

KEY = ["vid", "fid", "tid"]
#: Why a whole clip is refused, and which of these a transcoded video repairs.
CLIP_REASONS = ("too_many_objects", "video_missing", "frame_count_mismatch", "frame_size_mismatch", "decode_black")
REQUEUE_REASONS = ("decode_black", "frame_size_mismatch")


def clip_reasons(rows: DataFrame, settings: Settings) -> DataFrame:
    """vid, clip_reason: why a whole video is refused, cheap tests first; null if it is not.

    `rows` are units (vid, n_tids) with has_video, count_ok, size_ok and black of their videos.
    """
    reason = (
        F.when(F.col("n_tids") > settings.max_objects, "too_many_objects")
        .when(~F.coalesce("has_video", F.lit(False)), "video_missing")
        .when(~F.col("count_ok"), "frame_count_mismatch")
        .when(~F.col("size_ok"), "frame_size_mismatch")
        .when(F.col("black"), "decode_black")
    )
    return rows.select("vid", reason.alias("clip_reason"))


def merged_records(frames: DataFrame, refused: DataFrame, decided: DataFrame, clips: DataFrame) -> DataFrame:
    """vid, tid, fid, reason (null: a mask), source, area, confidence, generated, tracker of every boxed frame in span.

    A video's reason comes before an object's, and that before the merge's.
    """
    rows = frames.join(clips, "vid", "left").join(refused, ["vid", "tid"], "left")
    kept = [c for c in ("mask",) if c in decided.columns]
    merged = decided.select(*KEY, "decision", F.col("reason").alias("merge_reason"), "reading", "area", "confidence", *kept)
    rows = rows.join(merged, KEY, "left")
    none = F.when(F.col("reading") == "both_empty", "empty_mask").otherwise("speck_mask")
    own = (
        F.when(F.col("decision") == "refused", F.col("merge_reason"))
        .when(F.col("decision") == "none", none)
        .when(F.col("decision").isNull(), "empty_mask")
    )
    rows = rows.withColumn("why", F.coalesce("clip_reason", "reason", own))
    real = F.col("why").isNull()
    return rows.select(
        "vid",
        "tid",
        "fid",
        F.col("why").alias("reason"),
        F.when(real, F.col("decision")).alias("source"),
        F.when(real, F.col("area")).alias("area"),
        F.when(real, F.col("confidence")).alias("confidence"),
        *(F.when(real, F.col(c)).alias(c) for c in kept),
        "generated",
        "tracker",
    )


def single_pass_records(
    frames: DataFrame, refused: DataFrame, masks: DataFrame, clips: DataFrame | None = None, want_boxes: bool = False
) -> DataFrame:
    """vid, tid, fid, reason, mask [, confidence, generated, tracker] of a run in one direction. `masks` has a row (vid,
    fid, tid, mask [, confidence]) for each prediction, `clips` why whole videos are refused.

    A frame without any prediction was not tracked, if the pass predicted anything at all in the video.
    """
    any_frame = masks.select("vid", "fid").distinct().withColumn("frame_seen", F.lit(True))
    any_video = masks.select("vid").distinct().withColumn("video_seen", F.lit(True))
    # whether a mask has pixels is told before the join, so that masks travel only where they are wanted; then they are
    # exchanged, as Spark's estimate of their size is far too small to go by in handing them to the driver
    some = (F.coalesce(F.size("mask"), F.lit(0)) > 0).alias("some")
    own = masks.select(*KEY, *(c for c in ("mask", "confidence") if c in masks.columns), some).hint("merge")
    rows = frames.join(refused, ["vid", "tid"], "left").join(own, KEY, "left")
    rows = rows.join(any_frame, ["vid", "fid"], "left").join(any_video, "vid", "left")
    rows = rows.withColumn("clip_reason", F.lit(None).cast("string")) if clips is None else rows.join(clips, "vid", "left")
    why = (
        F.when(F.col("clip_reason").isNotNull(), F.col("clip_reason"))
        .when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("video_seen") & F.col("frame_seen").isNull(), "not_tracked")
        .when(~F.coalesce("some", F.lit(False)), "empty_mask")
    )
    more = [F.when(why.isNull(), F.col(c)).alias(c) for c in ("mask", "confidence") if c in rows.columns]
    return rows.select("vid", "tid", "fid", why.alias("reason"), *more, *(c for c in ("generated", "tracker") if want_boxes))


def by_reason(records: DataFrame) -> DataFrame:
    return records.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def unit_status(units: DataFrame, done: DataFrame, errors: DataFrame, settings: Settings) -> DataFrame:
    """vid, status, attempts. `done` lists videos with records; `errors` has vid, attempt, interrupted, cuda_oom."""
    rows = units.select("vid").join(done.select("vid").distinct().withColumn("done", F.lit(True)), "vid", "left")
    rows = rows.join(errors.withColumn("failed", F.lit(True)), "vid", "left")
    n = F.coalesce("attempt", F.lit(0)).cast("long")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    over = F.when(flag("interrupted"), n >= settings.max_interruptions).otherwise(
        (n >= settings.max_attempts) | ((n >= 1) & ~flag("cuda_oom"))
    )
    status = F.when(F.col("done"), "done").when(flag("failed") & over, "failed").otherwise("pending")
    return rows.select("vid", status.alias("status"), F.when(F.col("done"), 0).otherwise(n).cast("long").alias("attempts"))


def next_attempt(state: Column, event: Column) -> Column:
    """The state (attempts, oom, finished) of a unit after one more event (ok, oom, killed, error).

    Once out of memory, a unit keeps its smaller footprint for good.
    """
    return F.struct(
        F.when(event == "ok", state["attempts"]).otherwise(state["attempts"] + 1).alias("attempts"),
        (state["oom"] | (event == "oom")).alias("oom"),
        (state["finished"] | (event == "ok")).alias("finished"),
    )


def attempts(events: DataFrame) -> DataFrame:
    """vid, attempts, oom, finished after all events (vid, nth, event) of each unit."""
    start = F.struct(F.lit(0).alias("attempts"), F.lit(False).alias("oom"), F.lit(False).alias("finished"))
    listed = events.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("nth", "event"))).alias("events"))
    after = F.aggregate("events", start, lambda s, e: next_attempt(s, e["event"]))
    return listed.select("vid", after.alias("s")).select("vid", F.col("s.attempts").cast("long").alias("attempts"), "s.oom", "s.finished")


def run_totals(records: DataFrame) -> DataFrame:
    """vid, masks, refusals."""
    return records.groupBy("vid").agg(
        F.count_if(F.col("reason").isNull()).alias("masks"), F.count_if(F.col("reason").isNotNull()).alias("refusals")
    )


def with_costs(ledger: DataFrame, runs: DataFrame, errors: DataFrame, paths: DataFrame) -> DataFrame:
    """A ledger with wall_s (one decimal) and vram_gb (two) of its runs, error_type of its errors, and video_path."""
    rows = ledger.join(runs.select("vid", F.round("wall_s", 1).alias("wall_s"), F.round("vram_gb", 2).alias("vram_gb")), "vid", "left")
    rows = rows.join(errors.select("vid", "error_type"), "vid", "left").join(paths.select("vid", F.col("path").alias("video_path")), "vid", "left")
    if_done = lambda c: F.when(F.col("status") == "done", F.col(c))
    return rows.withColumns({"wall_s": if_done("wall_s"), "vram_gb": if_done("vram_gb")})


def ledger(units: DataFrame, status: DataFrame, totals: DataFrame, clips: DataFrame) -> DataFrame:
    """One row for each unit; totals only of those that are done."""
    rows = units.join(status, "vid").join(totals, "vid", "left").join(clips, "vid", "left")
    if_done = lambda c: F.when(F.col("status") == "done", F.col(c)).alias(c)
    return rows.select(
        "vid", "split", "n_tids", "n_frames", "status", "attempts", if_done("masks"), if_done("refusals"), if_done("clip_reason")
    )


def export_totals(records: DataFrame) -> DataFrame:
    """split, masks, refusals, clips, and which commits and checkpoints the records name, sorted."""
    listed = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c))).alias(f"{c}s")
    return records.groupBy("split").agg(
        F.count_if(F.col("reason").isNull()).alias("masks"),
        F.count_if(F.col("reason").isNotNull()).alias("refusals"),
        F.countDistinct("vid").alias("clips"),
        listed("code_commit"),
        listed("checkpoint_hash"),
    )


def run_costs(ledger: DataFrame) -> DataFrame:
    """hours and vram_gb of the units that are done, from a ledger's rounded figures."""
    done = F.col("status") == "done"
    return ledger.agg(
        F.round(F.coalesce(F.sum(F.when(done, F.col("wall_s"))), F.lit(0.0)) / 3600, 3).alias("hours"),
        F.round(F.coalesce(F.max(F.when(done, F.col("vram_gb"))), F.lit(0.0)), 2).alias("vram_gb"),
    )


def stamped(records: DataFrame, anchors: DataFrame, split_of: DataFrame, videos: DataFrame, settings: Settings, stamps) -> DataFrame:
    """Records (with mask intervals) as flat rows that keep the record contract, with their payload as JSON.

    `anchors` are all anchors (vid, tid, fid, is_ref [, fill]), `split_of` has vid and split.
    """
    from trackset.functions import rle
    from trackset.sources import sinks

    of = anchors.groupBy("vid", "tid").agg(
        F.array_sort(F.collect_set("fid")).alias("anchors"),
        F.min(F.when(F.col("is_ref"), F.col("fid"))).alias("ref"),
        (F.count_if(F.col("fill").isNotNull()) if "fill" in anchors.columns else F.lit(0).cast("long")).alias("n_fills"),
    )
    both = settings.direction == "both"
    rows = records.join(of, ["vid", "tid"], "left").join(split_of, "vid").join(videos.select("vid", "width", "height"), "vid")
    prompted = F.col("anchors").isNotNull() & ~F.col("reason").isin(*CLIP_REASONS) | F.col("anchors").isNotNull() & F.col("reason").isNull()
    none = F.array().cast("array<bigint>")
    rows = rows.withColumn("anchors", F.when(prompted, F.col("anchors")).otherwise(none)).withColumn("ref", F.when(prompted, F.col("ref")))
    gap = F.when(prompted, F.struct(F.lit(settings.max_gap).alias("max_gap"), F.lit(settings.gap_fill).alias("gap_fill"), "n_fills"))
    merge = F.when(prompted, F.struct(F.coalesce("source", F.lit("none")).alias("decision"), "reason"))
    extras = {}
    if settings.policy == "human_gap":
        extras["gap"] = gap
    if both:
        extras["merge"] = merge
    direction = F.lit("bidirectional" if both else settings.direction)
    payload = sinks.payload(F.col("anchors"), F.col("ref"), F.lit(settings.policy), direction, extras)
    mode = "pvs_box_hqanchor" if settings.policy == "hq" else "pvs_box_multianchor"
    mask = F.col("reason").isNull()
    size = F.col("width") * F.col("height")
    return rows.select(
        "vid",
        "tid",
        "fid",
        *(F.lit(getattr(stamps, k)).alias(k) for k in ("model", "checkpoint_hash", "version", "code_commit", "created_at")),
        "tracker",
        F.lit(mode).alias("prompt_mode"),
        F.lit(settings.policy).alias("policy"),
        "anchors",
        F.lit(settings.policy == "human_gap").alias("has_gap"),
        F.lit(None).cast("boolean").alias("negatives_ok"),
        F.lit("bidirectional" if both else None if settings.direction == "forward" else settings.direction).cast("string").alias("direction"),
        F.lit(both).alias("has_merge"),
        "generated",
        "split",
        "reason",
        F.when(mask, F.col("height")).alias("rle_h"),
        F.when(mask, F.col("width")).alias("rle_w"),
        F.when(mask, rle.counts_text("mask", size)).alias("counts"),
        F.when(mask, F.col("confidence")).alias("confidence"),
        payload.alias("payload"),
    )


def requeued(ledger: DataFrame, copies: DataFrame) -> DataFrame:
    """vid, video_path of done units that were refused for what a transcode repairs and have a copy (vid, path) now: their
    runs, records and errors are superseded, and the worklist reads the copy."""
    return to_transcode(ledger, REQUEUE_REASONS).join(copies, "vid").select("vid", F.col("path").alias("video_path"))


def plan_lines(clips: DataFrame, spans: DataFrame, anchors: DataFrame, refused: DataFrame, categories: DataFrame) -> DataFrame:
    """vid, tid, line: what is planned for each object, in words."""
    of = anchors.groupBy("vid", "tid").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("is_ref"), F.col("fid"))).alias("ref"))
    rows = spans.join(of, ["vid", "tid"], "left").join(refused, ["vid", "tid"], "left").join(categories, ["vid", "tid"], "left")
    head = F.format_string("tid %d (%s): frames %d to %d", "tid", F.coalesce("category", F.lit("?")), "lo", "hi")
    tail = F.when(F.col("reason").isNotNull(), F.concat(F.lit("refused, "), "reason")).otherwise(
        F.format_string("%d anchors, reference %d", F.coalesce("n", F.lit(0).cast("long")), F.coalesce("ref", F.lit(-1).cast("long")))
    )
    return rows.join(clips.select("vid"), "vid").select("vid", "tid", F.concat_ws("; ", head, tail).alias("line"))


def campaign_status(ledger: DataFrame) -> DataFrame:
    """status, clips, masks, refusals, retried."""
    return ledger.groupBy("status").agg(
        F.count(F.lit(1)).alias("clips"),
        F.coalesce(F.sum("masks"), F.lit(0)).cast("long").alias("masks"),
        F.coalesce(F.sum("refusals"), F.lit(0)).cast("long").alias("refusals"),
        F.count_if(F.col("attempts") > 0).alias("retried"),
    )


def to_transcode(ledger: DataFrame, reasons: tuple[str, ...] = ("decode_black", "frame_count_mismatch", "frame_size_mismatch")) -> DataFrame:
    """vid, clip_reason: done units that were refused for how their video decodes."""
    return ledger.where((F.col("status") == "done") & F.col("clip_reason").isin(*reasons)).select("vid", "clip_reason")


def lease_state(owner: Column, me: Column, age_minutes: Column, stale: int = 30) -> Column:
    """free, mine, stale or held."""
    return F.when(owner.isNull(), "free").when(owner == me, "mine").when(age_minutes > stale, "stale").otherwise("held")


def confidence(logit: Column) -> Column:
    """A tracker's score: the sigmoid of its logit, 1.0 as it is, not-a-number if there is none."""
    return F.when(logit == 1.0, 1.0).otherwise(F.coalesce(1 / (1 + F.exp(-logit)), F.lit(float("nan"))))


def is_out_of_memory(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("out of memory"), F.lit(False))
