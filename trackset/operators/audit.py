"""Integrity of written records: missing, extra, repeated and invalid ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackset.config import MODEL, MODEL_VERSION
from trackset.functions import rle

KEY = ["vid", "tid", "fid"]
# What records may say.
MODES = ("pvs_box_multianchor", "pvs_box_hqanchor")
POLICIES = ("human", "human_gap", "hq")
DIRECTIONS = ("forward", "backward", "bidirectional")
SPLITS = ("train", "val", "test")
#: Why a frame, an object or a whole clip has no mask.
REASONS = (
    "empty_mask",
    "not_tracked",
    "disputed_mask",
    "passes_conflict",
    "handed_over_speck",
    "speck_mask",
    "no_human_keyframe",
    "no_hq_anchor",
    "frame_count_mismatch",
    "frame_size_mismatch",
    "decode_black",
    "too_many_objects",
    "video_missing",
)


def missing(expected: DataFrame, records: DataFrame) -> DataFrame:
    return expected.join(records, KEY, "left_anti").select(*KEY)


def extra(expected: DataFrame, records: DataFrame) -> DataFrame:
    return records.join(expected, KEY, "left_anti").select(*KEY)


def repeated(records: DataFrame) -> DataFrame:
    return records.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def violation(rec: str = "") -> Column:
    """The first rule that a flat record breaks, null if none.

    Columns: vid (text), tid, fid, model, checkpoint_hash, version, code_commit, created_at, tracker, prompt_mode, policy,
    anchors (null: the payload has none), has_gap, negatives_ok (null: not said), direction, has_merge, generated, split,
    reason, rle_h, rle_w, counts, confidence.
    """
    c = lambda name: F.col(f"{rec}{name}")
    blank = lambda name: c(name).isNull() | (c(name) == "")
    absent = lambda name: c(name).isNull() | (c(name) < 0)
    refusal = c("counts").isNull()
    conf = c("confidence")
    rules = [
        (blank("vid"), "vid is empty"),
        (absent("tid"), "tid is not a number from 0"),
        (absent("fid"), "fid is not a number from 0"),
        (blank("model"), "model is empty"),
        (blank("checkpoint_hash"), "checkpoint_hash is empty"),
        (blank("version"), "version is empty"),
        (blank("code_commit"), "code_commit is empty"),
        (blank("created_at"), "created_at is empty"),
        (blank("tracker"), "tracker is empty"),
        (c("model") != MODEL, "model is not the expected one"),
        (c("version") != MODEL_VERSION, "version is not the expected one"),
        (~c("checkpoint_hash").rlike("^[0-9a-f]{64}$"), "checkpoint_hash is no sha256"),
        (~F.coalesce(c("prompt_mode").isin(*MODES), F.lit(False)), "prompt_mode is unknown"),
        (c("anchors").isNull() | F.exists(F.coalesce("anchors", F.array().cast("array<bigint>")), lambda x: x.isNull()), "anchors are missing"),
        (~F.coalesce(c("policy").isin(*POLICIES), F.lit(False)), "policy is unknown"),
        ((c("policy") == "human_gap") & ~c("has_gap") & (F.size(c("anchors")) > 0), "gap is missing"),
        (~F.coalesce(c("negatives_ok"), F.lit(True)), "contained negatives are malformed"),
        (c("direction").isNotNull() & ~c("direction").isin(*DIRECTIONS), "direction is unknown"),
        ((c("direction") == "bidirectional") & (F.size(c("anchors")) > 0) & ~c("has_merge"), "merge is missing"),
        (~F.coalesce(c("generated").isin(0, 1), F.lit(False)), "generated is not 0 or 1"),
        (~F.coalesce(c("split").isin(*SPLITS), F.lit(False)), "split is unknown"),
        (refusal & ~F.coalesce(c("reason").isin(*REASONS), F.lit(False)), "reason is unknown"),
        (refusal & conf.isNotNull(), "a refusal has a confidence"),
        (~refusal & c("reason").isNotNull(), "a mask has a reason"),
        (~refusal & ~F.coalesce((c("rle_h") > 0) & (c("rle_w") > 0) & (c("counts") != ""), F.lit(False)), "mask is malformed"),
        (~refusal & conf.isNull(), "a mask has no confidence"),
        (~refusal & ~F.isnan(conf) & ((conf < 0) | (conf > 1)), "confidence is not in 0 to 1"),
    ]
    return F.coalesce(*(F.when(test, F.lit(text)) for test, text in rules))


def violations(records: DataFrame) -> DataFrame:
    """vid, tid, fid, violation of the records that break a rule."""
    return records.withColumn("violation", violation()).where("violation IS NOT NULL").select(*KEY, "violation")


def problems(records: DataFrame, expected: DataFrame, videos: DataFrame | None = None) -> DataFrame:
    """vid, tid, fid, kind, detail of everything that is wrong with flat records (see `violation`): invalid, undecodable
    (counts that cannot be read), size (not the video's), repeated, extra, missing.

    Invalid records count for nothing else. Undecodable masks and wrong sizes are reported and stay.
    """
    judged = records.withColumn("violation", violation())
    valid = judged.where("violation IS NULL")
    masks = valid.where("counts IS NOT NULL").withColumn("ok", rle.decodable("counts", F.col("rle_h") * F.col("rle_w")))
    of = lambda df, kind, detail: df.select(*KEY, F.lit(kind).alias("kind"), detail.alias("detail"))
    size = F.concat_ws("x", F.col("rle_h").cast("string"), F.col("rle_w").cast("string"))
    parts = [
        of(judged.where("violation IS NOT NULL"), "invalid", F.col("violation")),
        of(masks.where("NOT ok"), "undecodable", size),
        of(repeated(valid), "repeated", F.col("n").cast("string")),
        of(missing(expected, valid), "missing", F.lit("")),
        of(extra(expected, valid.select(*KEY).distinct()), "extra", F.lit("")),
    ]
    if videos is not None:
        beside = masks.where("ok").join(videos.select("vid", "width", "height"), "vid")
        parts.append(of(beside.where("rle_h <> height OR rle_w <> width"), "size", size))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def first_problems(problems: DataFrame, most: int = 20) -> DataFrame:
    """At most `most` problems of each video: a report, the counts come from the whole table."""
    nth = F.row_number().over(Window.partitionBy("vid").orderBy("kind", "tid", "fid", "detail"))
    return problems.withColumn("nth", nth).where(F.col("nth") <= most)


def split_tables(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid records as masks and refusals; invalid ones are in neither."""
    valid = records.where(violation().isNull())
    return valid.where("counts IS NOT NULL"), valid.where("counts IS NULL").drop("counts", "confidence", "rle_h", "rle_w")
