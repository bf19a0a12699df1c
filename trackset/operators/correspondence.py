"""Relation-level correspondence: tracklets of a relation's objects, caption spans, and dispositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackset.config import DISPOSITIONS, SOURCES

RELATION = ["vid", "s", "p", "o"]


def frame_name(fid: Column) -> Column:
    return F.format_string("%06d", fid)


def span_text(text: Column, start: Column, end: Column) -> Column:
    """The half-open span [start, end) of a text, an error if it does not lie in it."""
    fits = (start >= 0) & (start < end) & (end <= F.length(text))
    return F.when(fits, F.substring(text, start + 1, end - start)).otherwise(F.raise_error(F.lit("span outside its text")))


def last_captions(lines: DataFrame, order: str) -> DataFrame:
    """One caption for each relation: the last line wins."""
    rest = [c for c in lines.columns if c not in (*RELATION, order)]
    return lines.groupBy(*RELATION).agg(F.max_by(F.struct(*rest), order).alias("c")).select(*RELATION, "c.*")


def tracklets(records: DataFrame, segments: DataFrame) -> DataFrame:
    """vid, tid, present, frames_with_record, mean_confidence, max_confidence, first_fid, refusals, for each object
    with a mask in its video's segment. A relation's objects share their video's segment, so this is per object."""
    rows = records.join(segments, "vid").where("fid BETWEEN seg_begin AND seg_end")
    # by reason first (null: a mask), so that one pass over the records serves all figures; scores are summed as whole
    # billionths, which is the same in any order
    by_reason = rows.groupBy("vid", "tid", "reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("confidence") * 1e9).cast("long")).alias("billionths"),
        F.count("confidence").alias("scored"),
        F.max("confidence").alias("top"),
        F.min("fid").alias("first"),
    )
    mask = F.col("reason").isNull()
    of_mask = lambda c: F.max(F.when(mask, F.col(c)))
    text = F.when(~mask, F.concat_ws(":", "reason", F.col("n").cast("string")))
    mean = of_mask("billionths") / F.nullif(of_mask("scored"), F.lit(0))
    out = by_reason.groupBy("vid", "tid").agg(
        F.coalesce(of_mask("n"), F.lit(0)).alias("present"),
        F.sum("n").alias("n_records"),
        (F.coalesce(mean, F.lit(1e9)) / 1e9).alias("mean_confidence"),
        F.coalesce(of_mask("top"), F.lit(1.0)).alias("max_confidence"),
        of_mask("first").alias("first_fid"),
        F.concat_ws(",", F.sort_array(F.collect_list(text))).alias("refusals"),
    )
    return out.where("present > 0")


def samples(relations: DataFrame, tracklets: DataFrame, captions: DataFrame) -> DataFrame:
    """vid, s, p, o, disposition, n_tracklets, n_groups, valid of each relation.

    `captions` has text (null: an empty caption) and the arrays s_spans and o_spans of (start, end). Without a caption a
    relation has the disposition `` and is not judged.
    """
    # one join for both sides of a relation
    sides = relations.select(*RELATION, F.explode(F.array("s", "o")).alias("tid"))
    sides = sides.join(tracklets.select("vid", "tid", F.lit(True).alias("has")), ["vid", "tid"], "left")
    has = lambda t: F.coalesce(F.bool_or(F.col("has") & (F.col("tid") == F.col(t))), F.lit(False))
    rows = sides.groupBy(*RELATION).agg(has("s").alias("s_mask"), has("o").alias("o_mask"))
    rows = rows.join(captions.withColumn("given", F.lit(True)), RELATION, "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    spanned = lambda c: F.coalesce(F.col("text").isNotNull() & (F.size(c) > 0), F.lit(False))
    other = F.col("s") != F.col("o")
    s, o = flag("s_mask"), flag("o_mask")
    s_group, o_group = s & spanned("s_spans"), other & o & spanned("o_spans")
    all_spanned = (~s | s_group) & (~(other & o) | o_group)
    one = lambda c: c.cast("long")
    n_all, n_spanned = one(s) + one(other & o), one(s_group) + one(o_group)
    main = s_group & other
    complete = s & F.col("text").isNotNull() & o & all_spanned
    disposition = (
        F.when(~flag("given"), "")
        .when(~s, "missing_main_referent")
        .when(complete, "complete_bcc")
        .when(main, "incomplete_context")
        .otherwise("missing_main_referent")
    )
    kept = F.when(~flag("given") | complete, n_all).when(~s | main, n_spanned).otherwise(F.lit(0).cast("long"))
    rows = rows.select(
        *RELATION, disposition.alias("disposition"), kept.alias("n_tracklets"), n_spanned.alias("n_groups"), main.alias("main"),
        F.coalesce(F.col("text") != "", F.lit(False)).alias("worded"),
    )
    empty = (F.col("n_tracklets") == 0) & (F.col("n_groups") == 0) & (F.col("disposition") == "missing_main_referent")
    full = (F.col("n_tracklets") > 0) & (F.col("n_tracklets") == F.col("n_groups")) & F.col("main")
    # a record without a text is rejected, whatever it links
    valid = F.when(F.col("disposition") != "", F.col("worded") & (empty | full))
    return rows.select(*RELATION, "disposition", "n_tracklets", "n_groups", valid.alias("valid"))


def span_links(relations: DataFrame, tracklets: DataFrame, captions: DataFrame) -> DataFrame:
    """vid, s, p, o, start, end, text, tracklets: which tracklets each span of a caption names."""
    rows = relations.join(captions.where("text IS NOT NULL"), RELATION)
    sides = F.array(
        F.struct(F.col("s").alias("tid"), F.col("s_spans").alias("spans")),
        F.struct(F.when(F.col("s") != F.col("o"), F.col("o")).alias("tid"), F.col("o_spans").alias("spans")),
    )
    rows = rows.select(*RELATION, "text", F.explode(sides).alias("side")).select(*RELATION, "text", "side.tid", F.explode("side.spans").alias("span"))
    rows = rows.join(tracklets.select("vid", "tid"), ["vid", "tid"], "left_semi")
    found = span_text(F.col("text"), F.col("span.start"), F.col("span.end"))
    rows = rows.select(*RELATION, F.col("span.start").alias("start"), F.col("span.end").alias("end"), found.alias("text"), "tid")
    name = F.concat(F.lit("vidor-"), F.col("tid").cast("string"))
    return rows.groupBy(*RELATION, "start", "end", "text").agg(F.concat_ws(",", F.sort_array(F.collect_set(name))).alias("tracklets"))


def dispositions(samples: DataFrame) -> DataFrame:
    """disposition, n, n_valid."""
    return samples.groupBy("disposition").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce("valid", F.lit(False))).alias("n_valid")
    )


def sample_ids(relations: DataFrame, dataset: str) -> DataFrame:
    """vid, s, p, o, sample_id, expression_id."""
    expression = F.concat_ws("-", F.col("s").cast("string"), "p", F.col("o").cast("string"))
    sample = F.concat_ws(":", F.lit(dataset), "split", F.col("vid").cast("string"), expression)
    return relations.select(*RELATION, sample.alias("sample_id"), expression.alias("expression_id"))


def overlay(records: DataFrame, boxes: DataFrame, categories: DataFrame, colours: int = 8) -> DataFrame:
    """vid, fid, tid, colour, label, box sides: what a renderer draws on each frame."""
    from pyspark.sql import Window

    nth = categories.withColumn("colour", (F.row_number().over(Window.partitionBy("vid").orderBy("tid")) - 1) % colours)
    head = F.split("category", "/")[0]
    label = F.concat(F.col("tid").cast("string"), F.lit(":"), head, F.when(F.col("reason").isNotNull(), " (no mask)").otherwise(""))
    rows = records.select("vid", "fid", "tid", "reason").join(boxes.select("vid", "fid", "tid", "xmin", "ymin", "xmax", "ymax"), ["vid", "fid", "tid"])
    return rows.join(nth, ["vid", "tid"]).select(
        "vid", "fid", "tid", F.col("colour").cast("long").alias("colour"), label.alias("label"), "xmin", "ymin", "xmax", "ymax"
    )


def aligned(records: DataFrame, segments: DataFrame, value: str) -> DataFrame:
    """vid, tid, n_frames, present, values: for each object with a mask a dense array over the frames of its video's segment,
    null where it has none."""
    rows = records.where("reason IS NULL").select("vid", "tid", "fid", F.col(value).alias("value")).join(segments, "vid")
    held = rows.where("fid BETWEEN seg_begin AND seg_end").groupBy("vid", "tid", "seg_begin", "seg_end").agg(
        F.map_from_entries(F.collect_list(F.struct("fid", "value"))).alias("held"), F.count(F.lit(1)).alias("present")
    )
    frames = F.sequence("seg_begin", "seg_end")
    values = F.transform(frames, lambda f: F.try_element_at("held", f))
    return held.select("vid", "tid", F.size(frames).cast("long").alias("n_frames"), "present", values.alias("values"))


def relation_records(relations: DataFrame, tracklets: DataFrame, captions: DataFrame, segments: DataFrame, schema_version: str, source: str) -> DataFrame:
    """The nested record of each relation (vid, split, s, p, o) that has a caption.

    `tracklets` has vid, tid, masks (dense, of size and counts), present, and further columns that go along. Tracklets stay
    and groups form as `samples` counts them: a complete record keeps both objects, else only objects with a span, and
    nothing is kept where the subject has a mask but no span.
    """
    more = [c for c in tracklets.columns if c not in ("vid", "tid")]
    rows = relations.join(captions, RELATION).join(segments, "vid")
    for side in ("s", "o"):
        of = tracklets.select("vid", F.col("tid").alias(side), F.struct(F.concat(F.lit("vidor-"), F.col("tid").cast("string")).alias("tracklet_id"), F.lit(source).alias("source"), *more).alias(f"{side}_track"))
        rows = rows.join(of, ["vid", side], "left")
    rows = rows.withColumn("o_track", F.when(F.col("s") != F.col("o"), F.col("o_track")))
    text = F.coalesce("text", F.lit(""))

    def group(side: str, role: Column) -> Column:
        spans = F.transform(f"{side}_spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), span_text(text, x["start"], x["end"]).alias("text")))
        given = F.col(f"{side}_track").isNotNull() & F.col("text").isNotNull() & (F.coalesce(F.size(f"{side}_spans"), F.lit(0)) > 0)
        return F.when(given, F.struct(role.alias("role"), spans.alias("text_spans"), F.array(F.col(f"{side}_track.tracklet_id")).alias("tracklet_ids")))

    # an object in relation with itself is context to itself
    role = F.when(F.col("s") == F.col("o"), "context_entity").otherwise("main_referent")
    rows = rows.withColumn("s_group", group("s", role)).withColumn("o_group", group("o", F.lit("context_entity")))
    s, o = F.col("s_track").isNotNull(), F.col("o_track").isNotNull()
    named = (~s | F.col("s_group").isNotNull()) & (~o | F.col("o_group").isNotNull())
    object_masked = o | (F.col("s") == F.col("o")) & s
    complete = s & object_masked & F.col("text").isNotNull() & named
    main = F.col("s_group").isNotNull() & (F.col("s") != F.col("o"))
    disposition = F.when(~s, "missing_main_referent").when(complete, "complete_bcc").when(main, "incomplete_context").otherwise("missing_main_referent")
    keep = lambda side: F.when(complete | ((~s | main) & F.col(f"{side}_group").isNotNull()), F.col(f"{side}_track"))
    groups = F.array_compact(F.array("s_group", "o_group"))
    frame = lambda f: F.format_string("%06d", f)
    frames = F.transform(F.sequence("seg_begin", "seg_end"), frame)
    expression = F.concat_ws("-", F.col("s").cast("string"), "p", F.col("o").cast("string"))
    rows = rows.select(
        *RELATION,
        "split",
        F.lit(schema_version).alias("schema_version"),
        expression.alias("expression_id"),
        text.alias("text"),
        F.lit(False).alias("negative"),
        frames.alias("frame_ids"),
        F.transform(frames, lambda f: F.concat_ws("/", F.col("vid").cast("string"), F.concat(f, F.lit(".jpg")))).alias("frame_files"),
        F.array_compact(F.array(keep("s"), keep("o"))).alias("tracklets"),
        groups.alias("groups"),
        disposition.alias("disposition"),
    )
    return rows.withColumn("span_links", inverted("groups"))


def inverted(groups: str) -> Column:
    """The canonical inverse of groups: each span (start, end, text) once, in order, with its tracklets' ids, sorted."""
    pair = lambda g: F.transform(g["text_spans"], lambda x: F.struct(x.alias("span"), g["tracklet_ids"].alias("ids")))
    pairs = F.flatten(F.transform(groups, pair))
    spans = F.array_sort(F.array_distinct(F.transform(pairs, lambda x: x["span"])))
    ids = lambda span: F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(pairs, lambda x: x["span"] == span), lambda x: x["ids"]))))
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"), ids(x).alias("tracklet_ids")))


def record_problem(schema_version: str) -> Column:
    """The first rule that a nested record (of relation_records) breaks, null if none."""
    c = F.col
    n = F.size("frame_ids")
    tracklet = lambda test: F.exists("tracklets", test)
    group = lambda test: F.exists("groups", test)
    ids = F.transform("tracklets", lambda t: t["tracklet_id"])
    linked = F.array_distinct(F.flatten(F.transform("groups", lambda g: g["tracklet_ids"])))
    total = lambda counts: F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    bad_size = lambda m: m.isNotNull() & ((F.size(m["size"]) != 2) | F.exists(m["size"], lambda v: v <= 0))
    bad_counts = lambda m: m.isNotNull() & (m["counts"].isNull() | (total(m["counts"]) != F.get(m["size"], 0) * F.get(m["size"], 1)))
    present = lambda t: F.size(F.filter(t["masks"], lambda m: m.isNotNull()))
    wrong_span = lambda x: F.substring(c("text"), x["start"] + 1, x["end"] - x["start"]) != x["text"]
    none = F.size("tracklets") == 0
    rules = [
        (c("schema_version") != schema_version, "schema_version is not the expected one"),
        (c("text") == "", "text is empty"),
        (n == 0, "no frames"),
        ((F.size("frame_files") > 0) & (F.size("frame_files") != n), "frame_files do not match frame_ids"),
        (F.size(F.array_distinct(ids)) != F.size(ids), "a tracklet comes twice"),
        (tracklet(lambda t: ~F.coalesce(t["source"].isin(*SOURCES), F.lit(False))), "a tracklet's source is unknown"),
        (tracklet(lambda t: F.size(t["masks"]) != n), "a tracklet has not one mask for each frame"),
        (tracklet(lambda t: F.exists(t["masks"], bad_size)), "a mask's size is malformed"),
        (tracklet(lambda t: F.exists(t["masks"], bad_counts)), "a mask's counts do not fill it"),
        (tracklet(lambda t: t["present"] != present(t)), "a tracklet's present frames are miscounted"),
        (group(lambda g: F.size(g["tracklet_ids"]) == 0), "a group has no tracklets"),
        (group(lambda g: F.exists(g["tracklet_ids"], lambda i: ~F.array_contains(ids, i))), "a group names a missing tracklet"),
        (group(lambda g: F.size(g["text_spans"]) == 0), "a group has no span"),
        (group(lambda g: F.exists(g["text_spans"], wrong_span)), "a span is not what the text has there"),
        (F.size(F.array_except(ids, linked)) > 0, "a tracklet is in no group"),
        (~c("span_links").eqNullSafe(inverted("groups")), "span_links are not the inverse of groups"),
        (~F.coalesce(c("disposition").isin(*DISPOSITIONS), F.lit(False)), "disposition is unknown"),
        (c("negative") & (~none | (F.size("groups") > 0)), "a negative record has tracklets"),
        (c("negative") & (c("disposition") != "negative_unsegmentable"), "a negative record's disposition is another"),
        (~c("negative") & none & (c("disposition") != "missing_main_referent"), "no tracklets, but a main referent"),
        (~none & ~group(lambda g: g["role"] == "main_referent"), "no group is the main referent"),
    ]
    return F.coalesce(*(F.when(test, F.lit(text)) for test, text in rules))
