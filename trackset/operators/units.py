"""The worklist: relation records grouped into one unit for each video, and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackset import scratch
from trackset.config import Settings


def first_boxes(raw: DataFrame) -> DataFrame:
    """One box for each (vid, fid, tid): the first in its frame's list."""
    keys = ("vid", "fid", "tid")
    rest = [c for c in raw.columns if c not in (*keys, "ord")]
    one = raw.groupBy(*keys).agg(F.min(F.struct("ord", *rest)).alias("b"))
    return one.select(*keys, *(F.col("b")[c].alias(c) for c in rest))


def clips(relations: DataFrame, videos: DataFrame) -> DataFrame:
    """vid, seg_begin, seg_end (the frames that any of a video's relations touches), tids (objects of relations), width,
    height: one row for each video that has relations and an annotation."""
    sides = F.array_distinct(F.flatten(F.collect_set(F.array("s", "o"))))
    of = relations.groupBy("vid").agg(F.min("begin").alias("seg_begin"), F.max("end").alias("seg_end"), sides.alias("tids"))
    return of.join(videos.select("vid", "width", "height"), "vid")


def triples(relations: DataFrame) -> DataFrame:
    """vid, s, p, o, ord: distinct relations with their first appearance."""
    return relations.groupBy("vid", "s", "p", "o").agg(F.min("ord").alias("ord"))


def relation_tids(relations: DataFrame) -> DataFrame:
    """vid, tid: the objects that take part in a relation."""
    return relations.select("vid", F.explode(F.array("s", "o")).alias("tid")).distinct()


def categories(relations: DataFrame) -> DataFrame:
    """vid, tid, category: the last entry of the last record wins."""
    entries = relations.select("vid", "ord", F.posexplode("cats").alias("pos", "entry"))
    return entries.groupBy("vid", F.col("entry.tid").alias("tid")).agg(
        F.max_by("entry.category", F.struct("ord", "pos")).alias("category")
    )


def unannotated(relations: DataFrame, videos: DataFrame) -> DataFrame:
    """vid: videos that have relations but no annotation; a worklist cannot be made with any."""
    return relations.select("vid").distinct().join(videos, "vid", "left_anti")


def units(relations: DataFrame, videos: DataFrame) -> DataFrame:
    """One row for each video: split, n_tids (objects of relations), n_frames (of the annotation), n_records, segment,
    relations (array of s, p, o, in the order of first appearance) and cats (array of tid, category by tid; the last entry
    of the last record wins). Categories may name objects that no relation has.

    `videos` has vid and frame_count.
    """
    entries = F.transform("cats", lambda x, i: F.struct(x["tid"].alias("tid"), i.alias("pos"), x["category"].alias("category")))
    rows = relations.groupBy("vid").agg(
        F.concat_ws("+", F.sort_array(F.collect_set("split"))).alias("split"),
        F.size(F.array_distinct(F.flatten(F.collect_set(F.array("s", "o"))))).cast("long").alias("n_tids"),
        F.count(F.lit(1)).alias("n_records"),
        F.min("begin").alias("seg_begin"),
        F.max("end").alias("seg_end"),
        F.sort_array(F.collect_list(F.struct("ord", F.struct("s", "p", "o").alias("r"), entries.alias("cats")))).alias("rows"),
    )
    listed = F.array_distinct(F.transform("rows", lambda x: x["r"]))
    # the rows are in order, so the last entry of an object is the last that a fold meets
    entry = lambda x: F.struct(x["tid"].alias("tid"), x["category"].alias("category"))
    flat = F.flatten(F.transform("rows", lambda x: x["cats"]))
    last = F.aggregate(
        flat,
        F.array().cast("array<struct<tid:bigint,category:string>>"),
        lambda held, x: F.array_append(F.filter(held, lambda y: y["tid"] != x["tid"]), entry(x)),
    )
    out = rows.join(videos.select("vid", F.col("frame_count").alias("n_frames")), "vid")
    return out.select(
        "vid", "split", "n_tids", "n_frames", "n_records", "seg_begin", "seg_end", listed.alias("relations"), F.sort_array(last).alias("cats")
    )


def as_text(units: DataFrame) -> DataFrame:
    """Units with relations (s-p-o) and categories (tid:category) as text, for reports; the arrays are what is read."""
    relation = lambda r: F.concat_ws("-", r["s"].cast("string"), r["p"], r["o"].cast("string"))
    cat = lambda c: F.concat_ws(":", c["tid"].cast("string"), c["category"])
    text = lambda name, one: F.concat_ws(",", F.transform(name, one)).alias(name)
    return units.select(*(c for c in units.columns if c not in ("relations", "cats")), text("relations", relation), text("cats", cat))


def unit_counts(units: DataFrame, missing: DataFrame, settings: Settings) -> DataFrame:
    """Totals over a worklist; `missing` lists videos without a file."""
    flagged = units.join(missing.select("vid").distinct().withColumn("no_video", F.lit(1)), "vid", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return flagged.agg(
        F.count(F.lit(1)).alias("units"),
        total("no_video").alias("video_missing"),
        F.count_if(F.col("n_tids") > settings.max_objects).alias("too_many_objects"),
        total("n_tids").alias("relation_tids"),
        total("n_frames").alias("frames"),
        total((F.col("seg_end") - F.col("seg_begin") + 1) * F.col("n_tids")).alias("prop_frame_objects"),
    )


def by_split(units: DataFrame) -> DataFrame:
    return units.groupBy("split").agg(F.count(F.lit(1)).alias("units"))


def known_counts(relations: DataFrame) -> DataFrame:
    """scope (a split, or `all`), records, videos, pairs of video and object: exact."""
    pairs = relations.withColumn("tid", F.explode(F.array("s", "o")))
    pairs = pairs.groupBy("split", "vid", "tid").agg(F.count(F.lit(1)).alias("n"))
    records = relations.groupBy("split").agg(F.count(F.lit(1)).alias("records"))
    per = pairs.groupBy("split").agg(F.countDistinct("vid").alias("videos"), F.count(F.lit(1)).alias("pairs"))
    every = pairs.agg(F.countDistinct("vid").alias("videos"), F.countDistinct("vid", "tid").alias("pairs"))
    every = every.crossJoin(relations.agg(F.count(F.lit(1)).alias("records")))  # one row each
    return (
        records.join(per, "split")
        .select(F.col("split").alias("scope"), "records", "videos", "pairs")
        .unionByName(every.select(F.lit("all").alias("scope"), "records", "videos", "pairs"))
    )


def shard_order(units: DataFrame, shards: int) -> DataFrame:
    """shard, place, vid: each shard walks all units, from its own block on. Units are in text order.

    Ranks come from sorted ranges: the sizes of the ranges, a row each, give every range's first rank.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    ordered = units.select("vid", F.col("vid").cast("string").alias("name")).repartitionByRange("name")
    ordered = scratch.written(ordered.sortWithinPartitions("name").withColumn("part", F.spark_partition_id()), "ranges")
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()  # a row for each range
    first, n = {}, 0
    for row in sizes:
        first[row["part"]], n = n, n + row["size"]
    start = units.sparkSession.createDataFrame(list(first.items()) or [(0, 0)], "part int, first long")
    nth = F.row_number().over(Window.partitionBy("part").orderBy("name")) - 1 + F.col("first")
    ranked = ordered.join(F.broadcast(start), "part").withColumn("nth", nth)  # a row for each range
    ranked = ranked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    begin = (F.col("shard") * -(-n // shards)) % max(1, n)
    return ranked.select("shard", F.pmod(F.col("nth") - begin, F.lit(max(1, n))).alias("place"), "vid")


def selected(units: DataFrame, wanted: DataFrame, limit: int = 0) -> DataFrame:
    """Requested units (nth, vid) in request order, repeats kept; unknown ones have known = false. A limit counts the
    known ones."""
    known = units.select("vid").distinct().withColumn("known", F.lit(True))
    rows = wanted.join(known, "vid", "left").select("nth", "vid", F.coalesce("known", F.lit(False)).alias("known"))
    if not limit:
        return rows
    last = rows.where("known").orderBy("nth").limit(limit).agg(F.max("nth").alias("last"))
    return rows.join(F.broadcast(last), F.col("known") & (F.col("nth") <= F.col("last"))).drop("last")  # one row


def first_units(units: DataFrame, limit: int) -> DataFrame:
    """The first units in text order; 0 takes all."""
    return units.orderBy(F.col("vid").cast("string")).limit(limit) if limit else units


def once(wanted: DataFrame) -> DataFrame:
    """Requests (nth, vid) without repeats: each at its first place."""
    return wanted.groupBy("vid").agg(F.min("nth").alias("nth")).select("nth", "vid")


def unit_cost(units: DataFrame, passes: int) -> DataFrame:
    """vid, seconds (allocated), offload: what a unit is expected to take."""
    frames, objects = F.col("n_frames"), F.col("n_tids")
    session = frames * passes * (F.lit(24) + 6 * objects)  # hundredths of a second
    return units.select(
        "vid",
        ((F.lit(9000) + session) * 18).alias("milliseconds"),
        ((frames > 1500) | (frames * objects > 2500)).alias("offload"),
    )


def relation_rows(units: DataFrame) -> DataFrame:
    """The relations of a worklist's units, as rows in order: vid, nth, s, p, o."""
    rows = units.select("vid", F.posexplode("relations").alias("nth", "r"))
    return rows.select("vid", F.col("nth").cast("long").alias("nth"), "r.*")
