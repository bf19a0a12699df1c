"""Reading annotation files: relation records, video annotations, captions, id lists and error files.

Paths are anything that Spark reads. Nested files become the flat tables that the operators take; list positions become
columns, since the order of rows means nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackset import schemas
from trackset.config import SPLITS


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(fs.makeQualified(where))


def split_file(spark: SparkSession, root: str, split: str) -> str:
    """A split's file, in the folder `annotations` or beside it; an error if it is in neither."""
    for path in (f"{root}/annotations/{split}.json", f"{root}/{split}.json"):
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"no {split}.json under {root}")


def relations(spark: SparkSession, root: str, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """vid, split, s, p, o, begin, end, ord, cats, one row for each relation record of the splits."""
    parts = []
    for k, split in enumerate(splits):
        rows = spark.read.schema(schemas.RELATIONS).json(split_file(spark, root, split), multiLine=True)
        # one file is one array, which Spark reads in one task and in order
        parts.append(rows.withColumn("split", F.lit(split)).withColumn("ord", F.struct(F.lit(k).alias("split"), F.monotonically_increasing_id().alias("nth"))))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows.select(
        "vid",
        "split",
        F.col("used_relation.subject_tid").alias("s"),
        F.col("used_relation.predicate").alias("p"),
        F.col("used_relation.object_tid").alias("o"),
        F.col("used_segment.begin_fid").alias("begin"),
        F.col("used_segment.end_fid").alias("end"),
        "ord",
        F.col("`subject/objects`").alias("cats"),
    )


def annotation_index(spark: SparkSession, root: str) -> DataFrame:
    """vid, path of every file `<digits>.json` below root; of several for one video the last path counts."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root)
    stem = F.regexp_extract("path", r"([^/]+)\.json$", 1)
    named = files.select(stem.alias("vid"), "path").where(F.col("vid").rlike(r"^\d+$"))
    return named.groupBy("vid").agg(F.max("path").alias("path"))


def annotations(spark: SparkSession, root: str) -> DataFrame:
    """One row for each video: vid (its file's name), the document's columns, and path."""
    reader = spark.read.schema(schemas.ANNOTATIONS).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    docs = reader.json(root, multiLine=True).withColumn("path", F.col("_metadata.file_path"))
    docs = docs.withColumn("vid", F.regexp_extract("path", r"([^/]+)\.json$", 1)).where(F.col("vid").rlike(r"^\d+$"))
    last = docs.groupBy("vid").agg(F.max("path").alias("path"))
    return docs.join(last, ["vid", "path"], "left_semi")


def boxes(annotations: DataFrame) -> DataFrame:
    """vid, fid, tid, box, generated, tracker, ord (place in its frame's list): every box; the frame number is the place
    in `trajectories`. Missing flags mean a person's box without a tracker."""
    frames = annotations.select("vid", F.posexplode("trajectories").alias("fid", "frame"))
    rows = frames.select("vid", F.col("fid").cast("long").alias("fid"), F.posexplode("frame").alias("ord", "b"))
    return rows.select(
        "vid",
        "fid",
        "b.tid",
        "b.bbox.*",
        F.coalesce("b.generated", F.lit(0)).cast("long").alias("generated"),
        F.coalesce("b.tracker", F.lit("none")).alias("tracker"),
        "ord",
    )


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """vid: the first word of each line that is neither blank nor a comment."""
    first = F.split(F.trim("value"), r"\s+")[0]
    return spark.read.text(path).select(first.alias("vid")).where((F.col("vid") != "") & ~F.col("vid").startswith("#"))


def json_lines(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON lines under an explicit schema; blank lines are passed over, NaN is a number."""
    return spark.read.schema(schema).option("allowNonNumericNumbers", "true").json(path)


def captions(spark: SparkSession, path: str) -> DataFrame:
    """vid, s, p, o, text, s_spans, o_spans: one caption for each relation, the last line wins."""
    from trackset.operators.correspondence import last_captions

    lines = spark.read.text(path, wholetext=False).withColumn("nth", F.monotonically_increasing_id())
    rows = lines.select("nth", F.from_json("value", schemas.CAPTIONS).alias("c")).where("c.vid IS NOT NULL").select("nth", "c.*")
    rows = rows.withColumnsRenamed({"subject_tid": "s", "predicate": "p", "object_tid": "o"})
    pair = lambda x: F.struct(x[0].cast("int").alias("start"), x[1].cast("int").alias("end"))
    spans = lambda t: F.transform(F.try_element_at("spans", F.col(t).cast("string")), pair)
    last = last_captions(rows, "nth")
    return last.select("vid", "s", "p", "o", "text", spans("s").alias("s_spans"), spans("o").alias("o_spans"))


def errors(spark: SparkSession, path: str) -> DataFrame:
    """One row for each error file; one that cannot be read counts as a first attempt."""
    files = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    rows = files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("vid"), F.from_json("value", schemas.ERRORS).alias("e"))
    broken = F.col("e.attempt").isNull()
    return rows.select(
        "vid",
        F.when(broken, 1).otherwise(F.col("e.attempt")).cast("long").alias("attempt"),
        F.when(broken, "unreadable").otherwise(F.col("e.error_type")).alias("error_type"),
        F.coalesce("e.interrupted", F.lit(False)).alias("interrupted"),
        F.coalesce("e.cuda_oom", F.lit(False)).alias("cuda_oom"),
    )


def videos(annotations: DataFrame, transcoded: DataFrame, raw: DataFrame) -> DataFrame:
    """vid, path (null: missing): a transcoded copy before the raw video. Listings have video_path (relative) and path."""
    rows = annotations.select("vid", "video_path").join(transcoded.withColumnRenamed("path", "copy"), "video_path", "left")
    rows = rows.join(raw.withColumnRenamed("path", "own"), "video_path", "left")
    return rows.select("vid", F.coalesce("copy", "own").alias("path"))


def rebased(path: Column, old: str, new: str) -> Column:
    """A path below `old`, moved below `new`; an error if it is not below `old`."""
    old, new = old.rstrip("/") + "/", new.rstrip("/") + "/"
    moved = F.concat(F.lit(new), F.substring(path, F.lit(len(old) + 1), F.length(path)))
    return F.when(path.startswith(old), moved).otherwise(F.raise_error(F.concat(F.lit(f"not below {old}: "), path)))


def mask_table(spark: SparkSession, path: str) -> DataFrame:
    """A pass's masks from Parquet: vid, fid, tid, counts, conf -> vid, fid, tid, mask (intervals), conf."""
    from trackset.functions import rle

    rows = spark.read.parquet(path)
    return rows.select("vid", "fid", "tid", rle.counts_intervals("counts").alias("mask"), "conf")


def black(means: DataFrame, expected: Column, samples: int = 8, least: float = 2.0) -> DataFrame:
    """vid, black: whether the first even samples of a video's frame means (vid, fid, mean) are all dark."""
    from pyspark.sql import Window

    step = F.greatest(F.lit(1), F.floor(expected / samples))
    rows = means.where(F.col("fid") % step == 0)
    nth = F.row_number().over(Window.partitionBy("vid").orderBy("fid"))
    rows = rows.withColumn("nth", nth).where(F.col("nth") <= samples)
    return rows.groupBy("vid").agg((F.max("mean") < least).alias("black"))
