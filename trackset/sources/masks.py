"""Where masks come from: segmentation itself is a plug-in."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackset import scratch
from trackset.functions import rle

MASKS = "vid string, fid long, tid long, counts string, conf double"
FAILED = "error_type string, message string, cuda_oom boolean"


class MaskSource(Protocol):
    """Gives the masks of one direction (vid, fid, tid, counts, conf) for a schedule of prompts."""

    def masks(self, schedule: DataFrame, direction: str) -> DataFrame: ...


class TableSource:
    """Masks that have been made elsewhere."""

    def __init__(self, **tables: DataFrame):
        self.tables = tables

    def masks(self, schedule: DataFrame, direction: str) -> DataFrame:
        return self.tables[direction]


def _by_video(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches that are sorted by video, cut and gathered into one list for each video."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        vids = batch.column("vid").to_pylist()
        first = 0
        for i in range(1, len(vids) + 1):
            if i < len(vids) and vids[i] == vids[first]:
                continue
            if held and vids[first] != at:
                yield held
                held = []
            at = vids[first]
            held.append(batch.slice(first, i - first))
            first = i
    if held:
        yield held


class PluginSource:
    """Masks from a function over Arrow batches of the schedule, one video after the other.

    A video on which the function fails gives an error row and no masks, and the others go on.
    """

    def __init__(self, run: Callable[[str, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str = MASKS):
        self.run, self.schema = run, schema

    def attempts(self, schedule: DataFrame, direction: str) -> DataFrame:
        """Masks with error_type, message and cuda_oom, which are null but for videos that failed. Written once."""
        run = self.run
        names = [x.split()[0] for x in f"{self.schema}, {FAILED}".split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
        types = [kinds[x.split()[1]] for x in f"{self.schema}, {FAILED}".split(", ")]
        n_failed = len(FAILED.split(", "))

        def one(batches):
            for video in _by_video(batches):
                try:
                    made = list(run(direction, iter(video)))
                except Exception as e:  # noqa: BLE001 - whatever a plug-in raises becomes a row
                    row = {k: None for k in names} | {"vid": video[0].column("vid")[0].as_py(), "error_type": type(e).__name__}
                    row |= {"message": str(e)[:2000], "cuda_oom": "out of memory" in str(e).lower()}
                    yield pa.RecordBatch.from_arrays([pa.array([row[k]], t) for k, t in zip(names, types)], names)
                    continue
                for batch in made:
                    none = [pa.nulls(batch.num_rows, t) for t in types[-n_failed:]]
                    yield pa.RecordBatch.from_arrays([*batch.columns, *none], names)

        n = int(schedule.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ordered = schedule.repartition(n, "vid").sortWithinPartitions("vid", "seq")
        return scratch.written(ordered.mapInArrow(one, f"{self.schema}, {FAILED}"), f"masks-{direction}")

    def masks(self, schedule: DataFrame, direction: str) -> DataFrame:
        made = self.attempts(schedule, direction)
        return made.where("error_type IS NULL").drop(*(x.split()[0] for x in FAILED.split(", ")))

    def errors(self, schedule: DataFrame, direction: str) -> DataFrame:
        """vid, error_type, message, cuda_oom of the videos that failed."""
        return self.attempts(schedule, direction).where("error_type IS NOT NULL").select("vid", "error_type", "message", "cuda_oom")


def propagation(spans: DataFrame, direction: str) -> DataFrame:
    """vid, start, n_frames of one direction: forward from the first frame, backward from the last."""
    start = "lo" if direction == "forward" else "hi"
    return spans.selectExpr("vid", f"{start} AS start", "hi - lo + 1 AS n_frames")


def mask_counts(mask: np.ndarray) -> str:
    """Compressed counts of a two-dimensional mask, columns first."""
    flat = np.asarray(mask).astype(bool).ravel(order="F")
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flat.astype("i1"), [0]))))
    return rle.pack(rle.runs_of(list(zip(edges[::2].tolist(), edges[1::2].tolist())), flat.size))


def payload_rows(payload, ids: str = "out_obj_ids", masks: str = "out_binary_masks", scores: str = "out_probs") -> list[tuple[int, str, float]]:
    """(object, counts, score) of what a tracker returns for one frame; nothing of a payload that is something else.

    Masks may be tensors (with cpu() and numpy()) and have leading dimensions of 1; a missing score is not a number.
    """
    if not isinstance(payload, dict) or ids not in payload:
        return []
    found, given = [], payload.get(scores)
    for k, (tid, mask) in enumerate(zip(payload[ids], payload[masks])):
        mask = mask.cpu().numpy() if hasattr(mask, "cpu") else np.asarray(mask)
        score = float(given[k]) if given is not None and k < len(given) else float("nan")
        found.append((int(tid), mask_counts(np.squeeze(mask)), score))
    return found


def blur_scores(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """vid, fid, tid, blur: the sharpness of each box's crop. `frames` has vid, fid, height, width and grey (its bytes)."""
    from trackset.functions.blur import sharpness

    rows = boxes.select("vid", "fid", "tid", "xmin", "ymin", "xmax", "ymax").join(frames.select("vid", "fid", "height", "width", "grey"), ["vid", "fid"])

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                image = np.frombuffer(r["grey"], "u1").reshape(r["height"], r["width"])
                out.append(sharpness(image, r["xmin"], r["ymin"], r["xmax"], r["ymax"]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vid", "fid", "tid")), pa.array(out, pa.float64())], ["vid", "fid", "tid", "blur"])

    kind = rows.schema["vid"].dataType.simpleString()
    return rows.mapInArrow(run, f"vid {kind}, fid long, tid long, blur double")


def frame_stats(frames: DataFrame) -> DataFrame:
    """vid, fid, mean, height, width of decoded frames (vid, fid, height, width, grey): what the checks of a video need."""

    def run(batches):
        for batch in batches:
            means = [float(np.frombuffer(x, "u1").mean()) if x else 0.0 for x in batch.column("grey").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vid", "fid")), pa.array(means, pa.float64()), *(batch.column(c) for c in ("height", "width"))],
                ["vid", "fid", "mean", "height", "width"],
            )

    kind = frames.schema["vid"].dataType.simpleString()
    rows = frames.select("vid", F.col("fid").cast("long"), F.col("height").cast("long"), F.col("width").cast("long"), "grey")
    return rows.mapInArrow(run, f"vid {kind}, fid long, mean double, height long, width long")


def video_checks(stats: DataFrame, videos: DataFrame) -> DataFrame:
    """vid, has_video, count_ok, size_ok, black of videos (vid, frame_count, width, height), from the stats of their frames."""
    from trackset.sources import files

    seen = stats.groupBy("vid").agg(F.count(F.lit(1)).alias("n"), F.min("height").alias("h"), F.max("height").alias("h2"), F.min("width").alias("w"), F.max("width").alias("w2"))
    dark = files.black(stats.join(videos.select("vid", "frame_count"), "vid"), F.col("frame_count"))
    rows = videos.join(seen, "vid", "left").join(dark, "vid", "left")
    same = (F.col("h") == F.col("height")) & (F.col("h2") == F.col("height")) & (F.col("w") == F.col("width")) & (F.col("w2") == F.col("width"))
    return rows.select(
        "vid", F.col("n").isNotNull().alias("has_video"), (F.col("n") == F.col("frame_count")).alias("count_ok"), same.alias("size_ok"), F.coalesce("black", F.lit(False)).alias("black")
    )
