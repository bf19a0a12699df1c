"""Explicit schemas of the files that are read and the tables that are written."""

from __future__ import annotations

from pyspark.sql import types as T

_ENTRY = T.StructType([T.StructField("tid", T.LongType()), T.StructField("category", T.StringType())])
_BOX = T.StructType([T.StructField(n, T.LongType()) for n in ("xmin", "ymin", "xmax", "ymax")])

#: Relation records: one JSON array for each split.
RELATIONS = T.StructType(
    [
        T.StructField("vid", T.StringType()),
        T.StructField("fps", T.DoubleType()),
        T.StructField("frame_count", T.LongType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("used_segment", T.StructType([T.StructField("begin_fid", T.LongType()), T.StructField("end_fid", T.LongType())])),
        T.StructField(
            "used_relation",
            T.StructType(
                [
                    T.StructField("subject_tid", T.LongType()),
                    T.StructField("object_tid", T.LongType()),
                    T.StructField("predicate", T.StringType()),
                ]
            ),
        ),
        T.StructField("subject/objects", T.ArrayType(_ENTRY)),
    ]
)

#: Video annotations: one JSON document for each video.
ANNOTATIONS = T.StructType(
    [
        T.StructField("video_id", T.StringType()),
        T.StructField("video_path", T.StringType()),
        T.StructField("frame_count", T.LongType()),
        T.StructField("fps", T.DoubleType()),
        T.StructField("width", T.LongType()),
        T.StructField("height", T.LongType()),
        T.StructField("subject/objects", T.ArrayType(_ENTRY)),
        T.StructField(
            "trajectories",
            T.ArrayType(
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("tid", T.LongType()),
                            T.StructField("bbox", _BOX),
                            T.StructField("generated", T.LongType()),
                            T.StructField("tracker", T.StringType()),
                        ]
                    )
                )
            ),
        ),
    ]
)

#: Caption lines of relations.
CAPTIONS = T.StructType(
    [
        T.StructField("vid", T.StringType()),
        T.StructField("subject_tid", T.LongType()),
        T.StructField("predicate", T.StringType()),
        T.StructField("object_tid", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("spans", T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.LongType())))),
    ]
)

#: Why a unit failed.
ERRORS = T.StructType(
    [
        T.StructField("vid", T.StringType()),
        T.StructField("attempt", T.LongType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("cuda_oom", T.BooleanType()),
        T.StructField("interrupted", T.BooleanType()),
    ]
)
