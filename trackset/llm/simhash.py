"""Operator 7: SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits. If two differ in at most 2 bits, then in one of their halves they differ in at most 1.
The anchors of a half are the words of a covering code: the perfect Hamming code of length 31, and one free bit.
Every half has an anchor at distance 1 or less, its home, so its covering radius is 1. A fingerprint visits all
anchors within covering radius plus threshold, 1 + 1, which are 2 or 17. Whoever lies within 1 bit of it has its
home among them. Visitors are compared with those at home, anchor by anchor.

Equal fingerprints are merged before and stand for one point. The comparison is an equi-join on the anchor with the
distance in its condition, so that crowded anchors can be split between tasks and only links come out.

Defined results: null and empty texts have fingerprint zero, linked like any other; null ids keep their row but
never name a component (null if all its ids are null); repeated rows each get a row; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .graph import connected_components

SHINGLE_WORDS = 3
SEED = 42
THRESHOLD = 2
_AT_ONCE = 1 << 17


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """Hashes of the text's shingles of k words, a stretch at a time; a text of fewer words is one shingle."""
    words = text.lower().split()  # bytes: A-Z only, and the same white space as WORD_PATTERN
    if not words:
        return
    whole = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - k + 1)
    last = [e - 1 for e in ends[min(k, len(words)) - 1 :]]
    first = [0, *ends[: n - 1]]
    hashed = xxhash.xxh64_intdigest
    for i in range(0, n, _AT_ONCE):
        spans = zip(first[i : i + _AT_ONCE], last[i : i + _AT_ONCE])
        yield np.array([hashed(whole[a:b], SEED) for a, b in spans], "<u8")


def fingerprint(text: bytes, k: int = SHINGLE_WORDS) -> int:
    return majority(shingle_hashes(text, k))


def majority(parts: Iterable[np.ndarray]) -> int:
    """The bits that more than half of the hashes have."""
    n, counts = 0, np.zeros(64, "i8")
    for h in parts:
        bits = np.unpackbits(h.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="i8")
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t, k) for t in batch.column(1).to_pylist()], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).cast("binary").alias("text")
    )
    return common.map_arrow(rows, run, "doc_id long, fp long")


def _syndrome(half: Column) -> Column:
    """Of the low 31 bits under the Hamming code: 0 for its words, else the position (from 1) to flip."""
    parts = []
    for bit in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> bit & 1)
        parts.append(F.shiftleft(F.bit_count(half.bitwiseAND(F.lit(mask))).cast("long") % 2, bit))
    return sum(parts[1:], parts[0])


def _flip(half: Column, position: Column) -> Column:
    """Position 0 flips nothing."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (position - 1).cast("int"))
    return half.bitwiseXOR(F.when(position > 0, bit).otherwise(F.lit(0).cast("long")))


def _halves(points: DataFrame) -> DataFrame:
    halves = F.array(
        F.struct(F.lit(0).cast("long").alias("side"), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("half")),
        F.struct(F.lit(1 << 32).alias("side"), F.shiftrightunsigned("fp", 32).alias("half")),
    )
    split = points.select("fp", F.explode(halves).alias("h")).select("fp", "h.side", "h.half")
    return split.withColumn("s", _syndrome(F.col("half")))


def homes(points: DataFrame) -> DataFrame:
    """fp, anchor: the nearest anchor of each half; the side is part of the anchor's number."""
    return _halves(points).select("fp", (F.col("side") + _flip(F.col("half"), F.col("s"))).alias("anchor"))


def visits(points: DataFrame) -> DataFrame:
    """fp, anchor: all anchors within 2 bits of each half."""
    nearest = _flip(F.col("half"), F.col("s"))
    near = F.array(nearest, nearest.bitwiseXOR(F.lit(1 << 31)))
    # two flips lead to a code word when their positions add up to the syndrome
    other = lambda i: i.bitwiseXOR(F.col("s"))
    pairs = F.transform(
        F.filter(F.sequence(F.lit(1).cast("long"), F.lit(31).cast("long")), lambda i: i < other(i)),
        lambda i: _flip(_flip(F.col("half"), i), other(i)),
    )
    found = F.when(F.col("s") == 0, near).otherwise(F.concat(near, pairs))
    return _halves(points).select("fp", "side", F.explode(found).alias("anchor")).select(
        "fp", (F.col("side") + F.col("anchor")).alias("anchor")
    )


def links(points: DataFrame) -> DataFrame:
    """a, b: distinct fingerprints of `points` (fp) that differ in 1 or 2 bits, a < b; a link may come twice."""
    home, visit = homes(points).alias("h"), visits(points).alias("v")
    near = F.bit_count(F.col("h.fp").bitwiseXOR(F.col("v.fp"))) <= THRESHOLD
    found = home.join(visit, (F.col("h.anchor") == F.col("v.anchor")) & (F.col("h.fp") < F.col("v.fp")) & near)
    return found.select(F.col("h.fp").alias("a"), F.col("v.fp").alias("b"))


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp, component_id (smallest id reachable over links) of every row."""
    rows = common.materialise(fingerprints(docs, k, id_col, text_col), "fingerprints")
    points = common.materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "points")
    roots = connected_components(links(points.select("fp")))
    named = points.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    named = common.materialise(named, "named")
    # written, so that the join exchanges both sides and Spark can split a giant component
    ids = common.materialise(named.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    found = common.materialise(named.join(ids, "root").select("fp", "component_id"), "components")
    return rows.join(found, "fp").select("doc_id", "fp", "component_id")


def keepers(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row of `docs` for each component of `found` (doc_id, cls, root, component_id), and rows without an id.

    It has the component's id; of several the one of the least text class stays, and of rows that share both the one of
    the least hash, so that reruns choose alike. Another component of the same id keeps a row of its own."""
    of = found.where("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("cls").alias("_cls"))
    named = docs.withColumn("_cls", common.text_class_of("text")).join(of, ["doc_id", "_cls"], "left_semi")
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns))
    kept = named.groupBy("doc_id", "_cls").agg(one.alias("_row")).select("_row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of `docs` whose doc_id names their component, one row for each; rows without an id all stay."""
    # near_duplicates answers by id, which may be repeated: texts get numbers of their own, and a number's component
    # is named afterwards
    texts = common.distinct_texts(docs).withColumn("node", F.monotonically_increasing_id())
    texts = common.materialise(texts, "texts")
    roots = near_duplicates(texts, k, "node").select(F.col("doc_id").alias("node"), F.col("component_id").alias("root"))
    named = common.materialise(texts.select("node", "cls", "first_id").join(roots, "node"), "named")
    low = common.materialise(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    found = common.materialise(named.join(low, "root").select("cls", "root", "component_id"), "found")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_class_of("text").alias("cls"))
    return keepers(docs, rows.join(found, "cls"))
