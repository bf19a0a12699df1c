"""Operator 2: embedding near-duplicates with a random-projection tree forest.

Equal vectors of one label are merged and stand for one point, with their number. The forest is fitted on a bounded
sample (SAMPLE points by the order of a hash): every level of a tree has one random direction, and every node splits at
the least crowded of a few random quantiles of its sample there. Points within the spill of a split go to both sides. The
spill is the standard deviation of the difference that two vectors at the threshold have along a random direction,
sqrt(2 (1 - COSINE) / components), so that a split parts such a pair with a probability of about 0.001 in any dimension.
A node where more than MOST_SPILLED of the sample would go to both sides is not split at this level, since that would
copy points and part none. Where a node has too little of the sample, the level's median serves. All points are routed
through all trees, which are as deep as the largest label needs for leaves of about LEAF_ROWS.

Points of one leaf and label are compared by cosine in double precision. A leaf of more than BLOCK_ROWS points (a cloud
of near copies cannot be split) is cut into blocks, and pairs of blocks are separate groups, so no task gathers more
than two blocks and no pair is left out. A pair that meets in several leaves counts in the first of them only. A group
returns its points' numbers of links and local components, never its pairs; components are then united over all groups.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, or whose label is null, have
no links and are their own component; vectors of different lengths never link; rows with a null id take no part and
come back with no links and a null component; repeated rows each get a row and link with each other; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .graph import connected_components

COSINE = 0.98
TREES = 4
SAMPLE = 16384
LEAF_ROWS = 32
MOST_SPILLED = 0.4
#: Random quantiles of a node's sample of which one becomes the split.
_TRIALS = 5
BLOCK_ROWS = 1500
#: Sample points that a node must have for a threshold of its own.
_LEAST = 32
_SEED = 20240607
#: Levels that the sample can reach.
_FITTED = SAMPLE.bit_length()


def units(packed: list[bytes], kind: str) -> np.ndarray:
    """Packed vectors as rows of length 1, in double precision."""
    x = np.frombuffer(b"".join(packed), kind).reshape(len(packed), -1).astype("f8")
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str, kind: str) -> DataFrame:
    """vec_id, label, digest and packed (components as `kind`); both are null for what links with nothing."""

    def run(batches):
        for batch in batches:
            digests, packed = [], []
            for cell in batch.column(2):
                digest = raw = None
                values = cell.values if cell.is_valid else None
                if values is not None and len(values) and not values.null_count:
                    x = np.asarray(values, kind)
                    if np.isfinite(x).all() and x.any():
                        raw = x.tobytes()
                        digest = hashlib.blake2b(raw, digest_size=16).digest()
                digests.append(digest)
                packed.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(packed, pa.binary())],
                ["vec_id", "label", "digest", "packed"],
            )

    rows = table.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vector_col
    )
    return common.map_arrow(rows, run, "vec_id long, label string, digest binary, packed binary", 4096)


def spill(size: int) -> float:
    """How far two vectors of `size` components at the threshold typically are from each other along a direction."""
    return math.sqrt(2 * (1 - COSINE) / size)


class Forest:
    def __init__(self, depth: int, sample: np.ndarray):
        self.depth, self.size = depth, sample.shape[1]
        self.middle = np.zeros((TREES, depth))
        #: Split by node; nan: the node is not split.
        self.nodes: list[dict[int, float]] = []
        rng = np.random.default_rng(_SEED)
        projected = sample @ self.directions(self.size)
        wide = spill(self.size)
        for tree in range(TREES):
            own: dict[int, float] = {}
            at = np.zeros(len(sample), "i8")
            for level in range(depth):
                p = projected[:, tree * depth + level]
                self.middle[tree, level] = np.median(p) if len(p) else 0.0
                cut = np.full(len(p), self.middle[tree, level])
                for node in np.unique(at):
                    inside = at == node
                    if inside.sum() >= _LEAST:
                        held = p[inside]
                        tried = np.quantile(held, rng.uniform(0.35, 0.65, _TRIALS))
                        both = (np.abs(held[:, None] - tried) <= wide).mean(axis=0)
                        best = int(np.argmin(both))
                        chosen = float(tried[best]) if both[best] <= MOST_SPILLED else math.nan
                        own[int(node) | 1 << level] = cut[inside] = chosen
                at |= (p > cut).astype("i8") << level
                # nodes are named by their path's bits under a leading 1 for the level
            self.nodes.append(own)

    def directions(self, size: int) -> np.ndarray:
        """One unit direction for each level of each tree."""
        d = np.random.default_rng([_SEED, size]).standard_normal((size, TREES * self.depth))
        return d / np.maximum(np.linalg.norm(d, axis=0), 1e-12)

    def leaves(self, x: np.ndarray) -> list[np.ndarray]:
        """The sorted leaf numbers of each row of x; the tree is part of a leaf's number."""
        projected = x @ self.directions(x.shape[1])
        fitted, wide = x.shape[1] == self.size, spill(x.shape[1])
        rows, numbers = [], []
        for tree in range(TREES):
            row, at = np.arange(len(x)), np.zeros(len(x), "i8")
            for level in range(self.depth):
                p = projected[row, tree * self.depth + level]
                cut = np.full(len(p), self.middle[tree, level] if fitted else 0.0)
                if fitted and self.nodes[tree]:
                    for node in np.unique(at) if level < _FITTED else ():
                        own = self.nodes[tree].get(int(node) | 1 << level)
                        if own is not None:
                            cut[at == node] = own
                # nothing is above a split that is not a number, and all is below
                low, high = ~(p > cut + wide), p > cut - wide
                row = np.concatenate((row[low], row[high]))
                at = np.concatenate((at[low], at[high] | 1 << level))
            rows.append(row)
            numbers.append(at | tree << 56)
        row, number = np.concatenate(rows), np.concatenate(numbers)
        order = np.lexsort((number, row))
        row, number = row[order], number[order]
        return np.split(number, np.searchsorted(row, np.arange(1, len(x))))


def routed(points: DataFrame, forest: Forest, kind: str) -> DataFrame:
    """node, label, m, packed, leaves of every point."""
    shared = points.sparkSession.sparkContext.broadcast(forest)  # directions and at most SAMPLE thresholds a tree

    def run(batches):
        for batch in batches:
            packed = batch.column(3).to_pylist()
            leaves: list = [None] * len(packed)
            sizes = np.array([len(u) for u in packed])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for i, found in zip(at, shared.value.leaves(units([packed[i] for i in at], kind))):
                    leaves[i] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int64()))], ["node", "label", "m", "packed", "leaves"]
            )

    rows = points.select("node", "label", "m", "packed")
    return common.map_arrow(rows, run, "node long, label string, m long, packed binary, leaves array<long>", 4096)


def _local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n points over the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def compare(group: pa.Table, kind: str) -> pa.Table:
    """Compare one group: all pairs if it has one block, else the pairs between its two blocks."""
    order = np.argsort(np.asarray(group["node"]), kind="stable")
    node, m, block = (np.asarray(group[c])[order] for c in ("node", "m", "block"))
    leaf, packed = group["leaf"][0].as_py(), group["packed"].to_pylist()
    pair = group["low"][0].as_py(), group["high"][0].as_py()
    x = units([packed[i] for i in order], kind)
    close = x @ x.T >= COSINE
    np.fill_diagonal(close, False)
    if pair[0] != pair[1]:
        close &= block[:, None] != block[None, :]
    i, j = np.nonzero(np.triu(close))
    root = _local_roots(len(order), i, j)
    # pairs that meet in an earlier leaf are counted there
    lists = group["leaves"].combine_chunks()
    counts = np.diff(np.asarray(lists.offsets))
    values, owner = np.asarray(lists.flatten()), np.repeat(np.arange(len(order)), counts)
    earlier = values < leaf
    if earlier.any() and len(i):
        names, column = np.unique(values[earlier], return_inverse=True)
        member = np.zeros((len(order), len(names)), "f4")
        member[owner[earlier], column] = 1
        member = member[order]
        close &= member @ member.T == 0
    return pa.table({"node": node, "n": (close @ m.astype("f8")).astype("i8"), "root": node[root]})


def links(points: DataFrame, forest: Forest, kind: str) -> DataFrame:
    """node, n (links to other points, each with its number), root: one row for each point and group."""
    rows = routed(points, forest, kind).withColumn("leaf", F.explode("leaves"))
    crowded = rows.groupBy("label", "leaf").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK_ROWS)
    crowded = common.materialise(crowded, "crowded-leaves")
    blocks = F.coalesce(F.ceil(F.col("size") / BLOCK_ROWS), F.lit(1)).cast("int")
    rows = rows.join(crowded, ["label", "leaf"], "left").withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    rows = rows.withColumn("bytes", F.octet_length("packed"))
    keys = ["label", "leaf", "bytes", "low", "high"]
    return (
        rows.select(*keys, "node", "m", "block", "packed", "leaves")
        .groupBy(*keys)
        .applyInArrow(lambda group: compare(group, kind), "node long, n long, root long")
    )


def near_duplicates(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id of every row."""
    # components travel as they come; all arithmetic is in double precision
    kind = "<f4" if isinstance(table.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    rows = common.materialise(vectors(table, id_col, vector_col, label_col, kind), "vectors")
    valid = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND digest IS NOT NULL")
    points = valid.groupBy("label", "digest").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("m"), F.first("packed").alias("packed")
    )
    # different vectors with one id share a node, and so their links
    points = common.materialise(points, "points")
    largest = points.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    depth = min(40, max(0, math.ceil(math.log2(max(1, largest) / LEAF_ROWS))))
    drawn = [r[0] for r in points.select("packed").orderBy(F.xxhash64("node", "label")).limit(SAMPLE).collect()]
    size = max(map(len, drawn), default=0, key=[len(r) for r in drawn].count)
    drawn = [r for r in drawn if len(r) == size]
    sample = units(drawn, kind) if drawn else np.empty((0, 1))
    found = common.materialise(links(points, Forest(depth, sample), kind), "leaf-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("node <> root").select("node", "root"), "node", "root")
    named = points.select("label", "digest", F.col("node"), "m").join(counts, "node", "left").join(roots, "node", "left")
    named = named.select(
        "label",
        "digest",
        (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    named = common.materialise(named, "components")
    linked = valid.join(named, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vec_id IS NULL OR label IS NULL OR digest IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionAll(alone)
