"""Near-duplicates by exact Jaccard similarity of word shingles, for stages that need more than op7's two bits.

Texts are linked if their sets of SHINGLE_WORDS-word shingles have a similarity of SIMILAR or more. At this similarity
about 10 of 64 bits of a fingerprint are expected to differ, which no affordable covering of fingerprints reaches. The
anchors are shingles instead: with the shingles of every text in one global order, two similar texts share one among the
first n - ceil(SIMILAR n) + 1 of each (n: the text's shingles), so every linked pair meets at an anchor. Candidates come
from close fingerprints and from anchors. A sketch of each text (its shingles counted by bucket) bounds from above what
two of them share and rules out most candidates; the rest are verified by their exact similarity.

The order puts shingles that are frequent in a sample last and is by hash otherwise. Any order finds every pair; this
one keeps common phrases from being anchors. A crowd at an anchor is first compared with one of its members, then those
outside its largest component with a few of that component, and with more; after that all members whose components still
differ are compared, so that no link between components is missed and few pairs within one are looked at. Texts that
are less alike meet in many crowds all the same: a pair is then looked at in the first of them, and parities of
about as many places as a text has shingles tell how much two texts differ before the pair is made.

Defined results: as for simhash; equal texts are merged before, null and empty texts are alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, simhash
from .graph import connected_components

SHINGLE_WORDS = 5
#: Numerator and denominator of the least similarity.
SIMILAR = (4, 5)
#: Texts of the sample that orders shingles, and in how many of them a frequent shingle is.
SAMPLE, FREQUENT = 10_000, 3
#: Longs of the parities that a candidate's differences are counted on: a bit for each one or two shingles, within these.
PARITY_LONGS = (8, 256)
#: Crowds of a text before one in which it is told that a pair has met already.
BEFORE = 8
#: Members of a crowd's largest component that those outside are compared with, round by round, before all are.
TRIED = (12, 48)


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; texts without words have one in common."""
    return _distinct(list(simhash.shingle_hashes(text, k)))


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(1, "u8")


def frequent_shingles(texts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the shingles that come in FREQUENT texts of the sample or more."""
    share = min(1.0, SAMPLE / max(1, texts.count()))
    sample = texts.where(F.pmod(F.xxhash64("cls"), F.lit(1 << 20)) < share * (1 << 20))

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t, k) for t in batch.column(0).to_pylist()]
            found, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view("i8")), pa.array(n)], ["h", "n"])

    counts = common.map_arrow(sample.select(F.col("text").cast("binary")), run, "h long, n long")
    table = counts.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).toPandas()  # of the sample
    found = table["h"].to_numpy("i8").view("u8")
    order = np.argsort(found)
    return found[order], table["n"].to_numpy("i8")[order]


def sketch(own: np.ndarray) -> bytes | None:
    """How many of a text's shingles fall into each of about n/2 buckets (a power of two, by the low bits), a byte each."""
    size = 1 << max(3, int(len(own) - 1).bit_length() - 1)
    counts = np.bincount((own & np.uint64(size - 1)).astype("i8"), minlength=size)
    return counts.astype("u1").tobytes() if counts.max() < 256 else None


def parities(own: np.ndarray) -> np.ndarray:
    """On which places (a power of two, by the low bits of what follows the 40th) an odd number of shingles falls."""
    least, most = PARITY_LONGS
    size = 64 * min(most, max(least, 1 << (len(own) // 64).bit_length() >> 1))
    counts = np.bincount(((own >> np.uint64(40)) & np.uint64(size - 1)).astype("i8"), minlength=size)
    return np.packbits((counts & 1).astype("u1")).view("<i8")


def at_most_shared(x: bytes, y: bytes) -> int:
    """No more shingles than this can two sketched texts share."""
    a, b = sorted((np.frombuffer(x, "u1").astype("i8"), np.frombuffer(y, "u1").astype("i8")), key=len)
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(axis=0)).sum())


def placed(texts: DataFrame, k: int) -> DataFrame:
    """node, fp, n (shingles), anchors (the first shingles in the global order, as many as two similar texts need), sketch, bits."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent_shingles(texts, k))
    over, under = SIMILAR

    def run(batches):
        often, counts = shared.value
        for batch in batches:
            fps, sizes, anchors, sketches, bits = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                parts = list(simhash.shingle_hashes(text, k))
                own = _distinct(parts)
                rank = np.zeros(len(own), "i8")
                if len(often):
                    at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                    rank = np.where(often[at] == own, counts[at], 0)
                need = -(-over * len(own) // under)
                first = np.lexsort((own, rank))[: len(own) - need + 1]
                fps.append(simhash.majority(parts))
                sizes.append(len(own))
                anchors.append(own[first].view("i8"))
                sketches.append(sketch(own))
                bits.append(parities(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.array(fps, "u8").view("i8")),
                    pa.array(sizes, pa.int64()),
                    pa.array(anchors, pa.list_(pa.int64())),
                    pa.array(sketches, pa.binary()),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["node", "fp", "n", "anchors", "sketch", "bits"],
            )

    rows = texts.select("node", F.col("text").cast("binary").alias("text"))
    return common.map_arrow(rows, run, "node long, fp long, n long, anchors array<long>, sketch binary, bits array<long>")


def crowds(places: DataFrame) -> DataFrame:
    """anchor, node, n, pos, before, bits of the anchors that two texts or more have, without those that cannot be similar to any of
    the others by their lengths and by what is left of them from the anchor on.

    Near copies share most of their anchors. Anchors with the same members (by number and two hashes) are one crowd, in
    which a text has its first place among them, so that a pair is met once and not at each anchor. `before` holds the
    text's last BEFORE crowds before this one; by place, crowds are in the same order in every text."""
    over, under = SIMILAR
    members = places.select("node", "n", F.posexplode("anchors").alias("pos", "anchor"))
    left = F.col("n") - F.col("pos")
    same = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    often = members.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("m"), F.min("n").alias("low"), F.max(left).alias("most"), F.sum("n").alias("s"), F.min(left).alias("least"), *same
    )
    # two alone are tried at once
    often = often.where((F.col("m") > 2) | (F.col("m") == 2) & ((over + under) * F.col("least") >= over * F.col("s")))
    often = common.materialise(often.select("anchor", "m", "x1", "x2", "low", "most"), "crowded")
    named = often.groupBy("m", "x1", "x2").agg(F.min("anchor").alias("crowd"), F.min("low").alias("low"), F.max("most").alias("most"))
    # written, so that the join exchanges both sides and Spark can split a frequent anchor
    names = often.select("anchor", "m", "x1", "x2").join(named, ["m", "x1", "x2"]).select("anchor", "crowd", "low", "most")
    names = common.materialise(names, "crowd-names")
    common.discard(often)
    met = members.join(names, "anchor").groupBy("crowd", "node").agg(
        F.max("n").alias("n"), F.min("pos").alias("pos"), F.min("low").alias("low"), F.max("most").alias("most")
    )
    enough = (over + under) * F.least(left, F.col("most")) >= over * (F.col("n") + F.col("low"))
    met = met.where(enough).select(F.col("crowd").alias("anchor"), "node", "n", "pos")
    earlier = Window.partitionBy("node").orderBy("pos").rowsBetween(-BEFORE, -1)
    met = met.withColumn("before", F.collect_list("anchor").over(earlier))
    out = met.join(places.select("node", "bits"), "node").select("anchor", "node", "n", "pos", "before", "bits")
    out = common.materialise(out, "crowds")
    common.discard(names)
    return out


def _differing(x, y):
    """Places whose parities differ, on as many as the shorter has: the halves of one that has twice as many are added."""
    size = F.least(F.size(x), F.size(y))
    added = lambda p, q: p.bitwiseXOR(q)
    at_size = lambda p: F.when(F.size(p) == size, p).otherwise(F.zip_with(F.slice(p, 1, size), F.slice(p, size + 1, size), added))
    return F.aggregate(F.zip_with(at_size(x), at_size(y), added), F.lit(0), lambda n, p: n + F.bit_count(p))


def _may_be_similar(a: str, b: str):
    """What is left of both from their first shared shingle on is enough, so that one has five fourths of the other's at
    most, and few enough parities differ: each that does is of a shingle that only one of them has, and similar texts
    have a ninth of all at most."""
    over, under = SIMILAR
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    differ = _differing(F.col(f"{a}.bits"), F.col(f"{b}.bits"))
    return ((over + under) * left >= over * both) & ((over + under) * differ <= (under - over) * both)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def with_one_of_each_crowd(members: DataFrame, salt: int) -> DataFrame:
    """a, b: every member of a crowd beside one of its members, which differs by anchor and by salt."""
    one = F.min_by(F.struct("node", "n", "pos", "root", "bits"), F.xxhash64("node", "anchor", F.lit(salt)))
    hubs = common.materialise(members.groupBy("anchor").agg(one.alias("h")).select("anchor", "h.*"), "hubs")
    h, m = hubs.alias("h"), members.alias("m")
    on = (F.col("h.anchor") == F.col("m.anchor")) & (F.col("h.root") != F.col("m.root")) & _may_be_similar("h", "m")
    return _ordered(m.join(h, on).select(F.col("h.node").alias("a"), F.col("m.node").alias("b")))


def between_components(members: DataFrame, most: int | None, salt: int = 0) -> DataFrame:
    """a, b: pairs of a crowd whose components differ, each with one outside the crowd's largest: with about `most`
    members of the largest, or, if that is None, with all others of the crowd. Two that have met in an earlier crowd are
    left to it: similar texts pass all conditions in the first that they share."""
    parts = members.groupBy("anchor", "root").agg(F.count(F.lit(1)).alias("m"))
    top = F.max(F.struct("m", "root"))
    main = parts.groupBy("anchor").agg(top.alias("top"), F.count(F.lit(1)).alias("p")).where("p > 1")
    main = common.materialise(main.select("anchor", F.col("top.root").alias("main"), F.col("top.m").alias("m")), "main-components")
    all_of = common.materialise(members.join(main, "anchor"), "mixed-crowds")
    a, b = all_of.where("root <> main"), all_of
    if most is not None:
        b = b.where((F.col("root") == F.col("main")) & (F.pmod(F.xxhash64("node", F.lit(salt)), F.ceil(F.col("m") / most)) == 0))
    a, b = a.alias("a"), b.alias("b")
    on = (F.col("a.anchor") == F.col("b.anchor")) & (F.col("a.root") != F.col("b.root"))
    on = on & ~F.arrays_overlap("a.before", "b.before") & _may_be_similar("a", "b")
    once = (F.col("b.root") == F.col("b.main")) | (F.col("a.node") < F.col("b.node"))
    return _ordered(a.join(b, on & once).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))


def likely(pairs: DataFrame, places: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches allow them to be similar: all similar pairs are among them."""
    over, under = SIMILAR

    def run(batches):
        for batch in batches:
            good = []
            for x, y, n, m in zip(*(batch.column(c).to_pylist() for c in ("x", "y", "nx", "ny"))):
                both = min(n, m) if x is None or y is None else at_most_shared(x, y)
                good.append(under * both >= over * (n + m - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = places.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("nx"))
    two = places.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("ny"))
    # by length first, which needs no sketch
    near = (over * F.col("nx") <= under * F.col("ny")) & (over * F.col("ny") <= under * F.col("nx"))
    return common.map_arrow(pairs.join(one, "a").join(two, "b").where(near), run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, places: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) that are similar. Sketches rule out most; the shingle sets of the others alone are compared."""
    over, under = SIMILAR

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(under * both >= over * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    pairs = common.materialise(pairs.distinct(), "candidates")
    open_ = common.materialise(likely(pairs, places), "likely")
    common.discard(pairs)
    nodes = open_.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = common.materialise(hashed_sets(texts.join(nodes, "node", "left_semi"), k), "shingle-sets")
    one = open_.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    links = common.materialise(common.map_arrow(two.select("a", "b", "x", "y"), run, "a long, b long"), "similar")
    common.discard(open_, sets)
    return links


def hashed_sets(texts: DataFrame, k: int) -> DataFrame:
    """node, hashes: the shingle set of each text, packed."""

    def run(batches):
        for batch in batches:
            packed = [shingle_set(t, k).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["node", "hashes"])

    return common.map_arrow(texts.select("node", F.col("text").cast("binary")), run, "node long, hashes binary")


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, cls (of the text), root (tells components apart), component_id (smallest id reachable over links) of every row."""
    texts = common.distinct_texts(docs, id_col, text_col).withColumn("node", F.monotonically_increasing_id())
    texts = common.materialise(texts, "texts")
    places = common.materialise(placed(texts, k), "places")
    members = crowds(places)
    # texts of one fingerprint are paired with the first of them, and the firsts of close fingerprints with each other
    points = common.materialise(places.groupBy("fp").agg(F.min("node").alias("node")), "points")
    near = simhash.links(points.select("fp"))
    name = lambda c: points.select(F.col("fp").alias(c), F.col("node").alias(f"n{c}"))
    close = near.join(name("a"), "a").join(name("b"), "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    equal = places.select("fp", "node").join(points.withColumnRenamed("node", "low"), "fp").where("node <> low")
    close = _ordered(close).unionAll(equal.select(F.col("low").alias("a"), F.col("node").alias("b")))
    close = common.materialise(close, "close")
    links = verified(close, texts, places, k)
    common.discard(points, close)
    for step, most in enumerate((1, *TRIED, None)):
        roots = common.materialise(connected_components(links, rounds=2), "roots")
        now = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        now = common.materialise(now, "members")
        pairs = between_components(now, most, step) if step else with_one_of_each_crowd(now, step)
        links = links.unionAll(verified(pairs, texts, places, k))
        common.discard(now, roots)
    roots = connected_components(links)
    named = texts.select("node", "cls", "first_id").join(roots, "node", "left")
    named = common.materialise(named.withColumn("root", F.coalesce("root", "node")), "named")
    low = common.materialise(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    found = common.materialise(named.join(low, "root").select("cls", "root", "component_id"), "found")
    common.discard(texts, members, places, named, low)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_class_of(text_col).alias("cls"))
    return rows.join(found, "cls").select("doc_id", "cls", "root", "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of `docs` whose doc_id names their component, one row for each; rows without an id all stay."""
    return simhash.keepers(docs, near_duplicates(docs, k))
