import random

import xxhash
from pyspark.sql import functions as F

from trackset.llm import graph, simhash, similar

from .conftest import make


def brute_fingerprint(text):
    ws = (text or "").encode().lower().split()
    sh = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    """fps: list of (doc_id, fp) -> smallest id reachable, for each row."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return [low.get(find(i)) for i in range(len(fps))]


def check(docs, rows):
    fps = [(i, brute_fingerprint(t)) for i, t, *_ in rows]
    expected = sorted(zip(fps, brute_components(fps)), key=str)
    found = [((r.doc_id, r.fp % (1 << 64)), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == expected


def test_documents_match_brute_force(edge_docs, edge_rows, corpus, corpus_rows, no_docs):
    check(edge_docs, edge_rows)
    check(corpus, corpus_rows)
    check(no_docs, [])


def test_every_close_pair_is_linked(spark):
    rng = random.Random(5)
    points = {rng.getrandbits(64) for _ in range(60)}
    for p in list(points):
        for _ in range(6):
            points.add(p ^ sum(1 << b for b in rng.sample(range(64), rng.choice((1, 2, 2, 3)))))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    df = spark.createDataFrame(signed, "fp long")
    found = {tuple(r) for r in simhash.links(df).distinct().collect()}
    expected = {(a, b) for (a,) in signed for (b,) in signed if a < b and 1 <= ((a ^ b) % (1 << 64)).bit_count() <= 2}
    assert found == expected


def test_homes_are_within_one_and_visits_within_two(spark):
    rng = random.Random(6)
    halves = [rng.getrandbits(32) for _ in range(50)]
    df = spark.createDataFrame([(h,) for h in halves], "fp long")
    home = {(r.fp, r.anchor) for r in simhash.homes(df).collect() if r.anchor < 1 << 32}
    visits = [(r.fp, r.anchor) for r in simhash.visits(df).collect() if r.anchor < 1 << 32]
    assert all((f ^ a).bit_count() <= 1 for f, a in home) and all((f ^ a).bit_count() <= 2 for f, a in visits)
    assert len(visits) == len(set(visits)) and home <= set(visits)
    assert {sum(f == h for f, _ in visits) for h in set(halves)} <= {2, 17}


def test_components_of_long_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(chain + hub + [(5, 5), (7, 6)], "a long, b long")
    found = {r.node: r.root for r in graph.connected_components(df).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 300)}
    assert graph.connected_components(df.where("a < 0")).count() == 0


def test_one_of_each_group_stays(spark, corpus, corpus_rows):
    fps = [(i, brute_fingerprint(t)) for i, t, *_ in corpus_rows]
    kept = {r.doc_id for r in simhash.one_of_each(corpus).select("doc_id").collect()}
    assert kept == {i for (i, _), c in zip(fps, brute_components(fps)) if i == c}
    rows = [(None, "a b c d", "en", "x"), (None, "a b c d", "en", "x"), (1, "q r s t", "en", "x"), (1, "q r s t", "en", "x")]
    left = simhash.one_of_each(make(spark, rows)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    assert {(r.doc_id, r.n) for r in left.collect()} == {(None, 2), (1, 1)}


def test_texts_that_share_an_id_stay_apart(spark):
    far, other, third = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(7, far, "en", "x"), (7, other, "en", "x"), (7, far, "de", "y"), (9, other, "en", "x"), (7, third, "en", "x"), (3, third, "en", "x")]
    for module in (simhash, similar):
        kept = [module.one_of_each(make(spark, r).repartition(3)).collect() for r in (rows, rows[::-1])]
        assert sorted((r.doc_id, r.text) for r in kept[0]) == sorted([(7, far), (7, other), (3, third)])
        assert sorted(kept[0]) == sorted(kept[1])
