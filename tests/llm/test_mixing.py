import hashlib
import random

import pytest

from trackset.llm import mixing

from .conftest import make, words


def brute_targets(sizes):
    """Share out by weight; stop sources at twice their size and share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = 1.5 * sum(sizes.values()), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def size(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("n", [1, 2, 5, 9])
def test_targets(spark, n):
    rng = random.Random(n)
    for _ in range(4):
        sizes = {f"s{i}" if i else None: rng.choice((0, 3, 10, 500, 90_000)) for i in range(n)}
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        found = {r.source: r.target for r in mixing.targets(rows).collect()}
        assert found == pytest.approx(brute_targets(sizes))


def check(docs, rows):
    found = mixing.mix(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, *_ in rows)
    sizes, own = {}, {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
        own[i] = (size(t), s)
    target = brute_targets(sizes)
    taken, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in found:
        n, s = own[r.doc_id]
        assert (r.size, r.source_size) == (n, sizes[s]) and r.target == pytest.approx(target[s])
        assert r.taken in (0, n, 2 * n) and r.taken == n * r.copies
        taken[s] += r.taken
        largest[s] = max(largest[s], n)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, largest[s])
    assert {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(3)).collect()} == {(r.doc_id, r.taken) for r in found}


def test_mixes(spark, corpus, corpus_rows, no_docs):
    check(corpus, corpus_rows)
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randint(0, 40)), "en", rng.choice(["a", "b", "ü", "Z", None])) for i in range(800)]
    check(make(spark, rows), rows)
    assert mixing.mix(no_docs).count() == 0


def test_edge_rows(edge_docs, edge_rows):
    found = mixing.mix(edge_docs).collect()
    assert len(found) == len(edge_rows)
    texts = {}
    for i, t, _, s in edge_rows:
        texts.setdefault(i, []).append(size(t))
    assert all(r.size in texts[r.doc_id] and r.taken <= 2 * r.size for r in found)


def test_rows_come_as_often_as_they_are_taken(corpus):
    times = {r.doc_id: r.copies for r in mixing.mix(corpus).collect()}
    rows = mixing.mixed_rows(corpus)
    assert rows.columns == corpus.columns
    counts = {r.doc_id: r["count"] for r in rows.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in times.items() if n}


def test_hash_is_md5(spark):
    df = spark.createDataFrame([(5,), (None,)], "doc_id long").select("doc_id", mixing.id_hash().alias("h"))
    assert {r.doc_id: r.h for r in df.collect()} == {
        5: int(hashlib.md5(b"5").hexdigest()[:15], 16),
        None: int(hashlib.md5(b"").hexdigest()[:15], 16),
    }


def test_empty_documents_of_a_capped_source_come_as_often_as_it_does(spark):
    """The target is twice the source's size: nothing is left over, so no document comes a third time."""
    rng = random.Random(1)
    rows = [(i, words(rng, 40) if i % 2 else "", "en", "a" if i < 300 else "b") for i in range(400)] + [(900, words(rng, 90_000), "en", "c")]
    docs = make(spark, rows)
    found = mixing.mix(docs).collect()
    assert {r.copies for r in found if r.target == 2 * r.source_size} == {2}
    check(docs, rows)
    assert max(r["count"] for r in mixing.mixed_rows(docs.where("source <> 'c'").unionAll(docs.where("source = 'c'"))).groupBy("doc_id").count().collect()) == 2
