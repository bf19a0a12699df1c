import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackset.llm import common, similar

from .conftest import make, words
from .test_pipeline import first_of_components as brute
from .test_pipeline import shingles


@pytest.fixture(scope="module")
def near_rows():
    """Copies with a few words changed around 0.8, a crowd of copies of one text, and a phrase that most texts hold."""
    rng, phrase, hot = random.Random(23), words(random.Random(1), 30), words(random.Random(2), 120, 9000)
    rows = []
    for i in range(120):
        text = (words(rng, rng.randint(4, 150), 9000) if i % 4 else hot) + (f" {phrase}" if i % 3 else "")
        rows.append((5 * i, text, "en", "s"))
        ws = text.split()
        for at in rng.sample(range(len(ws)), min(len(ws), rng.randint(0, 6))):
            ws[at] = f"new{i}x{at}"
        rows.append((5 * i + 1, " ".join(ws), "en", "s"))
    return rows


def test_near_dedup_is_exact_at_four_fifths(spark, near_rows):
    out = corpus_pipeline.near_dedup(spark, make(spark, near_rows).repartition(5), "")
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == brute(near_rows)


def test_crowds_without_a_sample_and_odd_rows(spark, near_rows, edge_docs, edge_rows, corpus, corpus_rows, monkeypatch):
    monkeypatch.setattr(similar, "FREQUENT", 1 << 40)
    monkeypatch.setattr(similar, "TRIED", ())
    for docs, rows in ((make(spark, near_rows), near_rows), (edge_docs, edge_rows), (corpus, corpus_rows)):
        found = {r.doc_id for r in similar.one_of_each(docs).select("doc_id").collect()}
        assert sorted(found - {None}) == brute(rows)


def met(spark, texts):
    """Members of the crowds of texts that no link has joined yet, and pairs of them that the last round looks at."""
    nodes = spark.createDataFrame(list(enumerate(texts)), "node long, text string").withColumn("cls", F.unhex(F.sha2("text", 256)))
    members = similar.crowds(common.materialise(similar.placed(nodes, 5), "places"))
    pairs = similar.between_components(members.withColumn("root", F.col("node")), None)
    return members, [(r.a, r.b) for r in pairs.collect()]


def alike(texts):
    sets = [shingles(t) for t in texts]
    return {(i, j) for j in range(len(sets)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}


def changed(ws, places, name):
    return " ".join(f"{name}x{at}" if at in places else w for at, w in enumerate(ws))


@pytest.mark.parametrize("before", [1, 100])
def test_pairs_of_many_crowds_are_met_in_the_first(spark, monkeypatch, before):
    monkeypatch.setattr(similar, "BEFORE", before)
    rng, base = random.Random(41), [f"b{i}" for i in range(150)]
    texts = [changed(base, set(rng.sample(range(150), 1 + i % 3)), f"n{i}") for i in range(30)]
    members, pairs = met(spark, texts)
    assert members.groupBy("node").count().where("count > 5").count() > 20
    assert alike(texts) <= set(pairs)
    assert len(pairs) == len(set(pairs)) or before == 1


def test_long_texts_that_are_half_alike_make_no_pairs(spark):
    rng = random.Random(43)
    groups = [[f"g{g}w{i}" for i in range(n)] for g, n in enumerate((2040, 4000, 9000))]
    texts = [changed(g, set(rng.sample(range(len(g)), len(g) // 16)), f"n{i}") for g in groups for i in range(6)]
    # similar ones on either side of a power of two, which have parities of two lengths
    texts += [" ".join(groups[0]), " ".join(groups[0] + [f"end{i}" for i in range(60)])]
    _, pairs = met(spark, texts)
    assert alike(texts) == set(pairs) and pairs


def test_parities_never_differ_at_more_places_than_sets(spark):
    rng, rows = np.random.default_rng(47), []
    for n in (1, 60, 1000, 1024, 1025, 1200, 2000, 16_300, 17_000, 40_000):
        for gone, new in ((0, 0), (1, 0), (n // 5, 0), (0, n // 4), (n // 9, n // 9)):
            x = np.unique(rng.integers(0, 1 << 64, n, "u8"))
            y = np.unique(np.concatenate([x[: len(x) - gone], rng.integers(0, 1 << 64, new, "u8")]))
            rows += [(p.tolist(), q.tolist(), len(np.setxor1d(x, y))) for p, q in [map(similar.parities, (x, y))]]
    assert {len(p) for p, _, _ in rows} == {8, 16, 128, 256}
    found = spark.createDataFrame(rows, "x array<long>, y array<long>, differ long")
    found = found.select("differ", similar._differing(F.col("x"), F.col("y")).alias("places")).collect()
    assert all(r.places <= r.differ and r.places % 2 == r.differ % 2 for r in found)
