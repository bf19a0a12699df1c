import math

import numpy as np
import pytest

from trackset.llm import forest

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, leaf long, node int"


def clouds(rng, n, size=32, spread=0.012):
    """Loose points, and clouds of near copies of different tightness."""
    base = rng.standard_normal((n, size))
    out = [x for x in base]
    for x in base[:: max(1, n // 12)]:
        length = np.linalg.norm(x)
        out += [x + rng.standard_normal(size) * length * spread * rng.uniform(0.5, 2.5) for _ in range(9)]
    return np.array(out, "f4")


def brute(rows):
    valid = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or label is None or not v or any(c is None or not math.isfinite(c) for c in v) or not any(v):
            continue
        x = np.array(v, "f8") / np.max(np.abs(v))
        valid.append((k, label, x / np.linalg.norm(x)))
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, (i, la, x) in enumerate(valid):
        for j, lb, y in valid[:a]:
            if la == lb and len(x) == len(y) and x @ y >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            low[find(k)] = min(r[0], low.get(find(k), r[0]))
    return sorted(((r[0], links[k], low.get(find(k)) if r[0] is not None else None) for k, r in enumerate(rows)), key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "u", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in forest.near_duplicates(df).collect()), key=str)


@pytest.mark.parametrize("leaf,block", [(1000, 1500), (32, 1500), (8, 40)])
def test_matches_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(forest, "LEAF_ROWS", leaf)
    monkeypatch.setattr(forest, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    x = clouds(rng, 240)
    x = np.concatenate((x, np.repeat(x[:3], 5, axis=0), x[5:6] * 3))
    rows = [(int(i), v.tolist(), int(i) % 2 if i < 200 else 1) for i, v in enumerate(x)]
    assert got(spark, rows) == brute(rows)


def test_edge_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
        (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1),
        (None, v, 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0, 6.0], 1), (13, [-1.0, -2.0, -3.0], 1), (2, v, 1),
        (14, [3e38, 3e38, 3e38], 3), (15, [1e-30, 1e-30, 1e-30], 3),
    ]
    expected = brute(rows)
    # rows that share an id are one point of the graph but link with each other
    assert got(spark, rows) == expected


def test_empty_table(spark):
    assert got(spark, []) == []


def test_leaves_hold_close_points_together():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    trees = forest.Forest(4, x[:1500])
    y = x + rng.standard_normal(x.shape) * 0.19 / 8  # distances of about 0.19, near the threshold
    y /= np.linalg.norm(y, axis=1)[:, None]
    met = [bool(set(a) & set(b)) for a, b in zip(trees.leaves(x), trees.leaves(y))]
    assert np.mean(met) > 0.999
    held = np.bincount(np.concatenate(trees.leaves(x)) & 0xFFFF)
    assert held.max() < 0.25 * len(x) * forest.TREES


@pytest.mark.parametrize("size", [2, 3, 4, 8, 16, 64, 256])
def test_recall_and_copies_in_any_dimension(size):
    """Pairs just above the threshold meet in a leaf, and no dimension makes points multiply level by level."""
    rng = np.random.default_rng(size)
    x = rng.standard_normal((6000, size))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = 0.981 * x + math.sqrt(1 - 0.981**2) * side
    depth = 8
    trees = forest.Forest(depth, x[:4096])
    a, b = trees.leaves(x), trees.leaves(y)
    met = np.mean([bool(set(p) & set(q)) for p, q in zip(a, b)])
    assert met >= 0.999
    copies = np.mean([len(p) for p in a]) / forest.TREES
    assert copies < 1.4**depth


def test_the_forest_splits_small_tables(spark):
    """The production leaf size gives splits at a hundred vectors of a label."""
    rng = np.random.default_rng(3)
    x = clouds(rng, 90)
    rows = [(int(i), v.tolist(), 1) for i, v in enumerate(x)]
    assert len(x) > 2 * forest.LEAF_ROWS
    assert got(spark, rows) == brute(rows)
