"""Hard negatives against brute force, and the spanning tree's bounds."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from duescore.llm import hard_negatives as hn


def brute(rows, positives=5, negatives=10, anchor=lambda i: i % 100 == 0):
    """Rows (id, vector, label) by plain loops over Python integers."""
    part = []
    for i, v, y in rows:
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v):
            part.append((i, y, [math.floor(256 * x) for x in v]))
    lengths = [len(q) for *_, q in part]
    most = min(sorted(set(lengths)), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    part = [(*r, k) for k, r in enumerate(part) if len(r[2]) == most]
    top = np.iinfo(np.int64)
    out = []
    for i, y, a, uid in part:
        if not anchor(i):
            continue
        scored = sorted((-max(top.min + 1, min(top.max, sum(p * q for p, q in zip(a, x)))), j, u, z) for j, z, x, u in part if u != uid)
        for s, j, *_ in [r for r in scored if r[3] == y][:positives]:
            hit = [r for r in scored if r[3] != y and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(i, j, k, r[1], -s, -r[0]) for k, r in enumerate(hit, 1)]
    return sorted(out)


def clustered(n, seed, groups=12, d=16, noise=0.2):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(groups, d))
    v = mid[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, d))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(int(i), [float(np.float32(x)) for x in v[i]], int(rng.integers(0, 3))) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, label int, uid string, score int"


def mined(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], schema)
    return sorted(map(tuple, hn.hard_negatives(df, F.col("id") % 100 == 0).collect()))


@pytest.mark.parametrize("blocks", [8_192, 4])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", blocks)
    monkeypatch.setattr(hn, "TREE_ANCHORS", 4)
    monkeypatch.setattr(hn, "CHUNK_ROWS", 100)
    rows = [(i * 20, v, y) for i, v, y in clustered(300, 5)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    base = [(i * 50, [float(i % 5), 1.0, -0.25], i % 2) for i in range(40)]
    odd = [
        (None, [1.0, 1.0, 1.0], 0), (100, None, 0), (200, [1.0, None, 1.0], 1), (300, [nan, 1.0, 1.0], 1), (400, [1.0, inf, 1.0], 0), (500, [1.0, 1.0], 0),
        (600, [], 1), (700, [1.0, 1.0, 1.0], None), (-100, [2.0, 1.0, 0.0], 1), (800, [0.0, 0.0, 0.0], 0),
    ]
    rows = base + odd + base[:7]  # repeated anchors, and ties everywhere
    assert mined(spark, rows) == brute(rows)


def test_very_large_components(spark):
    rows = [(i * 50, [float(2 ** (10 * (i % 4))) * 1.5, float(i), 3e18 if i == 9 else 1.0], i % 2) for i in range(20)]
    schema = SCHEMA.replace("float", "double")
    assert mined(spark, rows, schema) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(100, [1.0], 0)], [(100, [1.0], 0), (200, [1.0], 0)]])
def test_no_result(spark, rows):
    assert mined(spark, rows) == []


def test_half_of_the_rows_in_one_label_and_text_of_one_vector(spark):
    rows = clustered(240, 9)
    rows = [(i * 25, rows[0][1] if i % 2 else v, 1 if i % 2 else y) for i, v, y in rows]
    assert mined(spark, rows) == brute(rows)


def test_bounds_hold_and_leave_rows_out():
    rows = clustered(1200, 3, groups=6, noise=0.02)
    q = hn.whole_units(np.array([v for _, v, _ in rows]), 256.0)
    order, parent, edge, depth = hn.spanning_tree(q[:100])
    tree = hn.Tree(*(np.arange(100),) * 3, q[:100][order], parent, edge, depth)
    exact = hn.products(tree.vec, q)
    assert (parent[1:] < np.arange(1, 100)).all() and (depth[1:] == depth[parent[1:]] + 1).all()
    seen = []

    def wanted(level, low, high):
        assert (low <= exact[level]).all() and (exact[level] <= high).all()
        seen.append(level)
        return high >= 50_000

    score, known = tree.scores(q, wanted)
    assert (score[known] == exact[known]).all()
    assert known[exact >= 50_000].all()
    assert known.mean() < 0.5 and seen


def test_spanning_tree_is_minimal():
    v = np.random.default_rng(1).integers(-50, 50, (40, 3)).astype(float)
    _, _, edge, _ = hn.spanning_tree(v)
    dist = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2))
    inside, total = {0}, 0.0
    while len(inside) < 40:
        cost, k = min((dist[a, b], b) for a in inside for b in range(40) if b not in inside)
        inside.add(k)
        total += cost
    assert abs(edge.sum() - total) < 1e-9
