"""Embedding near-dedup against brute force; balls, graph, search and verification alone."""

import math

import numpy as np
import pytest

from duescore.llm import vector_dedup as vd


def brute(rows, least=0.95):
    """(id, n_links, component, kept) by all pairs."""
    def usable(i, v):
        return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    lengths = [len(v) for i, v in rows if usable(i, v)]
    most = min(sorted(set(lengths)), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    part = [k for k, (i, v) in enumerate(rows) if usable(i, v) and len(v) == most]
    root, links = list(range(len(rows))), [0] * len(rows)
    if part:
        u = np.array([rows[k][1] for k in part], float)
        u /= np.abs(u).max(1, keepdims=True)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        s = u @ u.T >= least
        for a, k in enumerate(part):
            links[k] = int(s[a].sum()) - 1

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for a, b in zip(*np.nonzero(s)):
            x, y = find(part[a]), find(part[b])
            root[max(x, y)] = min(x, y)
        groups = {}
        for k in part:
            groups.setdefault(find(k), []).append(rows[k][0])
        first = {k: min(groups[find(k)]) for k in part}
    else:
        first = {}
    return sorted(repr((i, links[k], first.get(k, i), first.get(k, i) == i)) for k, (i, _) in enumerate(rows))


def groups(sizes, alone, noise, d=24, seed=1):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=(alone, d))]
    for size in sizes:
        mid = rng.normal(size=d)
        out.append(mid / np.linalg.norm(mid) + noise / math.sqrt(d) * rng.normal(size=(size, d)))
    v = np.concatenate(out)
    v = v[rng.permutation(len(v))]
    return v / np.linalg.norm(v, axis=1, keepdims=True)


SCHEMA = "vec_id long, embedding array<float>, label int, node string, ball int"


def deduped(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], schema)
    return sorted(repr(tuple(r)) for r in vd.embedding_dedup(df).collect())


def as_rows(vec, step=3):
    return [(step * i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vec)]


@pytest.mark.parametrize("noise", [0.1, 0.25, 0.32])
def test_groups_against_brute_force(spark, noise):
    rows = as_rows(groups([2, 3, 5, 200], 300, noise))
    assert deduped(spark, rows) == brute(rows)


def test_small_shards_parts_and_cells(spark, monkeypatch):
    for name, value in (("SHARD_ROWS", 60), ("PIECE_ROWS", 50), ("GRAPH_ROWS", 40), ("CELL_ROWS", 30), ("HOT_ROWS", 10)):
        monkeypatch.setattr(vd, name, value)
    rows = as_rows(groups([2] * 20 + [150], 200, 0.15, seed=4))
    rows += [(10_000 + i, rows[5][1]) for i in range(40)]
    assert deduped(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = as_rows(groups([3], 10, 0.1, d=3))
    odd = [(None, [1.0, 2.0, 3.0]), (1, None), (2, []), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 1.0]), (7, [nan, 1.0, 1.0]), (8, [inf, 1.0, 1.0]),
           (10, [1.0, 2.0]), (11, [1e30, 2e30, 0.0]), (11, [1e-30, 2e-30, 0.0]), (11, [1e30, 2e30, 0.0]), (-4, [1.0, 2.0, 0.0]), (13, [-1.0, -2.0, 0.0])]
    assert deduped(spark, rows + odd) == brute(rows + odd)
    for few in ([], [(1, None)], [(1, [1.0])], [(None, [1.0])], [(2, [1.0]), (1, [3.0])]):
        assert deduped(spark, few) == brute(few)


@pytest.mark.parametrize("noise", [0.0, 0.1, 0.2, 0.35, 1.0])
def test_members_of_a_ball_link(noise):
    vec = groups([120, 40], 100, noise, seed=2)
    ball, turn, centres = vd.balls(vec, 0.95)
    assert (ball >= 0).all()
    assert np.allclose(vd.angle((vec * centres[ball]).sum(1)), turn, atol=1e-6)
    for b in np.unique(ball):
        mine = vec[ball == b]
        assert (mine @ mine.T >= 0.95).all()
    if noise <= 0.1:  # members about 6 degrees from the middle, within half the linking angle
        assert len(centres) < 130


def test_dense_group_is_few_balls():
    vec = groups([2000], 0, 0.1, d=64)
    assert len(vd.balls(vec, 0.95)[2]) == 1


def test_graph_search_finds_near_rows():
    vec = groups([2] * 100 + [30], 1500, 0.2, d=48, seed=6)
    graph = vd.flat_graph(vec)
    assert (graph >= 0).any(1).all() and (graph != np.arange(len(vec))[:, None]).all()
    theta = math.acos(0.95)
    a, b = vd.range_search(vec, np.full(len(vec), theta), vec, np.zeros(len(vec)), graph)
    want = set(zip(*np.nonzero(vec @ vec.T >= 0.95)))
    assert set(zip(a.tolist(), b.tolist())) <= want
    assert len(set(zip(a, b)) & want) >= 0.99 * len(want)


def test_beam_grows_over_a_large_range():
    vec = groups([700], 300, 0.3, d=16, seed=7)
    a, _ = vd.range_search(vec[:50], np.full(50, 0.8), vec, np.zeros(len(vec)), vd.flat_graph(vec), 8)
    want = (vd.angle(vec[:50] @ vec.T) <= 0.8).sum()
    assert want > 50 * 300 and len(a) >= 0.99 * want


@pytest.mark.parametrize("seed", range(6))
def test_verification_by_angles(seed):
    rng = np.random.default_rng(seed)
    vec = groups([60], 30, 0.15 + 0.05 * seed, d=8, seed=seed)
    centre = vd.unit(vec.mean(0)[None])[0]
    turn = vd.angle(vec @ centre)
    big = np.argsort(turn)[: 20 + 5 * seed]
    small = np.setdiff1d(np.arange(len(vec)), big)
    w, x = rng.integers(1, 5, len(big)), rng.integers(1, 5, len(small))
    to_big, to_small = vd.linked(vec[big], turn[big], w, centre, vec[small], x, 0.95)
    near = vec[big] @ vec[small].T >= 0.95
    assert (to_big == near @ x).all() and (to_small == w @ near).all()


def test_audit_sees_missing_links(spark):
    rows = as_rows(groups([20], 50, 0.1))
    nodes = vd.vector_nodes(vd.staged(vd.vector_rows(spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA), "vec_id", "embedding"), "t"))
    nodes = vd.staged(nodes, "t")
    none = nodes.select("node", vd.F.lit(0).alias("n_links"))
    some = nodes.select("node", vd.F.lit(100).alias("n_links"))
    assert vd.audited_recall(nodes, none, 24, 0.95) == 0.0
    assert vd.audited_recall(nodes, some, 24, 0.95) == 1.0
