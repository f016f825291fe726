"""SimHash near-dedup and Hilbert sharding against brute force."""

import re
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duescore.llm import sharding, simhash
from duescore.llm.components import connected_components
from duescore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None), (2, ""), (3, "one"), (4, "ONE"), (5, "one two three four five"), (5, "one two three four five"), (6, "x " * 60_000),
    (7, "one  two\tthree\nfour five"), (None, "É é"), (8, "É é"), (9, " \n"),
]


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))
    if not w:
        return 0
    h = np.array([xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(len(w) - 2, 1))], np.uint64)
    return sum(1 << b for b in range(64) if ((h >> np.uint64(b)) & np.uint64(1)).sum() * 2 > len(h))


def labels(fps, radius=3):
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
    lab = np.arange(len(fps))
    while True:
        new = np.where(near, lab[None], len(fps)).min(1)
        if (new == lab).all():
            return lab
        lab = new


def expected(rows):
    fps = np.array([fingerprint(t) for _, t in rows], np.uint64)
    lab = labels(fps)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(lab == lab[k]) if rows[j][0] is not None]
        out.append((i, f"{int(fps[k]):016x}", min(ids, default=None)))
    return sorted(map(repr, out))


def test_components_against_brute_force(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 as fp", "'r' as root", "2 as node")
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        want = expected([(r.doc_id, r.text) for r in df.collect()])
        out = simhash.simhash_components(df).select("doc_id", "fingerprint", "component_id")
        assert sorted(repr(tuple(r)) for r in out.collect()) == want


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_balls_lose_no_link(spark, radius):
    rng = np.random.default_rng(radius)
    centre = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = [int(c) for c in centre]
    for c in centre:
        for _ in range(25):  # pairs at every distance up to five, in any blocks of bits
            fps.append(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False)))
            fps.append(fps[-1] ^ 7 << int(rng.integers(0, 61)))
    fps = np.unique(np.array(fps, np.uint64))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r.node: r.root for r in simhash.fingerprint_components(df, radius).collect()}
    root = np.array([got.get(int(x), int(x)) for x in fps.view(np.int64)])
    lab = labels(fps, radius)
    assert len(set(zip(root.tolist(), lab.tolist()))) == len(set(lab.tolist())) == len(set(root.tolist()))


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 2), st.integers(2, 80))
def test_large_runs_by_sorting(seed, block, n):
    """Linking a run without pairs gives the components that pairs and the other blocks give."""
    rng = np.random.default_rng(seed)
    mask = simhash.block_masks(3)[block]
    inside = [b for b in range(64) if mask >> b & 1]
    outside = [b for b in range(64) if not mask >> b & 1]
    fps = set()
    for _ in range(n):
        v = sum(1 << int(b) for b in rng.choice(inside[:7], rng.integers(0, 5), replace=False))
        fps.add(v ^ (1 << int(rng.choice(outside)) if rng.random() < 0.5 else 0))
    fps = np.array(sorted(fps), np.uint64)
    small = simhash.linked(fps, mask, 3)
    old, simhash.MATRIX = simhash.MATRIX, 0
    try:
        large = simhash.linked(fps, mask, 3)
        assert len(fps) < 2 or all(small[large[i]] == small[i] for i in range(len(fps)))  # no false link
        rest = large
        # links that only another block finds: at most two bits apart
        near = np.bitwise_count(fps[:, None] ^ fps[None]) <= 2
        while True:
            new = simhash.smallest(np.where(near, rest[None], len(fps)).min(1), rest)
            if (new == rest).all():
                break
            rest = new
        missing = np.bitwise_count(fps[:, None] ^ fps[None]) == 3
        e = np.bitwise_count((fps[:, None] ^ fps[None]) & np.uint64(mask))
        assert (rest[np.nonzero(missing & ((e == 1) | (e == 3)))[0]] == rest[np.nonzero(missing & ((e == 1) | (e == 3)))[1]]).all()
    finally:
        simhash.MATRIX = old


def test_dedup_keeps_one_row_of_each(spark):
    df = spark.createDataFrame([(i, t, "a") for i, t in ODD], "doc_id long, text string, root string")
    out = simhash.simhash_dedup(df)
    assert out.columns == df.columns
    got = [r.doc_id for r in out.collect()]
    assert sorted(got) == [1, 3, 5, 6, 8]


def test_component_chain_and_hub(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    hub = [(100, k) for k in range(101, 400)]
    out = {r.node: r.root for r in connected_components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[i] == 100 for i in range(100, 400))
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert simhash.simhash_components(none).count() == 0 and simhash.simhash_dedup(none).count() == 0
    assert sharding.document_shards(none).count() == 0


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(spark, n, bits):
    side = 1 << bits
    cells = spark.range(side**n).select("id", *[(F.floor(F.col("id") / side**k) % side).cast("int").alias(f"d{k}") for k in range(n)])
    got = cells.withColumn("h", sharding.hilbert_index([F.col(f"d{k}") for k in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in got] == list(range(side**n))
    at = np.array([[r[f"d{k}"] for k in range(n)] for r in got])
    assert (np.abs(np.diff(at, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("bucket_rows", [50_000, 7])
def test_shards(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding.hilbert_shards, "__defaults__", (sharding.BITS, bucket_rows))
    odd = [(i, t, None, "s") for i, t in ODD]
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").unionByName(
        spark.createDataFrame(odd, "doc_id long, text string, lang string, source string")
    ).withColumn("size", F.lit("x")).withColumn("curve", F.lit(1))
    rows = df.collect()
    out = sharding.document_shards(df).collect()
    raw = lambda t: (t or "").encode()
    assert sorted(repr((r.doc_id, r.size, r.text_crc32)) for r in out) == sorted(repr((r.doc_id, len(raw(r.text)) + 8, zlib.crc32(raw(r.text)))) for r in rows)
    shards = {}
    for r in out:
        shards.setdefault(r["shard"], []).append(r)
    assert sorted(shards) == list(range(24))
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in shards.values())
    last = [(r["shard"], r.slot, r.curve) for r in out]
    assert [c for _, _, c in sorted(last)] == sorted(c for _, _, c in last)  # shards are runs of the curve


def test_shards_prune(spark):
    df = QUERIES["op7_sharding"](spark, SF)
    ranges = sharding.shard_ranges(df, ["size", "doc_id"]).collect()
    widths = np.mean([r.max_size - r.min_size for r in ranges])
    assert len(ranges) == 24 and widths < df.agg(F.max("size") - F.min("size")).first()[0]


def test_components_of_a_chain_in_id_order_take_few_rounds(spark, monkeypatch):
    from duescore.llm import components as cp

    seen = []
    plain = cp.staged
    monkeypatch.setattr(cp, "staged", lambda df, name: (seen.append(name), plain(df, name))[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(1_000) if i != 600] + [(5, 5), (2_000, 2_001), (2_001, 2_000)], "a long, b long")
    root = {r.node: r.root for r in cp.connected_components(edges).collect()}
    assert seen.count("pointers") <= 15
    groups = {}
    for node, r in root.items():
        groups.setdefault(r, set()).add(node)
    assert sorted(map(sorted, groups.values())) == [list(range(601)), list(range(601, 1_001)), [2_000, 2_001]]


@pytest.mark.parametrize("values", [
    {"common_crawl_a": 30, "common_crawl_z": 30, "https://a": 20, "https://zz": 20},
    {f"https://site{k % 7}.org/page/{k:04d}": 1 for k in range(300)},
    {"one": 100, None: 50, "": 3}, {"same": 10}, {None: 4}, {"a" * k: 5 for k in range(1, 12)}, {"é": 5, "z": 5, "漢": 5, "\U0001f600": 5}, {},
])
def test_texts_are_cut_by_whole_values(spark, values):
    rows = [(v,) for v, n in values.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "t string")
    cuts = sharding.text_cuts(df, "t", 16)
    assert cuts == sorted(set(cuts)) and len(cuts) <= 15
    known = sorted(((v or "").encode().hex().upper(), n) for v, n in values.items() if v is not None)
    total, step = sum(n for _, n in known), {}
    for h, n in known:
        step.setdefault(sum(h >= c for c in cuts), []).append(n)
    assert len(step) == (len(cuts) + 1 if known else 0)             # no step is empty
    if 1 < len(known) <= 16 and max(n for _, n in known) * 16 > total > 0:
        assert all(sum(ns) * 16 <= 2 * total or len(ns) == 1 for ns in step.values())
    if len(known) > 16:
        assert len(step) >= 12 and max(map(sum, step.values())) * 16 <= 2 * total
    got = df.select(sharding.quantised(df, ["t"], 4)[0].alias("s")).groupBy("s").count().collect()
    want = {k: sum(ns) for k, ns in step.items()}
    want[0] = want.get(0, 0) + values.get(None, 0)
    assert {r.s: r["count"] for r in got} == {k: n for k, n in want.items() if n}
