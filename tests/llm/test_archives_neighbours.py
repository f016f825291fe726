"""Archive conversion by round trip, neighbours by recall against brute force."""

import gzip
import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duescore.llm import archives as ar
from duescore.llm import neighbours as nb

SF = "/root/testdata/sf0.001"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=60), max_size=6), st.sampled_from([1, 2]), st.booleans(), st.booleans())
def test_arc_round_trip(payloads, version, http, packed):
    data = ar.arc_version_block(version) + b"".join(ar.arc_record(version, f"http://a/{k}", p, 0, http=http) for k, p in enumerate(payloads))
    back = list(ar.parse_arc(gzip.compress(data) if packed else data))
    assert [r.block.partition(b"\r\n\r\n")[2] if http else r.block for r in back] == payloads
    assert all(r.version == version and r.fields["Archive-date"] == ar.CAPTURE_DATE for r in back)


@pytest.mark.parametrize("data", [b"no arc\n", ar.arc_version_block(1) + b"http://a 1 2 text/html\n", ar.arc_version_block(1) + b"http://a 0 20200101000000 text/html 99\nshort"])
def test_broken_arc_is_refused(data):
    with pytest.raises(ValueError):
        list(ar.parse_arc(data))


def test_dates():
    assert ar.warc_date("20200102030405") == "2020-01-02T03:04:05Z"
    assert ar.warc_date("1996") == "1996-01-01T00:00:00Z"


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(max_size=80), max_size=5))
def test_warc_round_trip(payloads):
    data = b"".join(ar.warc_text("u", "2020-01-01T00:00:00Z", hashlib.sha1(p).hexdigest(), p, k, None, None) + b"\r\n\r\n" for k, p in enumerate(payloads))
    back = list(ar.parse_warc(data))
    assert [b.partition(b"\r\n\r\n")[2] for _, b in back] == payloads
    assert [h["X-Page-Id"] for h, _ in back] == [str(k) for k in range(len(payloads))]


BIG = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 60
PAGES = [
    (1, "http://a/ b", BIG), (2, None, BIG), (5, "http://é", BIG), (5, "http://é", BIG), (3, "u", "short"), (4, "u", "short"),
    (6, "u", None), (7, "u", ""), (None, "u", BIG), (None, "v", "x" * 1000), (8, "u", "y" * 999), (9, "u", "y" * 999), (10, "u", "z" * 1_000_000),
]


def expected_pages(rows):
    last = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if i is not None and len(h) >= 1000:
            last[h] = max(last.get(h, i), i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        kept = last.get(h)
        revisit = kept is not None and kept != i
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(map(repr, out))


def test_pages_through_archives(spark):
    odd = spark.createDataFrame([(*r, "x", 1) for r in PAGES], "page_id long, url string, html string, digest string, kept int")
    for df in (odd, spark.read.parquet(f"{SF}/pages.parquet"), odd.limit(0)):
        want = expected_pages([(r.page_id, r.url, r.html) for r in df.collect()])
        out = ar.archived(df)
        assert sorted(repr(tuple(r)[:5]) for r in out.collect()) == want


def test_hilbert_keys_step_to_neighbours():
    for n, bits in ((2, 4), (3, 3), (8, 1)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * n, indexing="ij"), -1).reshape(-1, n)
        key = nb.hilbert_keys(cells, bits)
        assert sorted(key) == list(range(side**n))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def brute(rows, picked, k=10):
    v = sorted({(i, tuple(x)) for i, x in rows if i is not None and x and len(x) == 3 and all(c is not None and math.isfinite(c) for c in x) and any(x)})
    out = []
    for q, a in v:
        if picked(q):
            near = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))), i) for i, b in v if i != q)
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_small_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    rows += [(100 + i, [1.0, 2.0, 3.0]) for i in range(60)] + [(0, rows[0][1])]  # a hot vector, a repeated row
    rows += [(200, None), (300, []), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 2.0]), (600, [float("nan"), 1.0, 1.0]), (700, [1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (800, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows], "vec_id long, embedding array<double>, node int, query string")
    out = nb.nearest(df, F.col("id") % 20 == 0)
    got = sorted(tuple(r) for r in out.collect())
    want = brute(rows, lambda q: q % 20 == 0)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=0, atol=1e-12)
    assert nb.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert nb.nearest(df.where("vec_id = 20"), F.col("id") % 20 == 0).count() == 0


def test_chunks_give_the_same_neighbours(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = sorted(map(tuple, nb.nearest(df, F.col("id") % 20 == 0, blocks=4).collect()))
    monkeypatch.setattr(nb, "CHUNK_ROWS", 30)
    monkeypatch.setattr(nb, "CHUNK_QUERIES", 4)
    assert sorted(map(tuple, nb.nearest(df, F.col("id") % 20 == 0, blocks=4).collect())) == want


def test_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.stack([np.array(r.embedding) for r in df.orderBy("vec_id").collect()])
    found = {}
    for r in nb.nearest(df, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q, ids in found.items():
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(ids & set(np.argsort(d)[:10].tolist()))
    assert len(found) == 100 and hit / 1000 >= 0.9


def test_packed_vectors_keep_bits():
    col = pa.array([np.array([0.1, -0.0, 3e38], "<f4").tobytes()], pa.binary())
    assert nb.matrix(col, 3, "<f4").tolist() == [[float(np.float32(0.1)), -0.0, float(np.float32(3e38))]]


def test_block_bounds():
    assert nb.block_bounds([1, 2, 3]).tolist() == [1, 2, 3]
    assert nb.block_bounds([1, 5, 5, 5, 7, 9]).tolist() == [1, 5, 9]  # 7 ends less than a share
    assert nb.block_bounds([5, 5, 6, 6, 8]).tolist() == [5, 6]


def test_recall_beside_a_dense_cell(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(9000, 64))
    x[::3] = rng.normal(size=64) * 0.5 + rng.normal(size=(3000, 64)) * 0.01  # a third in one tight cluster
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in nb.nearest(df, F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = {True: [], False: []}
    for q in range(0, 9000, 20):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit[q % 3 == 0].append(len(found.get(q, set()) & set(np.argsort(d)[:10].tolist())) / 10)
    assert np.mean(hit[True]) >= 0.99 and np.mean(hit[False]) >= 0.9


def test_hot_payload_is_spread(spark):
    """A third of the pages share one payload: their rows go to several tasks, the result stays."""
    rows = [(i, f"http://a/{i}", BIG if i % 3 == 0 else f"{i} " * 600 if i % 3 == 1 else "") for i in range(900)]
    arcs = ar.arc_rows(ar.arc_pages(spark.createDataFrame(rows, "page_id long, url string, html string")))
    done = ar.with_originals(arcs, 1000, hot_rows=20)
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in ar.with_originals(arcs, 1000, hot_rows=20).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for k, v in zip(("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"), before):
            spark.conf.set(k, v)
    assert sum(sizes) == 900 and len(sizes) == 8 and max(sizes) < 2 * sorted(sizes)[4]
    kept = {r.page_id: r.kept for r in done.collect()}
    assert all(kept[i] == (897 if i % 3 == 0 and i != 897 else None) for i in range(900))


def test_revisits_refer_to_the_date_of_their_response():
    text = ar.warc_text("u", "2021-01-01T00:00:00Z", hashlib.sha1(b"x").hexdigest(), b"x", 1, "<urn:uuid:0>", "v", "2020-05-05T00:00:00Z")
    head = next(ar.parse_warc(text + b"\r\n\r\n"))[0]
    assert head["WARC-Refers-To-Date"] == "2020-05-05T00:00:00Z" and head["WARC-Date"] == "2021-01-01T00:00:00Z"
