"""Quality classifier on held-out labels and token counts against whole-text encoding."""

import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duescore.llm import quality as ql
from duescore.llm import token_files as tf
from duescore.llm import tokens

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (4, "x <|endoftext|> y"), (None, "no id"), (5, "word " * 30_000), (6, "!!")]


def expected_counts(rows):
    t = tokens.Encoder(tokens.vocabulary_path(), added=False).tokenizer
    return sorted(repr((i, len(t.encode(x or "", add_special_tokens=False).ids))) for i, x in rows)


@pytest.mark.parametrize("block_ids", [1 << 18, 64])
def test_counts_of_documents(spark, monkeypatch, block_ids):
    monkeypatch.setattr(tf.write_token_stream, "__defaults__", ("byte_bpe_50k.json", block_ids, "doc_id", "text"))
    odd = spark.createDataFrame([(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, stream string, block int").repartition(2)
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet"), odd.limit(0)):
        out = tf.document_token_counts(df).collect()
        assert sorted(repr((r.doc_id, r.n_tokens)) for r in out) == expected_counts([(r.doc_id, r.text) for r in df.collect()])
        for s in {r.stream for r in out}:  # documents follow each other without a gap
            at = 0
            for k, r in enumerate(sorted((r for r in out if r.stream == s), key=lambda r: r.nth)):
                assert (r.nth, r.start) == (k, at)
                at += r.n_tokens + 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), min_size=1, max_size=3), st.integers(1, 9))
def test_flat_files_with_blocks_of_any_size(spark, tmp_path_factory, files, block_ids):
    folder = tmp_path_factory.mktemp("flat")
    want = []
    for k, ids in enumerate(files):
        (folder / f"{k}.bin").write_bytes(np.array(ids, "<u2").tobytes())
        at = 0
        for i, x in enumerate(ids):
            if x == 3:
                want.append((f"{k}.bin", at, i - at))
                at = i + 1
    out = tf.token_counts(tf.file_blocks(spark, str(folder), block_ids=block_ids), end_id=3).collect()
    assert sorted((r.stream.rsplit("/", 1)[1], r.start, r.n_tokens) for r in out) == sorted(want)


def test_ngrams():
    row, bucket, before = ql.ngrams(pa.array(["The the, THE!! a", None, "", "x"]))
    assert np.bincount(row, minlength=4).tolist() == [7, 0, 0, 1]  # six n-grams, one repeat
    assert (bucket == 0).sum() == 1 and len(set(bucket[row == 0].tolist())) == 5
    assert before[row == 3].tolist() == [0]


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    fit = labels.where("doc_id % 2 = 0")
    got = ql.classified(docs, fit).join(labels.where("doc_id % 2 = 1"), "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {(r.quality, r.toxic): r.kept for r in got}
    assert kept[1, 0] >= 0.99 and kept[0, 0] <= 0.02 and kept[1, 1] <= 0.6


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t in ODD], "doc_id long, text string, _w string, side double")
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (6, 0, None), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        out = ql.classified(docs, lab).collect()
        assert len(out) == len(ODD) and all(r.keep for r in out)
        kept = ql.resampled(docs, lab)
        assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert ql.classified(docs.limit(0), labels).count() == 0 and ql.resampled(docs.limit(0), labels).count() == 0


def test_stage_keeps_what_the_query_keeps(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    keep = sorted(r.doc_id for r in ql.classified(docs, labels).where("keep").collect())
    assert sorted(r.doc_id for r in ql.resampled(docs, labels).collect()) == keep and len(keep) < docs.count()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from([-3.0, -1.0, 0.0, 0.5, 7.0, 1e9]), min_size=1, max_size=40), st.data())
def test_kth_largest(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert ql.kth_largest(df, k, bins=4, few=2) == sorted(values, reverse=True)[k - 1]


def test_gumbel_noise(spark):
    r = spark.range(20_000).select(ql.gumbel_key(F.lit(0.0), F.col("id")).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(r[0] - 0.5772) < 0.05 and abs(r[1] - math.pi / math.sqrt(6)) < 0.05


def test_each_side_is_fitted_on_its_own_rows(spark):
    labels = spark.createDataFrame([(i, int(i >= 10), int(i < 4)) for i in range(60)], "doc_id long, quality int, toxic int")
    sizes = lambda fit_docs: {r.side: r.n for r in ql.labelled_sample(labels, fit_docs, "doc_id").groupBy("side").agg(F.count("*").alias("n")).collect()}
    assert sizes(100) == {0: 50, 1: 6, 2: 50, 3: 4} and sizes(5) == {0: 5, 1: 5, 2: 5, 3: 4}


def test_few_toxic_labels_find_toxic_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    got = ql.classified(docs, labels.where("doc_id % 2 = 1")).join(labels.where("doc_id % 2 = 0"), "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {(r.quality, r.toxic): r.kept for r in got}
    assert kept[1, 0] >= 0.99 and kept[0, 0] <= 0.02 and kept[1, 1] <= 0.1


def test_draws_follow_the_weights(spark):
    """Shares of a Gumbel top-k over many rows of three weights against a brute-force draw without replacement."""
    weights = np.repeat([0.0, -1.0, -2.0], 4_000)
    df = spark.createDataFrame([(i, float(w)) for i, w in enumerate(weights)], "id long, w double")
    draws = []
    for seed in (1, 2):
        keyed = df.select("id", "w", ql.gumbel_key(F.col("w"), F.col("id"), seed).alias("k"))
        cut = ql.kth_largest(keyed.select("k"), 3_000)
        kept = keyed.where(F.col("k") >= cut)
        draws.append({r.id for r in kept.collect()})
        got = {r.w: r["count"] for r in kept.groupBy("w").count().collect()}
        rng = np.random.default_rng(seed)
        drawn = rng.choice(len(weights), 3_000, replace=False, p=np.exp(weights) / np.exp(weights).sum())
        for w in (0.0, -1.0, -2.0):
            want = int((weights[drawn] == w).sum())
            assert abs(got[w] - want) < 5 * math.sqrt(want)
    assert all(len(d) == 3_000 for d in draws) and 500 < len(draws[0] - draws[1]) < 2_900


def test_share_sets_the_size_of_the_sample(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    n = docs.count()
    half = {r.doc_id for r in ql.classified(docs, labels, share=0.5).where("keep").collect()}
    other = {r.doc_id for r in ql.classified(docs, labels, share=0.5, seed=9).where("keep").collect()}
    assert len(half) == round(n / 2) and len(other) == round(n / 2) and half != other
    assert {r.doc_id for r in ql.resampled(docs, labels, share=0.5).collect()} == half


def test_one_large_flat_file_is_read_by_ranges(spark, tmp_path):
    ids = np.random.default_rng(1).integers(0, 50, 10_007).astype("<u2")
    (tmp_path / "one file.bin").write_bytes(ids.tobytes())
    (tmp_path / "empty.bin").write_bytes(b"")
    blocks = tf.file_blocks(spark, str(tmp_path), block_ids=16, read_blocks=4)
    assert "content" not in blocks._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.block, bytes(r.data)) for r in blocks.collect())
    assert [k for k, _ in got] == list(range(-(-len(ids) // 16))) and b"".join(d for _, d in got) == ids.tobytes()
    ends = np.flatnonzero(ids == 7)
    out = sorted((r.start, r.n_tokens) for r in tf.token_counts(blocks, end_id=7).collect())
    assert out == [(int(a) + 1, int(b - a - 1)) for a, b in zip(np.r_[-1, ends[:-1]], ends)]
