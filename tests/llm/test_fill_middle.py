"""Fill-in-middle: the rank index against plain offsets, results against brute force."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duescore.llm import fill_middle as fm

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4000), max_size=400), st.integers(1, 90))
def test_rank_index_is_exact(steps, part):
    offsets = np.cumsum(np.array(steps, np.int64))
    index = fm.RankIndex()
    for lo in range(0, len(offsets), part):
        index.extend(offsets[lo : lo + part])
    index.close()
    if len(offsets):
        assert (index.at(np.arange(len(offsets))) == offsets).all()


def test_rank_index_is_small_on_text():
    rng = np.random.default_rng(3)
    offsets = np.cumsum(rng.integers(1, 9, 200_000))
    index = fm.RankIndex()
    index.extend(offsets)
    index.close()
    assert (index.at(np.arange(len(offsets))) == offsets).all()
    assert len(index.first) < 600 and index.miss.dtype == np.int8


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZé 漢<P>S\n\U0001f600"), max_size=40), max_size=8), st.sampled_from([1, 3, 7, 1 << 20]))
def test_boundaries_in_blocks(texts, block):
    raw = [t.encode() for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
    was, fm.BLOCK_BYTES = fm.BLOCK_BYTES, block
    try:
        index, rank = fm.boundary_index(np.frombuffer(b"".join(raw), np.uint8), rows)
    finally:
        fm.BLOCK_BYTES = was
    for k, t in enumerate(texts):
        words = TOKEN.findall(t)
        assert rank[k + 1] - rank[k] == len(words)
        at = np.cumsum([0] + [len(w.encode()) for w in words])
        assert (index.at(rank[k] + np.arange(len(words) + 1)) - rows[k] == at).all()


def expected(doc_id, text):
    text = text or ""
    words = TOKEN.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    i, j = sorted((h[0] % (len(words) + 1), h[1] % (len(words) + 1)))
    p, m, s = "".join(words[:i]), "".join(words[i:j]), "".join(words[j:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(words), "plain", text, None, None, text
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(words), form, out, len(p), len(m), text


ODD = [None, "", "a", "<", "<S", "P><", "x<P>y", "é漢\U0001f600 abc", "<" * 50 + ">" * 50, "S>" * 30, "word " * 60_000, "b" * 200_000, "漢" * 5_000, "same", "same", "\x00a\x00"]


@pytest.mark.parametrize("ids", [range(40), [None] * 40])
def test_rows_against_brute_force(spark, ids):
    rows = [(i, t, "x", 1, "y") for i, t in zip(ids, ODD * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int, form string")
    done = fm.fill_in_middle(df)
    got = done.select("*", fm.restored(done.output, done.form).alias("back")).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected(i, t)) for i, t, *_ in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"} or ids == [None] * 40


def test_empty_table(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).collect() == []
