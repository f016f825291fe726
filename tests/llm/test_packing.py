"""Tokens and packing against whole-text encoding and against exhaustive search."""

import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duescore.llm import packing, tokens

SF = "/root/testdata/sf0.001"
ENCODER = tokens.Encoder.of(tokens.vocabulary_path())
ODD = [
    None, "", " ", "  a  b   ", "x <|endoftext|> y", "<|endoftext|>", "don't.\nWe\t\n  end  ", "naïve é ñ × ÷.  ok — dash—x … .",
    "a\r\n b 　c !! a! 'll 's\n's", "é .a\x85 b\x1c c", "'", " '", "a 'b we'll", "1.5 2,000.00 a1b2", "한국어 日本 語。ok 😀 😀x", "\n\nA\nB \n C",
]


def whole(text):
    return ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_chunked_ids_are_whole_text_ids():
    ids, row = ENCODER.encode(pa.array(ODD))
    assert [ids[a:b].tolist() for a, b in zip(row, row[1:])] == [whole(t) for t in ODD]


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "the", "The", "é", "Ñ", ",", ".", "'", "'s", "!!", "1", "23", "×", " ", " ", "—", "a", "x1", "\r\n", "日", "\x1c"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=5))
def test_chunk_property(texts):
    ids, row = ENCODER.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(row, row[1:])] == [whole(t) for t in texts]


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 3)
    for t in (["one two three four five"], ["five six, seven"], ["one two"]):
        ids, _ = ENCODER.encode(pa.array(t))
        assert ids.tolist() == whole(t[0])


def check_pieces(rows, docs, capacity=2048):
    """rows against the contract, given (id, text) of all documents."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    want = Counter()
    for i, t in docs:
        ids = [*whole(t), 0]
        short = len(ids) % capacity or capacity
        cuts = [0, *range(short, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packed_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    n = check_pieces(packing.packed(df).collect(), docs)
    total = sum(len(whole(t)) + 1 for _, t in docs)
    assert n <= -(-total // 2048) + 1


def test_packed_odd_rows(spark):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (99, "word " * 7000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, piece string, length long")
    check_pieces(packing.packed(df).collect(), rows)
    check_pieces(packing.packed(df, capacity=64).collect(), rows, 64)
    assert packing.packed(df.limit(0)).count() == 0


def exhaustive(items, capacity):
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                place(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_plan_against_exhaustive_search(items):
    items = sorted(items, reverse=True)
    plan = packing.plan_packing(Counter(items), 20)
    used = Counter()
    for filling, many in plan:
        assert sum(s * n for s, n in filling) <= 20
        for s, n in filling:
            used[s] += n * many
    assert used == Counter(items)
    assert sum(n for _, n in plan) <= exhaustive(items, 20) + 1


def test_plan_is_optimal_mostly():
    rng = np.random.default_rng(1)
    gaps = 0
    for _ in range(60):
        items = sorted(rng.integers(1, 20, 9).tolist(), reverse=True)
        gaps += sum(n for _, n in packing.plan_packing(Counter(items), 20)) - exhaustive(items, 20)
    assert gaps <= 2


@pytest.mark.parametrize("scale", [1, 1000])
def test_plan_of_many_documents(scale):
    counts = {s: scale * (1 + s % 3) for s in range(1, 2049)}
    total = sum(s * n for s, n in counts.items())
    assert sum(n for _, n in packing.plan_packing(counts)) <= 1.001 * total / 2048 + 1


def test_undominated_fillings():
    sizes = [2, 3, 5]
    counts = Counter({2: 2, 3: 1, 5: 1})
    got = {f for _, f in packing.fillings(7, sizes, counts, 50)}
    full = set()
    for a, b, c in product(range(3), range(2), range(2)):
        room = 7 - 2 * a - 3 * b - 5 * c
        if room >= 0 and not any(s <= room and counts[s] > n for s, n in ((2, a), (3, b), (5, c))):
            full.add(tuple((s, n) for s, n in ((5, c), (3, b), (2, a)) if n))
    assert got <= full and ((5, 1), (2, 1)) in got and packing.fillings(7, sizes, counts, 1)[0][0] == 0


@pytest.mark.parametrize("counts", [{1: 100_000}, {2: 100_000}, {1: 100_000, 1025: 30, 2000: 7}, {1: 30_000, 2: 30_000, 3: 5, 700: 40_000}])
def test_plan_of_many_short_pieces(counts):
    plan = packing.plan_packing(counts)
    used = Counter()
    for filling, many in plan:
        assert sum(s * n for s, n in filling) <= 2048
        for s, n in filling:
            used[s] += n * many
    assert used == counts
    total, big = sum(s * n for s, n in counts.items()), sum(n for s, n in counts.items() if s > 1024)
    thirds = -(-counts.get(700, 0) // 2)  # two of 700 in a sequence
    assert sum(n for _, n in plan) == max(-(-total // 2048), big, thirds)
