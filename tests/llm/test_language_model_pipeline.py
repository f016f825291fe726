"""Language-model scores against a plain unigram and sanity rules; the pipeline stage
by stage against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
import corpus_pipeline
from duescore.llm import language_model as lm
from duescore.llm.decontaminate import contamination
from tests.llm.test_packing import check_pieces
from tests.llm.test_simhash_sharding import fingerprint, labels

SF = "/root/testdata/sf0.001"
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(i, t) for i, t in enumerate([None, "", "One two\tone", "one two one", "one two one", "é É\nx", "the " * 5000, "unseen-word", "w" * 3000] * 4)] + [(None, "one"), (3, "one two")]


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ)), "\n"]


def unigram(rows):
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(x for i, t in rows if not held(i) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    bottom = n + 0.1 * (v + 1)
    return sorted(
        (-1 if i is None else i, held(i), len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.1) / bottom) for x in w), 6)) for i, t in rows for w in [tokens(t)]
    )


@pytest.mark.parametrize("hot_words", [300_000, 5])
def test_base_columns(spark, hot_words):
    odd = spark.createDataFrame([(i, t, "x", 1) for i, t in ODD], "doc_id long, text string, word string, c int")
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        out = lm.scores(df, hot_words=hot_words).collect()
        got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
        want = unigram([(r.doc_id, r.text) for r in df.collect()])
        assert [g[:5] for g in got] == [w[:5] for w in want]
        assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-5)
        assert all(r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0 for r in out)


def test_join_and_lookup_agree(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    a = {r.doc_id: r.score for r in lm.scores(df).collect()}
    b = {r.doc_id: r.score for r in lm.scores(df, hot_words=20).collect()}
    assert all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)


def test_model_beats_the_base_on_held_out_text(spark):
    out = [r for r in lm.scores(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).collect() if r.held_out]
    assert len(out) > 50 and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_held_out_text_teaches_nothing(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    other = [(i, "something else" if i in held else t) for i, t in rows]
    a, b = ({r.doc_id: (r.base_score, r.score) for r in lm.scores(spark.createDataFrame(x, "doc_id long, text string")).collect()} for x in (rows, other))
    assert all(np.allclose(a[i], b[i], rtol=1e-6) for i in a if i not in held)


def test_empty(spark):
    assert lm.scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=12).filter(lambda w: not set(w) & set(b" \t\n\r\x0b\x0c")), min_size=1, max_size=6))
def test_bits_spell_the_words(words):
    bits = lm.bits_of(words)
    value = (bits.bit << np.arange(7, -1, -1)).sum(1)
    assert bytes(value.tolist()) == b" ".join(words) + b" "
    at = {}
    for k, w in enumerate(words):  # equal histories share their slots, whatever stands before the word
        first = np.flatnonzero(bits.word == k)[0]
        for p in range(len(w) + 1):
            assert at.setdefault(w[:p], bits.slot[:, first + p, 0].tolist()) == bits.slot[:, first + p, 0].tolist()


def test_spelling_is_a_distribution():
    """Bit by bit the probabilities of the two values are complementary, so those of all
    bytes after any history sum to one."""
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 9, (lm.SLOTS, 2)).astype(np.float32)
    mixer = lm.Mixer(rng.normal(size=(lm.GATES, len(lm.SLOT_BITS))), rng.random((256, lm.CELLS, 2)) + 0.1)
    total = 0.0
    for byte in range(256):
        bits = lm.bits_of([b"ab" + bytes([byte])])
        n = counts[bits.slot]
        seen = n.sum(-1)
        p = mixer.probability(lm.log_odds(n[..., 0], n[..., 1]), lm.gate_of(bits.node, seen[2], seen[4]), bits.node)
        total += float(np.where(bits.bit == 1, p, 1 - p)[2].prod())
    assert abs(total - 1) < 1e-4


def test_codes_are_a_distribution():
    """After any two tokens the probabilities of the code's leaves, each the product of its
    bits', sum to one; likelier words have shorter codes."""
    rng = np.random.default_rng(1)
    code = lm.Code([b"%d" % k for k in range(40)], np.sort(rng.integers(2, 500, 40))[::-1], 30)
    length = np.diff(code.first)
    assert length[1] == length[1:].min() and length[40] == length.max() and np.isclose((0.5**length).sum(), 1)
    counts = rng.integers(0, 9, (lm.PAIR_SLOTS, 2)).astype(np.float32)
    mixer = lm.Mixer(rng.normal(size=(lm.GATES, 3)), rng.random((lm.GATES, lm.CELLS, 2)) + 0.1, 3, lm.GATES)
    ids, totals = np.arange(41), []
    for one, two in ((3, 7), (7, 3), (lm.START, lm.START)):
        rows = np.stack([np.full(41, two), np.full(41, one), ids], 1)[:, (2 if one < 0 else 0):]
        size = rows.shape[1]
        logs = lm.code_logs(code, mixer, lm.log_odds(counts[:, 0], counts[:, 1]), lm.level(counts.sum(1)), rows.ravel(), np.arange(41) * size)
        totals.append(10.0 ** logs[size - 1 :: size])
    assert np.allclose([t.sum() for t in totals], 1, atol=1e-4) and not np.allclose(totals[0], totals[1])
    assert lm.Code([], np.zeros(0, np.int64), 5).first.tolist() == [0, 0]


def test_words_are_predicted_from_the_words_before(spark):
    """Equal words in the order of the training texts score higher than in another one, and
    all occurrences count: what follows a word is learned from how often it did."""
    held = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = np.random.default_rng(2)
    seen = " ".join
    pairs = [["red", "apple"], ["blue", "sky"], ["green", "leaf"], ["dark", "night"]]
    rows = [(i, seen(w for k in rng.integers(0, 4, 30) for w in pairs[k])) for i in range(400) if i not in held]
    rows += [(held[0], "red apple blue sky green leaf dark night"), (held[1], "red sky blue leaf green night dark apple")]
    out = {r.doc_id: r for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, b = out[held[0]], out[held[1]]
    assert a.held_out and b.held_out and math.isclose(a.base_score, b.base_score)
    assert a.score > b.score + 3 and a.score > a.base_score + 2


def test_all_leaves_of_a_large_code():
    """Slots of near nodes lie side by side, and none depends on bits still to come: the leaves of
    a code of many steps sum to one."""
    rng = np.random.default_rng(3)
    code = lm.Code([b"%d" % k for k in range(3000)], np.sort(rng.zipf(1.3, 3000) % 100_000 + 2)[::-1], 9000)
    counts = rng.integers(0, 50, (lm.PAIR_SLOTS, 2)).astype(np.float32)
    mixer = lm.Mixer(rng.normal(size=(lm.GATES, 3)), rng.random((lm.GATES, lm.CELLS, 2)) + 0.1, 3, lm.GATES)
    rows = np.stack([np.full(3001, 9), np.full(3001, 4), np.arange(3001)], 1)
    logs = lm.code_logs(code, mixer, lm.log_odds(counts[:, 0], counts[:, 1]), lm.level(counts.sum(1)), rows.ravel(), np.arange(3001) * 3)
    assert math.isclose((10.0 ** logs[2::3]).sum(), 1, abs_tol=1e-4)
    bits = code.bits(np.arange(3001), np.full(3001, 4), np.full(3001, 9))
    lines = [len(np.unique(s >> lm.NEAR_STEPS)) for s in bits.slot]
    assert max(lines) < len(np.unique(bits.slot[1])) / 2  # before, each slot lay in a place of its own


def test_equal_places_are_found_once():
    """Equal tokens after equal ones are one place with their number; in another order too."""
    ids, begins = np.array([5, 6, 5, 6, 1, 5, 6, 5, 2]), np.array([0, 5])
    want = Counter([(5, -1, -1), (6, 5, -1), (5, 6, 5), (6, 5, 6), (1, 6, 5), (5, -1, -1), (6, 5, -1), (5, 6, 5), (2, 5, 6)])
    for scattered in (False, True):
        ((_, p),) = lm.places_of(ids, begins, 7, scattered, found=True)
        rows = list(zip(p.ids.tolist(), p.one.tolist(), p.two.tolist()))
        assert dict(zip(rows, p.often.tolist())) == want and len(rows) == len(want)
        assert p.ids[p.of].tolist() == ids.tolist()


def test_told_places_hold_the_bit():
    """Twice the slot and the bit come from the paths themselves, and the slots after the word before lie
    behind all others; one look-up at them tells the odds of the bit without one occurrence, and how often seen."""
    code = lm.Code([b"%d" % k for k in range(300)], np.arange(400, 100, -1), 90)
    ids, one, two = np.array([0, 7, 300, 41, 7]), np.array([3, -1, 9, 300, 3]), np.array([5, -1, 0, 7, 5])
    bits, told = code.bits(ids, one, two), code.bits(ids, one, two, told=True)
    assert all((t >> 1 == s).all() for s, t in zip(bits.slot, told.slot)) and (told.slot[0] & 1 == told.slot[1] & 1).all()
    assert bits.slot[0].min() >= lm.AFTER_ONE > bits.slot[1].max() and bits.slot[0].max() < lm.PAIR_SLOTS
    bit, sign = told.slot[0] & 1, np.where(told.slot[0] & 1, 1, -1)
    counts = np.random.default_rng(4).integers(0, 40, (lm.PAIR_SLOTS, 2)).astype(np.float32)
    table = lm.packed_without(counts)
    for slot, t, shift in zip(bits.slot, told.slot, (2, 0)):
        n0, n1 = np.maximum(counts[slot, 0] - (1 - bit), 0), np.maximum(counts[slot, 1] - bit, 0)
        assert np.allclose(table[t].view(np.float32), sign * lm.log_odds(n0, n1), rtol=1e-5)
        assert ((table[t] & 15) == lm.level(n0 + n1) << shift).all()
    assert ((code.odds[bits.at] & 1) == 1 - bit).all()


def test_learning_by_the_bit_that_is_there():
    """Odds of the bit that is there, and gates that hold it, teach the same as those of a 1 bit, and are mixed alike."""
    rng = np.random.default_rng(5)
    a, b = (lm.Mixer(n=3, nodes=lm.GATES) for _ in range(2))
    for _ in range(6):
        odds, gate, bit = rng.normal(0, 3, (3, 5000)).astype(np.float32), rng.integers(0, lm.GATES, 5000), rng.integers(0, 2, 5000)
        often = rng.integers(1, 9, 5000).astype(np.float32)
        turned, there = gate >> 4 << 5 | (1 - bit) << 4 | gate & 15, odds * (2 * bit - 1).astype(np.float32)
        assert np.allclose(b.signed(there, turned), a.mixed(odds, gate) * (2 * bit - 1), atol=1e-4)
        p = a.probability(odds, gate, gate)
        x = b.signed(there, turned)
        told = (1 / (1 + np.exp(-x)) + b.signed_cells()[b.signed_cell(x, turned)]) / 2
        assert np.mean(np.abs(told - np.where(bit == 1, p, 1 - p)) > 1e-4) < 1e-3  # but for odds between two cells
        a.learn(odds, gate, gate, bit, True, often)
        b.learn_signed(there, turned, turned, turned, True, often)
    assert np.allclose(a.weights, b.weights, atol=1e-4) and np.isclose(a.cells.sum(), b.cells.sum())


def test_found_places_when_hashes_meet():
    """Tokens that share the sorted number's hash keep places of their own, and none is lost."""
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 3, 60_000) * 30_000 + np.where(rng.random(60_000) < 0.5, rng.integers(0, 5_000, 60_000), 0)
    ((_, p),) = lm.places_of(ids, np.array([0, 70]), 1 << 16, found=True)
    one, two = np.r_[-1, ids[:-1]], np.r_[-1, -1, ids[:-2]]
    one[70] = two[70] = two[71] = -1
    assert all((x[p.of] == y).all() for x, y in zip((p.ids, p.one, p.two), (ids, one, two))) and p.often.sum() == len(ids)
    assert len(p.ids) <= 1.01 * len(set(zip(ids.tolist(), one.tolist(), two.tolist())))


def test_scoring_does_not_depend_on_the_slices(spark, monkeypatch):
    """Words are found in slices of rows and worked on in runs of them: texts longer than either, nulls
    and empty texts get the same scores however rows are cut."""
    odd = spark.createDataFrame(ODD, "doc_id long, text string").coalesce(1)
    a = sorted(((r.doc_id or -1, r.score, r.base_score) for r in lm.scores(odd, hot_words=5).collect()))
    monkeypatch.setattr(lm, "SLICE_BYTES", 20)
    b = sorted(((r.doc_id or -1, r.score, r.base_score) for r in lm.scores(odd, hot_words=5).collect()))
    assert np.allclose(a, b, rtol=1e-9)
    offsets = np.array([0, 0, 50, 55, 60, 60, 200])
    assert list(lm.row_runs(offsets, 20)) == [(0, 1), (1, 2), (2, 5), (5, 6)] and list(lm.row_runs(offsets[:1], 20)) == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=6), min_size=1, max_size=12).map(sorted))
def test_words_that_begin_alike_share_their_bits(texts):
    words = [w.encode() for w in texts]
    fresh, owner, word = lm.shared(words)
    every, once = lm.bits_of(words), lm.bits_of(words, fresh)
    assert (once.slot[:, owner] == every.slot).all() and (once.bit[owner] == every.bit).all() and (word == every.word).all()
    assert fresh.sum() == len({(w + b" ")[: k + 1] for w in words for k in range(len(w) + 1)})


def test_byte_list():
    words = ["a", "", "éé", "b c"]
    for kind in (pa.string(), pa.binary(), pa.large_binary()):
        arr = pa.array([w.encode() for w in words], pa.binary()).cast(kind)
        assert lm.byte_list(arr) == [w.encode() for w in words] and lm.byte_list(arr.slice(2)) == ["éé".encode(), b"b c"]
        assert lm.byte_list(arr.slice(1, 1)) == [b""] and lm.byte_list(arr.slice(0, 0)) == []


def test_earlier():
    assert lm.earlier(np.array([0, 0, 0, 1, 1]), np.array([5, 5, 2, 5, 5])).tolist() == [0, 1, 0, 0, 1]
    assert np.allclose(lm.log_sum(np.array([-3.0]), np.array([-np.inf])), -3)


def test_pipeline_is_registered(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()) == 13


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_classifier(spark, docs, SF).cache()
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    # one document of each near-duplicate group
    rows = sorted(((r.doc_id, r.text) for r in kept.collect()))
    lab = labels(np.array([fingerprint(t) for _, t in rows], np.uint64))
    want = [i for k, (i, _) in enumerate(rows) if lab[k] == k]
    single = corpus_pipeline.near_dedup(spark, kept, SF)
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == want
    # no benchmark window is left, clean documents are as they were
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = corpus_pipeline.benchmark_decontamination(spark, single, SF).cache()
    hit = {r.doc_id: r.n_hit / r.n_words for r in contamination(single, bench).where("n_hit > 0").collect()}
    texts = {r.doc_id: r.text for r in single.collect()}
    left = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == docs.columns and set(left) == {i for i in texts if hit.get(i, 0) <= 0.5}
    assert all(left[i].text == texts[i] for i in left if i not in hit) and all(left[i].text != texts[i] for i in left if i in hit)
    assert contamination(clean, bench).where("n_hit > 0").count() == 0
    # every token of every document once
    check_pieces(corpus_pipeline.best_fit_packing(spark, clean, SF).collect(), [(r.doc_id, r.text) for r in left.values()])


def test_pipeline_runs_through(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_pipeline_stages_with_odd_rows(spark):
    """Nulls in every column, empty and long texts, repeated rows, further columns named as
    inside the stages: all stages run, keep the columns and the rows that they should."""
    names = ["node", "root", "fp", "key", "row", "side", "bucket", "piece", "ids", "block", "hit"]
    texts = [None, "", "!!", "alpha beta gamma delta", "alpha beta gamma delta", "long " * 40_000, "one two three four five six seven eight nine ten"]
    rows = [(i, t, None if i == 2 else "en", "s", None, *("x" for _ in names)) for i, t in enumerate(texts)]
    rows += [(None, "no id here at all", None, None, 1, *(None for _ in names)), rows[6]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    kept = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(df.columns == docs.columns for df in kept.values())
    got = {name: sorted(repr((r.doc_id, r.text, r.lang, r.node)) for r in df.collect()) for name, df in kept.items()}
    assert got["quality_classifier"] == sorted(repr((r[0], r[1], r[2], r[5])) for r in rows)
    groups = {0: rows[0], 3: rows[3], 5: rows[5], 6: rows[6], None: rows[7]}      # 0, 1: no word; 2: a word; 3, 4 alike
    assert got["simhash_near_dedup"] == sorted(repr((r[0], r[1], r[2], r[5])) for r in [*groups.values(), rows[2]])
    assert len(got["benchmark_decontamination"]) == len(rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted({repr(p.doc_id) for p in pieces}) == sorted({repr(r[0]) for r in rows}) and all(0 < p.length <= 2048 for p in pieces)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_words_of_a_column():
    w = lm.Words(pa.array(["a b", None, "", "b  c a"]), lm.NON_SPACE)
    codes, names = w.coded()
    assert [names[c].as_py() for c in codes] == [b"a", b"b", b"b", b"c", b"a"] and w.counts.tolist() == [2, 0, 0, 3]
