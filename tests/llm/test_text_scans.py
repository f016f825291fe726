"""License scan and benchmark decontamination against brute force."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duescore.llm import decontaminate as dc
from duescore.llm import licenses as li
from duescore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(AZ))


def base_places(text):
    w = words(text)
    hits = [(i, label) for p, label in li.BASE_PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


ODD = [
    (1, None), (2, ""), (3, "MIT License"), (3, "MIT License"), (4, "mit LICENSE mit license, CC-BY ÉCC BY"),
    (5, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\nmore text"),
    (6, "é" * 5 + " the GNU General\nPublic License." + " x" * 50_000 + " Apache License"), (None, "cc by 4.0"),
    (7, "spdx-license-identifier: or and ("), (8, "license-identifier: " + "(" * 3000),
]


def odd_docs(spark, rows=ODD):
    return spark.createDataFrame([(i, t, "x", 7, -1) for i, t in rows], "doc_id long, text string, n_words string, score int, _uid long")


def test_license_base_columns(spark):
    for df in (odd_docs(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = sorted(map(repr, ((r.doc_id, *base_places(r.text)) for r in df.collect())))
        out = li.license_scan(df)
        got = sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in out.collect())
        assert got == texts
        for r in out.collect():
            assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_license_expression(spark):
    r = {x.doc_id: x for x in li.license_scan(odd_docs(spark)).collect()}
    assert r[5].expressions == "((mit or apache-2.0) and gpl-2.0-only with classpath-exception-2.0)"
    assert r[5].labels == "apache,gpl,mit" and r[5].permission == pytest.approx(0.6)
    assert r[7].expressions == "" and r[1].score == 0 and r[1].labels == ""


@pytest.mark.parametrize(
    ("text", "rpn"),
    [("mit", ["mit"]), ("mit or bsd and isc", ["mit", "bsd", "isc", "and", "or"]), ("(mit or bsd) and isc", ["mit", "bsd", "or", "isc", "and"]),
     ("mit and", ["mit"]), ("mit some words", ["mit"]), ("and mit", None), ("(mit", None), ("mit)", ["mit"])],
)
def test_shunting_yard(text, rpn):
    assert li.parse_expression(text) == rpn


def test_long_license_expressions(spark):
    listed = [f"mit-{i}" for i in range(400)] + ["apache-2.0"]  # over 2,000 bytes
    and_list = " AND ".join(listed)
    nested = f"({listed[0]}"
    for x in listed[1:]:
        nested = f"{nested} and {x})" if x == listed[1] else f"({nested} and {x})"
    rows = [(1, f"spdx-license-identifier: {and_list}\ngpl"), (2, f"spdx-license-identifier: ({and_list})"), (3, f"license-expression: {and_list} some words"),
            (4, f"license-expression: ({and_list}"), (5, f"license-expression: mit or ({and_list})"), (6, "license-expression: " + "bsd and " * 30_000 + "gpl-2.0")]
    r = {x.doc_id: x for x in li.license_scan(odd_docs(spark, rows)).collect()}
    for k in (1, 2, 3):
        assert r[k].labels == "apache,mit" and r[k].expressions == nested
    assert r[4].expressions == "" and r[5].expressions == f"(mit or {nested})"
    assert r[6].labels == "bsd,gpl" and r[6].permission == pytest.approx(0.4)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert li.license_scan(none).count() == 0
    assert dc.contamination(none, items).count() == 0
    assert [r.n_hit for r in dc.contamination(odd_docs(spark), items).collect()] == [0] * len(ODD)


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, t in items:
            iw = words(t)
            k = min(window, len(iw))
            wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if iw else set()
            at = [i for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in wins]
            hit.update(x for i in at for x in range(i, i + k))
            if at and item is not None:
                found.add(str(item))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(map(repr, out))


def found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'a' as n_hit", "1 as item_id")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'b' as words")
    return dc.contamination(d, i, **kw).collect()


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "B c"), (3, "c d e f g h i j k l m n o p"), (4, None), (5, "  "), (None, "z z z"), (2, "q"), (6, "a b c d e f g h i j")]
DOCS = [(1, "A b c d e f g h i j x"), (2, None), (3, "x. b, C d"), (3, "x. b, C d"), (4, "z z z z a b c d e f g h i j k l m n o p q"), (5, ""), (None, "c d e f g h i j k l"), (9, "a " * 30_000)]


@pytest.mark.parametrize("block_words", [200_000, 5])
def test_windows_against_brute_force(spark, block_words):
    got = sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"])) for r in found(spark, DOCS, ITEMS, block_words=block_words))
    assert got == brute(DOCS, ITEMS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=14), min_size=1, max_size=4), st.text("abcd", max_size=60))
def test_automaton_property(items, text):
    window = 4
    auto = dc.SuffixAutomaton(window).build([(k, [c.encode() for c in t], True) for k, t in enumerate(items)])
    hit, which = set(), set()
    run, base = [], 0
    for i, c in enumerate(text + "!"):
        if c.encode() in auto.vocab:
            run.append(auto.vocab[c.encode()])
            continue
        spans, its = auto.scan(run)
        hit.update(base + x for a, b in spans for x in range(a, b + 1))
        which |= its
        run, base = [], i + 1
    want_hit, want = set(), set()
    for k, t in enumerate(items):
        n = min(window, len(t))
        wins = {t[i : i + n] for i in range(len(t) - n + 1)}
        for i in range(len(text) - n + 1):
            if text[i : i + n] in wins:
                want_hit.update(range(i, i + n))
                want.add(k)
    assert hit == want_hit and which == want


def test_long_item_segments(spark, monkeypatch):
    long = " ".join(f"w{i}" for i in range(100))
    monkeypatch.setattr(dc, "SEGMENT_WORDS", 12)
    docs = [(k, " ".join(f"w{i}" for i in range(k, k + 10))) for k in range(91)]
    assert all(r.n_hit == 10 for r in found(spark, docs, [(1, long)]))


def test_spans_are_cut(spark):
    docs = spark.createDataFrame(
        [(1, "keep this one line  A b c d e f g h i j. and that line as it is", 40), (2, "a b c d e f g h i j k", 5), (3, None, 0), (4, "clean", 99)],
        "doc_id long, text string, n_chars long",
    )
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    out = {r.doc_id: r for r in dc.decontaminated(docs, items).collect()}
    assert sorted(out) == [1, 3, 4]  # a row hit over half of its words goes
    assert out[1].text == "keep this one line . and that line as it is" and out[1].n_chars == len(out[1].text)
    assert out[3].text is None and tuple(out[4]) == (4, "clean", 99)


def test_digest_of_no_items(spark):
    r = {x.doc_id: x for x in QUERIES["op10_decontamination"](spark, SF).collect()}
    clean = [x for x in r.values() if not x.contaminated]
    assert clean and all(x.items_sha256 == hashlib.sha256(b"").hexdigest() for x in clean)
