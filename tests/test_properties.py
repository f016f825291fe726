"""Properties: bands are monotone, slot flags equal a plain reading of the array,
enrichment joins keep the row count, reruns give the same rows, the predictor
hook equals the expression model."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from duescore import testbed as tb
from duescore.functions.arrays import slot_tag_flags
from duescore.operators import enrich as en
from duescore.operators import score as sc
from duescore.spec import CARD_BAND_EDGES, CONTACT_TAGS

SF = "/root/testdata/sf0.001"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=0.0, max_value=1.0, allow_nan=False), min_size=1, max_size=40))
def test_band_is_monotone(spark, ps):
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = sorted((r["p"], r["b"]) for r in df.select("p", sc.score_band("p", CARD_BAND_EDGES).alias("b")).collect())
    bands = [b for _, b in got]
    assert bands == sorted(bands)
    for p, b in got:
        assert b == sum(1 for e in CARD_BAND_EDGES if p > e)


TAG = st.sampled_from(["skip:hot", "skip:alto", "skip:nhot", "other", None])
SLOTS = st.one_of(st.none(), st.lists(st.one_of(st.none(), st.lists(TAG, max_size=3)), max_size=4))


def _python_flags(arr, slots):
    out = {}
    for i in range(slots):
        slot = arr[i] if arr is not None and i < len(arr) else None
        for t in CONTACT_TAGS:
            if slot is None:
                hit = None
            elif t in slot:
                hit = True
            elif None in slot:
                hit = None
            else:
                hit = False
            out[f"T{i + 1}_{t}"] = (hit is None) if t == "sem_tags" else bool(hit)
    return out


@settings(max_examples=5, deadline=None)
@given(st.lists(SLOTS, min_size=1, max_size=20))
def test_slot_flags_equal_python_reading(spark, arrays):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, t array<array<string>>")
    out = df.select("i", *slot_tag_flags("t", 3, CONTACT_TAGS, "T")).collect()
    for r in out:
        expect = _python_flags(arrays[r["i"]], 3)
        assert {k: r[k] for k in expect} == expect
        for i in range(3):                       # never a tag and sem_tags together without a null in the slot
            tags = [r[f"T{i + 1}_{t}"] for t in CONTACT_TAGS[:-1]]
            assert not (any(tags) and r[f"T{i + 1}_sem_tags"]) or _has_null(arrays[r["i"]], i)


def _has_null(arr, i):
    return arr is not None and i < len(arr) and arr[i] is not None and None in arr[i]


def test_enrichment_keeps_row_count(spark):
    people = tb.debts(spark, SF).select("_id", F.col("document").alias("CPF")).distinct()
    n = people.count()
    others = tb.debts(spark, SF).filter(F.col("creditor") != tb.CREDITOR)
    assert en.exists_flag(people, others, ["_id"], ["_id"], "f").count() == n
    sim = tb.simulation(spark, SF)
    assert en.count_asof(people, sim, "personID", "_id", "n", tb.CREDITOR, "createdAt", tb.FILE_DAY).count() == n
    own = tb.debts(spark, SF).filter(F.col("creditor") == tb.CREDITOR).select("_id", "contract")
    rows = people.join(own, "_id").withColumnRenamed("contract", "CONTA")
    assert en.exists_same_creditor(rows, own, "g").count() == rows.count()


def test_rerun_gives_same_rows(spark):
    q = entry.queries()["feature_base_card"]
    a = sorted(map(tuple, q(spark, SF).collect()), key=repr)
    b = sorted(map(tuple, q(spark, SF).collect()), key=repr)
    assert a == b


def test_predictor_hook_equals_expression_model(spark):
    coef = {"x": 0.5, "y": -0.25}
    df = spark.createDataFrame([(str(i), float(i) / 10, float(i % 3)) for i in range(50)], "id string, x double, y double")

    def predict(pdf):
        z = 0.1 + 0.5 * pdf["x"] - 0.25 * pdf["y"]
        return 1.0 / (1.0 + (-z).map(math.exp))

    a = {r["Chave"]: r["P_1"] for r in sc.score_with_predictor(df, "id", ["x", "y"], predict).collect()}
    b = {r["Chave"]: r["P_1"] for r in sc.score_linear(df, "id", coef, 0.1).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


# -- brute-force references of the file rule, on small random fixtures ------------

import datetime as _dt  # noqa: E402

from duescore.operators import contact as _ct  # noqa: E402
from duescore.functions import text as _fx  # noqa: E402

DAY0 = _dt.date(2024, 1, 1)
STATUSES = ["open", "expired", "broken", "settled"]


def _pairwise_labels(days, deals):
    """The file rule: every (day, deal) pair of a person, labelled, newest deal kept per (person, day)."""
    out = {}
    for p, d in days:
        mine = [x for x in deals if x[0] == p]
        if not mine:
            out[(p, d)] = "ATIVADO"
            continue
        _, top_date, _, status = max(mine, key=lambda x: x[1])
        if d is None:
            out[(p, d)] = "NAO_ATIVADO"
        elif d <= top_date or status in ("expired", "broken"):
            out[(p, d)] = "ATIVADO"
        else:
            out[(p, d)] = "NAO_ATIVADO"
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=15,
                unique=True),
       st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 30), st.sampled_from(STATUSES)), max_size=10))
def test_latest_deal_labels_equal_pairwise_rule(spark, day_rows, deal_rows):
    # one deal date per person per day value, so the file rule's "newest deal" is unambiguous
    seen, deals = set(), []
    for i, (p, off, s) in enumerate(deal_rows):
        if (p, off) not in seen:
            seen.add((p, off))
            deals.append((p, DAY0 + _dt.timedelta(days=off), f"d{i:03d}", s))
    days = [(p, None if off is None else DAY0 + _dt.timedelta(days=off)) for p, off in day_rows]
    ddf = spark.createDataFrame([(p, d, "email") for p, d in days], "document string, DT_INTERACAO date, type string")
    deal_df = spark.createDataFrame(deals, "CPF string, DT_ACORDO date, dealID string, status string")
    lab = _ct.activation_label(_ct.pivot_channel_day(ddf, ["email"]), _ct.latest_deal(deal_df), ["email"])
    got = {(r["document"], r["DT_INTERACAO"]): r["ATIVACAO"] for r in lab.collect()}
    assert got == _pairwise_labels(days, deals)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=20))
def test_earliest_per_group_equals_brute_force(spark, rows):
    data = [(p, c, f"k{i}", None if o is None else DAY0 + _dt.timedelta(days=o)) for i, (p, c, o) in enumerate(rows)]
    df = spark.createDataFrame(data, "_id string, creditor string, contract string, d date")
    got = sorted(r["contract"] for r in en.earliest_per_group(df, ["_id", "creditor"], "d").collect())
    want = []
    for p, c, k, d in data:
        dates = [x[3] for x in data if x[0] == p and x[1] == c and x[3] is not None]
        if d is not None and dates and d == min(dates):
            want.append(k)
    assert got == sorted(want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["+", "-", ""]), st.integers(0, 10 ** 7), st.integers(0, 99)),
                min_size=1, max_size=20))
def test_signed_decimal_equals_python_reading(spark, amounts):
    texts = [f"{s}{i:09d},{c:02d}" for s, i, c in amounts]
    df = spark.createDataFrame([(t,) for t in texts], "a string")
    got = [(r[0], r[1]) for r in df.select(_fx.parse_signed_decimal("a"),
                                           _fx.parse_signed_decimal("a", strict_sign=True)).collect()]
    want = []
    for t in texts:
        body = t.lstrip("+")
        lenient = float(body.replace(",", "."))
        strict = float(t.split("+")[1].replace(",", ".")) if "+" in t else None
        want.append((lenient, strict))
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from("abcde")), min_size=1, max_size=60), st.integers(1, 20))
def test_salted_join_equals_plain_left_join(spark, keys, hot_rows):
    from duescore.operators.enrich import hot_keys, salted_left_join
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    facts = spark.createDataFrame([(k, ord(k)) for k in "abc"] + [(None, -1)], "fk string, f int")
    counts = left.groupBy(F.col("k").alias("fk")).count()
    hot = hot_keys(counts, ["fk"], "count", hot_rows, 3)
    got = sorted(map(tuple, salted_left_join(left, facts, ["k"], ["fk"], hot).select("k", "v", "f").collect()),
                 key=repr)
    want = sorted([(k, i, (-1 if k is None else (ord(k) if k in "abc" else None))) for i, k in enumerate(keys)],
                  key=repr)
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["sms", "call", "email", "push"]),
                          st.one_of(st.none(), st.sampled_from(["NOVO_1", "x", "", "aNOVOb"]))), min_size=1, max_size=25))
def test_channel_counts_equal_python_reading(spark, rows):
    df = spark.createDataFrame(rows, "document string, type string, campaign_name string")
    chans = (("sms", "SMS"), ("call", "VOICE"), ("email", "EMAIL"))
    got = {r["document"]: r.asDict() for r in _ct.channel_counts(df, chans, "NOVO").collect()}
    for doc in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == doc]
        for v, t in chans:
            marked = sum(1 for _, ty, n in mine if ty == v and n is not None and "NOVO" in n)
            plain = sum(1 for _, ty, n in mine if ty == v and not (n is not None and "NOVO" in n))
            assert got[doc][f"ACION_{t}_QTD_NAO_ATIVADO"] == marked
            assert got[doc][f"ACION_{t}_QTD_ATIVADO"] == plain


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["7", "07", "123", "1234567890123"]),
                          st.floats(min_value=0.0, max_value=1.0, allow_nan=False)), min_size=1, max_size=30))
def test_rollup_equals_python_reading(spark, rows):
    from duescore.spec import CARD_BAND_EDGES
    data = [(k, p, sum(1 for e in CARD_BAND_EDGES if p > e)) for k, p in rows]
    pre = spark.createDataFrame(data, "Chave string, P_1 double, GH int")
    got = {r["Document"]: (r["Score"], r["ScoreValue"], r["ScoreAvg"])
           for r in sc.score_rollup(pre, 11, "p", "2024-01-15", "2024-01-16").collect()}
    want = {}
    for k, p, b in data:
        want.setdefault(k.rjust(11, "0")[:11], []).append((p, b))
    assert set(got) == set(want)
    for d, items in want.items():
        score, value, avg = got[d]
        assert score == max(b for _, b in items) and value == max(p for p, _ in items)
        assert abs(avg - sum(p for p, _ in items) / len(items)) < 1e-12
