"""Latest row per key by packed numbers, and windows that keep each task's first rows."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duescore.operators import enrich as en
from duescore.operators import latest as la

hex_id = st.text(alphabet="0123456789abcdef", min_size=24, max_size=24)
ids = st.one_of(st.sampled_from(["9", "10", "100", "", None, "zé", "x" * 12, "x" * 13, "x" * 30, "a\x00", "A" * 24, "0" * 24, "00"]), hex_id)
days = st.one_of(st.none(), st.dates(dt.date(1, 1, 1), dt.date(9999, 12, 31)), st.sampled_from([dt.date(2024, 1, 1), dt.date(1970, 1, 1)]))
deals = st.lists(st.tuples(st.sampled_from(["p", "q", None]), days, ids, st.sampled_from([True, False, None])), max_size=15)


def best(rows):
    """Newest day, then largest id by its bytes; nulls last."""
    out = {}
    for k, d, i, f in rows:
        row = ((d is not None, d or dt.date.min), (i is not None, (i or "").encode()), bool(f))
        if k not in out or row > out[k][0]:
            out[k] = (row, (k, d, i, bool(f)))
    return sorted(repr(v) for _, v in out.values())


@settings(max_examples=25, deadline=None)
@given(deals)
def test_latest_by_number(spark, rows):
    df = spark.createDataFrame(rows, "k string, d date, i string, f boolean")
    out = la.latest_by_number(df, "k", "d", "i", F.col("f"), "f")
    assert sorted(repr(tuple(r)) for r in out.collect()) == best(rows)


def test_packed_keys_unpack(spark):
    rows = [(dt.date(2024, 2, 29), i) for i in ("1", "é" * 6, "f" * 24, "0" * 24, "abcdefabcdef")] + [(None, "7"), (dt.date(9999, 12, 31), "f" * 24)]
    df = spark.createDataFrame(rows, "d date, i string")
    key = la.packed_key(F.col("d"), F.col("i"), F.lit(True))
    out = df.select("d", "i", la.unpacked_day(key).alias("d2"), la.unpacked_id(key, la.id_kind(F.col("i"))).alias("i2"), la.unpacked_fact(key).alias("f"))
    assert all(r.d == r.d2 and r.i == r.i2 and r.f for r in out.collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_without_sort_aggregates(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.current_date().alias("d"), F.col("id").cast("string").alias("i"))
    for out in (la.latest_by_number(df, "k", "d", "i", F.lit(True), "f"), en.first_per_key(df, ["k"], [F.col("d")], ["i"])):
        plan = _plan(out)
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    plan = _plan(en.earliest_per_group(df, ["k"], "d"))
    assert plan.count("Range (") == 1 and plan.count("Exchange") == 1 and "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize("tied", [1, 500])
def test_hot_group_is_cut_before_the_shuffle(spark, tied):
    """Two thirds of the rows in one group: only its first rows are shuffled."""
    df = spark.range(0, 6000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 < 2, F.greatest(F.col("id"), F.lit(3 * tied // 2))).otherwise(F.lit(0)).alias("d"), "id")
    out = en.earliest_per_group(df, ["k"], "d")
    rows = df.collect()
    least = {}
    for r in rows:
        least[r.k] = min(least.get(r.k, r.d), r.d)
    assert sorted(r.id for r in out.collect()) == sorted(r.id for r in rows if r.d == least[r.k])
    limited = [line for line in _plan(out).splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert limited


def test_null_keys_and_dates_never_match(spark):
    df = spark.createDataFrame([("a", None, 1), (None, 1, 2), ("a", 3, 3), ("a", 3, 4), ("b", None, 5)], "k string, d int, i int")
    assert sorted(r.i for r in en.earliest_per_group(df, ["k"], "d").collect()) == [3, 4]
    first = en.first_per_key(df, ["k"], [F.col("d")], ["i"])
    assert sorted(repr(tuple(r)) for r in first.collect()) == ["('a', 1)", "('b', 5)", "(None, 2)"]
    last = en.first_per_key(df, ["k"], [F.col("d")], ["i"], latest=True)
    assert sorted(repr(tuple(r)) for r in last.collect()) == ["('a', 4)", "('b', 5)", "(None, 2)"]
