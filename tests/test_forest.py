"""Flat node arrays against recursion, against tree expressions, and from dumps."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duescore import testbed as tb
from duescore.operators import forest as fo
from duescore.operators import score as sc

value = st.floats(-10, 10).map(lambda x: round(x, 2))
trees = st.recursive(value, lambda sub: st.builds(sc.Split, st.sampled_from("abc"), value, sub, sub, st.booleans()), max_leaves=12)
rows = st.lists(st.tuples(*[st.one_of(st.none(), value)] * 3), min_size=1, max_size=6)


def walked(node, row):
    while isinstance(node, sc.Split):
        x = row["abc".index(node.feature)]
        left = node.missing_left if x is None else x < node.threshold
        node = node.left if left else node.right
    return node


def dumped(node, number=0):
    """(dump of a node, next free number)"""
    if not isinstance(node, sc.Split):
        return {"nodeid": number, "leaf": node}, number + 1
    left, after = dumped(node.left, number + 1)
    right, end = dumped(node.right, after)
    return {"nodeid": number, "split": node.feature, "split_condition": node.threshold, "yes": left["nodeid"], "no": right["nodeid"],
            "missing": (left if node.missing_left else right)["nodeid"], "children": [right, left]}, end


@settings(max_examples=80, deadline=None)
@given(st.lists(trees, max_size=5), rows, value)
def test_margin_is_that_of_recursion(forest, table, base):
    want = []
    for row in table:
        z = base
        for t in forest:
            z += walked(t, row)
        want.append(z)
    x = np.array([[math.nan if v is None else v for v in row] for row in table])
    by_split = fo.forest_of_splits(forest, base)
    by_dump = fo.forest_of_dump(json.dumps([dumped(t)[0] for t in forest]), base, "abc")
    at = ["abc".index(f) for f in by_split.features]
    assert np.allclose(by_split.margin(x[:, at]), want, rtol=0, atol=1e-12)
    assert np.allclose(by_dump.margin(x), want, rtol=0, atol=1e-12)


def test_equals_the_tree_expressions(spark):
    from duescore.operators import features as fe
    from duescore.queries import CARD_GROUPS, card_base

    base = card_base(spark, "/root/testdata/sf0.001")
    names = sc.tree_features(tb.CARD_TREES)
    feats = fe.feature_vector(base, "CPF", names, CARD_GROUPS, tb.AS_OF)
    old = sc.score_trees(feats, "CPF", tb.CARD_TREES, tb.CARD_TREE_BASE).collect()
    forest = fo.forest_of_splits(tb.CARD_TREES, tb.CARD_TREE_BASE)
    new = fo.forest_scorer(forest).apply(feats, "CPF").collect()
    assert forest.features == sc.tree_features(tb.CARD_TREES)
    assert sorted((r.Chave, round(r.P_1, 12)) for r in new) == sorted((r.Chave, round(r.P_1, 12)) for r in old)


def test_nulls_nan_and_odd_names(spark):
    forest = fo.forest_of_splits([sc.Split("a.b", 1.0, -1.0, sc.Split("c d", 2.0, 1.0, 3.0, missing_left=False), missing_left=False)])
    df = spark.createDataFrame([("1", 0.5, None), ("2", None, 1), ("3", float("nan"), None), ("4", 1.0, 2)], "id string, `a.b` double, `c d` int")
    out = {r.Chave: r.P_1 for r in fo.score_forest(df, "id", forest).collect()}
    assert out == pytest.approx({k: 1 / (1 + math.exp(-z)) for k, z in {"1": -1.0, "2": 1.0, "3": 3.0, "4": 3.0}.items()})
    assert fo.score_forest(df.limit(0), "id", forest).collect() == []
    assert {r.P_1 for r in fo.score_forest(df, "id", fo.forest_of_splits([0.5, -0.5])).collect()} == {0.5}


def test_single_precision_compares_as_the_trainer_does():
    dump = json.dumps([{"nodeid": 0, "split": "a", "split_condition": 0.1, "yes": 1, "no": 2, "missing": 1,
                        "children": [{"nodeid": 1, "leaf": -1.0}, {"nodeid": 2, "leaf": 1.0}]}])
    x = np.array([[0.09999999999]])
    assert fo.forest_of_dump(dump).margin(x) == [-1.0]
    assert fo.forest_of_dump(dump, single=True).margin(x) == [1.0]


LEAF = {"nodeid": 1, "leaf": 1.0}
SPLIT = {"nodeid": 0, "split": "a", "split_condition": 1, "yes": 1, "no": 2, "missing": 1, "children": [LEAF, {"nodeid": 2, "leaf": 2.0}]}


@pytest.mark.parametrize("change", [
    {"split_condition": None}, {"yes": 7}, {"no": 1}, {"missing": 5}, {"children": []}, {"children": [LEAF, LEAF]}, {"split": "z"}, {"split_condition": "x"},
])
def test_malformed_dumps_are_refused(change):
    assert len(fo.forest_of_dump(json.dumps([SPLIT]), names="a").value) == 3
    with pytest.raises(ValueError, match="tree 1 "):
        fo.forest_of_dump(json.dumps([LEAF, SPLIT | change]), names="a")
    with pytest.raises(ValueError):
        fo.forest_of_dump(json.dumps(SPLIT))


def test_model_of_full_size_and_its_plan(spark, tmp_path):
    (tmp_path / "model.json").write_text(tb.forest_dump())
    forest = fo.read_forest(spark.read, str(tmp_path / "model.json"), base=tb.FOREST_BASE, names=tuple(tb.FOREST_RANGES))
    assert len(forest.root) == 500 and forest.depth == 6 and len(forest.value) == 500 * 127
    df = fo.score_forest(tb.customer_features(spark, "/root/testdata/sf0.1"), "c_custkey", forest)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 10_000 and "CASE" not in plan
    assert df.count() == spark.read.parquet("/root/testdata/sf0.1/customer.parquet").count()


def test_a_fitted_model_as_flat_nodes(spark):
    """Spark ML's probabilities are a reference for the flat walk, and the walk for them."""
    import random
    rng = random.Random(5)
    rows = [(str(i), None if i % 7 == 0 else rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.0, None]), float(i % 3)) for i in range(400)]
    df = spark.createDataFrame([(*r, float((r[1] or 0) + (r[2] or 0) * (r[3] - 1) > 0.3)) for r in rows], "id string, `a.b` double, c double, d double, label double")
    names = ["a.b", "c", "d"]
    model = sc.fit_gbt(df, names, "label", max_iter=8, max_depth=3)
    forest = fo.forest_of_model(model, names)
    again = fo.forest_of_dump(fo.dump_of_forest(forest), names=forest.features)
    want = {r.Chave: r.P_1 for r in sc.score_model(model, df, "id").collect()}
    for flat in (forest, again):
        got = {r.Chave: r.P_1 for r in fo.score_forest(fo.imputed(model, df, "id", names), "id", flat).collect()}
        assert got == pytest.approx(want, abs=1e-12) and len(set(got.values())) > 20
    right = sum((want[r.id] > 0.5) == (r.label == 1.0) for r in df.collect())
    assert right > 0.9 * len(rows)
