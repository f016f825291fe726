"""Trained models and published trees on the engine's own features."""

from pyspark.sql import functions as F

from duescore import testbed as tb
from duescore.operators import features as fe
from duescore.operators import score as sc
from duescore.plans.publish import propensity_scores
from duescore.queries import CARD_GROUPS, card_base

SF = "/root/testdata/sf0.001"


def test_boosted_trees_train_on_the_card_features(spark):
    names = list(tb.CARD_COEFFICIENTS)                      # has a dotted name and a feature absent from the base
    assert any("." in n for n in names) and "feature_not_in_base" in names
    base = card_base(spark, SF)
    feats = fe.feature_vector(base, "CPF", names, CARD_GROUPS, tb.AS_OF)
    train = feats.withColumn("label", (F.pmod(F.hash("CPF"), F.lit(2)) == 0).cast("double"))
    model = sc.fit_gbt(train, names, "label", max_iter=2, max_depth=2)
    scores = propensity_scores(base, tb.CARD, CARD_GROUPS, sc.model_scorer(model, names), tb.AS_OF, tb.FILE_DAY, tb.AS_OF)
    rows = scores.collect()
    assert rows and all(0 <= r.ScoreValue <= 1 and 0 <= r.Score <= 5 for r in rows)


def test_predictor_as_scorer(spark):
    df = spark.createDataFrame([("1", 2.0), ("2", None)], "CPF string, `a.b` double")
    out = sc.predictor_scorer(lambda x: x["a.b"].fillna(0.0) / 4, ["a.b"]).apply(df, "CPF")
    assert sorted(map(tuple, out.collect())) == [("1", 0.5), ("2", 0.0)]


def test_tree_branches(spark):
    tree = sc.Split("x", 1.0, sc.Split("y", 0.0, -1.0, 1.0, missing_left=False), 2.0)
    df = spark.createDataFrame([(0.5, -1.0), (0.5, None), (1.0, None), (None, 0.0)], "x double, y double")
    assert [r[0] for r in df.select(sc.tree_margin(tree)).collect()] == [-1.0, 1.0, 2.0, 1.0]
    assert sc.tree_features([tree, 3.0]) == ("x", "y")
    half = sc.score_trees(df.withColumn("id", F.lit("k")), "id", [0.0])
    assert {r.P_1 for r in half.collect()} == {0.5}


def test_features_go_by_column_type(spark):
    groups = fe.FeatureGroups(numeric=("n", "t"), categorical=("flag", "word"), dates=())
    df = spark.createDataFrame([("a", 2, "1,5", True, "x"), ("b", None, "?", None, None)],
                               "id string, n int, t string, flag boolean, word string")
    names = ["n", "t", "flag_True", "flag_False", "flag_S", "word_x", "flag"]
    out = {r["id"]: tuple(r)[1:] for r in fe.feature_vector(df, "id", names, groups, "2024-01-01").collect()}
    assert out["a"] == (2.0, 1.5, 1.0, 0.0, 0.0, 1.0, 1.0)
    assert out["b"] == (None, None, 0.0, 0.0, 0.0, 0.0, None)
    plan = fe.feature_vector(df, "id", ["n", "flag_True"], groups, "2024-01-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "cast(n" in plan and "as string" not in plan.replace("id#", "")
