"""Probability, bands, roll-up per person.

``score_linear`` and ``score_trees`` are expressions (they stay in codegen and have
exact oracles).  A model trained here is applied with Spark ML ``transform``
(distributed, no driver copy), or a user's predictor runs per Arrow batch through
``mapInPandas``.  A ``Scorer`` names the features that a model takes and applies
it, so every pipeline takes any of them.  Models are stored with Spark ML writers,
never as pickles that run code on load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pad_document


def linear_probability(coefficients: dict[str, float], intercept: float, missing_as_zero: bool = True) -> Column:
    """``1 / (1 + exp(-z))`` with ``z = intercept + sum(w * x)`` (M2)."""
    z = F.lit(float(intercept))
    for name, w in coefficients.items():
        x = F.col(f"`{name}`").cast("double")
        if missing_as_zero:
            x = F.coalesce(x, F.lit(0.0))
        z = z + F.lit(float(w)) * x
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_linear(df: DataFrame, id_column: str, coefficients: dict[str, float], intercept: float,
                 out: str = "P_1") -> DataFrame:
    return df.select(F.col(id_column).alias("Chave"), linear_probability(coefficients, intercept).alias(out))


def score_band(p: Column | str, edges: Sequence[float]) -> Column:
    """Band of a probability with right-closed upper edges: ``p <= e0`` is 0 ... (M3).

    A missing probability has no band (Q16).
    """
    p = F.col(p) if isinstance(p, str) else p
    expr = F.when(p.isNull(), F.lit(None).cast("int"))
    for i, e in enumerate(edges):
        expr = expr.when(p <= F.lit(float(e)), F.lit(i))
    return expr.otherwise(F.lit(len(edges)))


def with_band(df: DataFrame, edges: Sequence[float], p: str = "P_1", out: str = "GH") -> DataFrame:
    return df.withColumn(out, score_band(p, edges))


def score_rollup(scores: DataFrame, width: int, provider: str, file_date: str, created_at: str,
                 key: str = "Chave", band: str = "GH", prob: str = "P_1") -> DataFrame:
    """One published row per person: padded document, max band, max and mean probability.

    Values are numeric before the max, so "max" is numeric, not text order (Q1).
    """
    s = scores.select(pad_document(key, width).alias("Document"), F.col(band).cast("int").alias(band),
                      F.col(prob).cast("double").alias(prob))
    return s.groupBy("Document").agg(
        F.max(band).alias("Score"), F.max(prob).alias("ScoreValue"), F.avg(prob).alias("ScoreAvg"),
    ).withColumns({
        "Provider": F.lit(provider),
        "Date": F.to_date(F.lit(file_date)),
        "CreatedAt": F.to_date(F.lit(created_at)),
    })


def band_histogram(scores: DataFrame, band: str = "GH") -> DataFrame:
    """Rows per band."""
    return scores.groupBy(band).agg(F.count(F.lit(1)).alias("n"))


# -- model application (M1) ----------------------------------------------------

@dataclass(frozen=True)
class Split:
    """A node of a published tree: below the threshold goes left; missing goes where ``missing_left`` says."""

    feature: str
    threshold: float
    left: "Split | float"
    right: "Split | float"
    missing_left: bool = True


def tree_margin(node: Split | float) -> Column:
    """The leaf value that a row reaches."""
    if not isinstance(node, Split):
        return F.lit(float(node))
    x = F.col(f"`{node.feature}`")
    left, right = tree_margin(node.left), tree_margin(node.right)
    return F.when(x.isNull(), left if node.missing_left else right).when(x < F.lit(float(node.threshold)), left).otherwise(right)


def tree_features(trees: Sequence[Split | float]) -> tuple[str, ...]:
    """Features of a list of trees, in the order of their first use."""
    out: dict[str, None] = {}

    def visit(node: Split | float) -> None:
        if isinstance(node, Split):
            out.setdefault(node.feature)
            visit(node.left)
            visit(node.right)

    for t in trees:
        visit(t)
    return tuple(out)


def score_trees(df: DataFrame, id_column: str, trees: Sequence[Split | float], base: float = 0.0, out: str = "P_1") -> DataFrame:
    """Probability from a published list of boosted trees: the logistic of the summed leaves (M1)."""
    z = F.lit(float(base))
    for t in trees:
        z = z + tree_margin(t)
    return df.select(F.col(id_column).alias("Chave"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(out))


def fit_gbt(train: DataFrame, feature_columns: Sequence[str], label: str, max_iter: int = 20,
            max_depth: int = 4, seed: int = 7):
    """Boosted trees with imputation and missing-value indicators (M1).

    Spark's tree models refuse missing values, while the file rule's model
    takes them; imputing with the median plus one 0/1 indicator per feature
    keeps the information that a value was missing.  The stages work on
    positional names, so a feature may have any name (dots included), and a
    feature without any value gets a fixed surrogate.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import SQLTransformer, VectorAssembler

    feats = list(feature_columns)
    quoted = ["`" + c.replace("`", "``") + "`" for c in feats]
    medians = train.agg(*[F.percentile_approx(F.col(q).cast("double"), 0.5).alias(f"m{i}") for i, q in enumerate(quoted)]).first()
    columns = ", ".join(
        f"COALESCE(CAST({q} AS DOUBLE), CAST({float(medians[i] or 0.0)!r} AS DOUBLE)) AS `__f{i}`, CAST({q} IS NULL AS DOUBLE) AS `__m{i}`"
        for i, q in enumerate(quoted))
    stages = [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__{k}{i}" for k in "fm" for i in range(len(feats))], outputCol="features",
                        handleInvalid="keep"),
        GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed),
    ]
    return Pipeline(stages=stages).fit(train)


def score_model(model, df: DataFrame, id_column: str, out: str = "P_1") -> DataFrame:
    """Probability of class 1 from a fitted Spark ML model (M1)."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(df).select(F.col(id_column).alias("Chave"),
                                      vector_to_array("probability")[1].alias(out))


def score_with_predictor(df: DataFrame, id_column: str, feature_columns: Sequence[str],
                         predict: Callable[[pd.DataFrame], "pd.Series"], out: str = "P_1") -> DataFrame:
    """Apply a user's predictor per Arrow batch (M1): features in, probability out."""
    feats = list(feature_columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.set_axis(["Chave", *feats], axis=1)
            p = predict(b[feats])
            yield pd.DataFrame({"Chave": b["Chave"], out: pd.Series(p, index=b.index).astype(float)})

    # Positional names on the way to Python: a feature may have any name.
    columns = [F.col(id_column).cast("string").alias("__id"), *[F.col(f"`{c}`").alias(f"__f{i}") for i, c in enumerate(feats)]]
    return df.select(*columns).mapInPandas(run, schema=f"Chave string, {out} double")


# -- scorers: what a pipeline needs to know about a model ------------------------

@dataclass(frozen=True)
class Scorer:
    """A model's feature list, in its order, and how it is applied: rows with an id
    column and these features to (Chave, P_1)."""

    features: tuple[str, ...]
    apply: Callable[[DataFrame, str], DataFrame]


def linear_scorer(coefficients: dict[str, float], intercept: float) -> Scorer:
    return Scorer(tuple(coefficients), lambda df, key: score_linear(df, key, coefficients, intercept))


def tree_scorer(trees: Sequence[Split | float], base: float = 0.0) -> Scorer:
    return Scorer(tree_features(trees), lambda df, key: score_trees(df, key, trees, base))


def model_scorer(model, features: Sequence[str]) -> Scorer:
    """A fitted Spark ML model (``fit_gbt``)."""
    return Scorer(tuple(features), lambda df, key: score_model(model, df, key))


def predictor_scorer(predict: Callable[[pd.DataFrame], "pd.Series"], features: Sequence[str]) -> Scorer:
    return Scorer(tuple(features), lambda df, key: score_with_predictor(df, key, features, predict))
