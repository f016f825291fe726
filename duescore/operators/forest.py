"""Boosted trees of any size as flat node arrays (M1).

A published list of trees as expressions (``score_trees``) is fine for a handful of
them; a real model of hundreds of trees would become a plan of many thousand nested
conditions.  Here the model is data: feature, threshold, children, missing direction and
value of every node in six arrays, read from a trainer's JSON dump (nothing is run on
load) or from ``Split`` objects.  A task scores an Arrow batch by walking all of a
block's rows down all trees level by level; leaves point to themselves, so a row that
has arrived stays.  One narrow pass, no shuffle; the model is sent once per executor.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .score import Scorer, Split

#: Rows times trees walked at a time (a few arrays of this many small integers).
BLOCK_CELLS = 1 << 20


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, one after the other; ``root`` holds each tree's first node.
    A leaf is its own child.  ``depth`` is the longest way from a root to a leaf."""

    features: tuple[str, ...]
    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    depth: int
    base: float = 0.0
    single: bool = False

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The summed leaves of each row of ``x`` (rows, features); NaN is missing.

        The sum runs over the trees in their order, so it equals the expression's."""
        if self.single:  # a trainer with single-precision inputs compares in single precision
            x = x.astype(np.float32)
        out = np.full(len(x), self.base)
        if not len(self.features):
            return out + float(np.sum(self.value[self.root]))
        step = max(1, BLOCK_CELLS // max(1, len(self.root)))
        for lo in range(0, len(x), step):
            part = np.ascontiguousarray(x[lo : lo + step])
            flat, row = part.ravel(), (np.arange(len(part), dtype=np.int64) * part.shape[1])[:, None]
            node = np.broadcast_to(self.root, (len(part), len(self.root)))
            for _ in range(self.depth):
                at = flat[row + self.feature[node]]
                goes_left = np.where(np.isnan(at), self.missing_left[node], at < self.threshold[node])
                node = np.where(goes_left, self.left[node], self.right[node])
            for leaf in self.value[node].T:
                out[lo : lo + step] += leaf
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-self.margin(x)))


class _Nodes:
    """Collects nodes of all trees."""

    def __init__(self, features: Sequence[str]):
        self.place = {name: k for k, name in enumerate(features)}
        self.rows: list[list] = []
        self.roots: list[int] = []
        self.depth = 0

    def add(self, depth: int) -> int:
        self.rows.append([0, 0.0, len(self.rows), len(self.rows), False, 0.0])
        self.depth = max(self.depth, depth)
        return len(self.rows) - 1

    def split(self, node: int, feature: str, threshold: float, left: int, right: int, missing_left: bool) -> None:
        place = self.place.setdefault(feature, len(self.place))
        self.rows[node] = [place, float(threshold), left, right, missing_left, 0.0]

    def forest(self, base: float, single: bool) -> Forest:
        kinds = (np.int32, np.float32 if single else np.float64, np.int32, np.int32, bool, np.float64)
        columns = [np.array(c, k) for c, k in zip(zip(*self.rows), kinds)] if self.rows else [np.zeros(0, k) for k in kinds]
        return Forest(tuple(self.place), np.array(self.roots, np.int32), *columns, depth=self.depth, base=base, single=single)


def forest_of_splits(trees: Sequence[Split | float], base: float = 0.0) -> Forest:
    """The flat form of published trees."""
    nodes = _Nodes(())
    for tree in trees:
        nodes.roots.append(nodes.add(0))
        todo = [(tree, nodes.roots[-1], 0)]
        while todo:
            node, at, depth = todo.pop()
            if not isinstance(node, Split):
                nodes.rows[at][5] = float(node)
                continue
            left, right = nodes.add(depth + 1), nodes.add(depth + 1)
            nodes.split(at, node.feature, node.threshold, left, right, node.missing_left)
            todo += [(node.right, right, depth + 1), (node.left, left, depth + 1)]
    return nodes.forest(base, False)


def forest_of_dump(text: str, base: float = 0.0, names: Sequence[str] = (), single: bool = False) -> Forest:
    """A trainer's JSON dump: a list of trees of nested nodes with ``nodeid`` and either
    ``leaf`` or ``split``, ``split_condition``, ``yes``, ``no``, ``missing``, ``children``.

    ``yes`` is taken below the condition; ``missing`` names the child that a row without
    a value takes.  ``names`` gives the model's feature list, so that the order is that of
    the model and unknown features are refused; without it features go by first use.
    ``single`` compares in single precision.  Malformed trees are refused with the
    tree's number, and nothing of the text is ever run.
    """
    trees = json.loads(text)
    if not isinstance(trees, list):
        raise ValueError("a dump is a list of trees")
    nodes = _Nodes(names)
    for number, tree in enumerate(trees):
        nodes.roots.append(nodes.add(0))
        todo = [(tree, nodes.roots[-1], 0)]
        while todo:
            node, at, depth = todo.pop()
            try:
                if "leaf" in node:
                    nodes.rows[at][5] = float(node["leaf"])
                    continue
                feature, threshold = node["split"], float(node["split_condition"])
                children = {c["nodeid"]: c for c in node["children"]}
                below, above, missing = children[node["yes"]], children[node["no"]], node["missing"]
                if below is above or len(children) != 2 or missing not in (node["yes"], node["no"]):
                    raise ValueError("children")
                if names and feature not in nodes.place:
                    raise ValueError(f"unknown feature {feature!r}")
            except (KeyError, TypeError, ValueError) as wrong:
                raise ValueError(f"tree {number} of the dump cannot be read: {wrong}") from wrong
            left, right = nodes.add(depth + 1), nodes.add(depth + 1)
            nodes.split(at, feature, threshold, left, right, missing == node["yes"])
            todo += [(above, right, depth + 1), (below, left, depth + 1)]
    return nodes.forest(base, single)


def forest_of_model(model, feature_columns: Sequence[str]) -> Forest:
    """The flat form of a model fitted here (``fit_gbt``), so that it can be kept as a dump
    and scored without Spark ML.  Its inputs are the imputed features and their
    missing-value indicators, in the order of ``imputed``; a Spark tree sends values up to the
    threshold left, so the threshold moves to the next larger number, and the margin is
    doubled as the classifier's logistic does."""
    gbt = model.stages[-1]._java_obj
    count = len(feature_columns)
    names = [f"{kind}{k}" for kind in "fm" for k in range(count)]
    nodes = _Nodes(names)
    for tree, weight in zip(gbt.trees(), gbt.treeWeights()):
        nodes.roots.append(nodes.add(0))
        todo = [(tree.rootNode(), nodes.roots[-1], 0)]
        while todo:
            node, at, depth = todo.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                nodes.rows[at][5] = 2.0 * float(weight) * node.prediction()
                continue
            left, right = nodes.add(depth + 1), nodes.add(depth + 1)
            split = node.split()
            nodes.split(at, names[split.featureIndex()], float(np.nextafter(split.threshold(), np.inf)), left, right, False)
            todo += [(node.rightChild(), right, depth + 1), (node.leftChild(), left, depth + 1)]
    return nodes.forest(0.0, False)


def imputed(model, df: DataFrame, id_column: str, feature_columns: Sequence[str]) -> DataFrame:
    """The inputs of ``forest_of_model``: each feature or its median, and whether it was missing."""
    out = model.stages[0].transform(df)
    count = len(feature_columns)
    return out.select(F.col(f"`{id_column}`").alias(id_column), *[F.col(f"__{kind}{k}").alias(f"{kind}{k}") for kind in "fm" for k in range(count)])


def dump_of_forest(forest: Forest) -> str:
    """The trees in the format that ``forest_of_dump`` reads."""

    def node(at: int) -> dict:
        left, right = int(forest.left[at]), int(forest.right[at])
        if left == at:
            return {"nodeid": at, "leaf": float(forest.value[at])}
        return {"nodeid": at, "split": forest.features[forest.feature[at]], "split_condition": float(forest.threshold[at]), "yes": left, "no": right,
                "missing": left if forest.missing_left[at] else right, "children": [node(left), node(right)]}

    return json.dumps([node(int(r)) for r in forest.root])


def read_forest(df_reader, path: str, **kw) -> Forest:
    """A dump file through the session's file system (``spark.read``); it is read as one text."""
    rows = df_reader.option("wholetext", True).text(path).take(2)
    if len(rows) != 1:
        raise ValueError(f"{path} is not one file")
    return forest_of_dump(rows[0][0], **kw)


def score_forest(df: DataFrame, id_column: str, forest: Forest, out: str = "P_1") -> DataFrame:
    """(Chave, probability) of every row; a null or NaN feature is missing (M1)."""
    model = df.sparkSession.sparkContext.broadcast(forest)
    width = len(forest.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.empty((b.num_rows, width))
            for k in range(width):
                x[:, k] = b.column(k + 1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.value.probability(x))], names=["Chave", out])

    # Positional names on the way to Python: a feature may have any name.
    columns = [F.col(f"`{c}`").cast("double").alias(f"__f{k}") for k, c in enumerate(forest.features)]
    return df.select(F.col(f"`{id_column}`").cast("string").alias("Chave"), *columns).mapInArrow(run, f"Chave string, `{out}` double")


def forest_scorer(forest: Forest) -> Scorer:
    return Scorer(forest.features, lambda df, key: score_forest(df, key, forest))
