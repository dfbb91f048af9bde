"""A given tree ensemble as one native column expression.

A tree is a leaf (a number) or ``Node(feature, test, left, right)``.  ``test``
is a threshold (a value up to it goes left) or the values that go left; a null
feature goes right.  Each tree becomes nested conditions, the ensemble their
weighted sum in order, so scoring is a projection that Catalyst prunes and
compiles with the rest of the plan: no model object, vectors or Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Node:
    feature: str | int
    test: float | tuple
    left: "Tree"
    right: "Tree"


Tree = Union[float, Node]


@dataclass(frozen=True)
class Ensemble:
    """Weighted trees; class 1 where the margin is above 0."""

    trees: tuple[Tree, ...]
    weights: tuple[float, ...]
    bias: float = 0.0

    def __post_init__(self):
        if len(self.trees) != len(self.weights):
            raise ValueError(f"{len(self.trees)} trees but {len(self.weights)} weights")

    def features(self) -> list:
        """Features the trees test, each once, in order of appearance."""
        out: dict = {}

        def walk(tree: Tree) -> None:
            if isinstance(tree, Node):
                out[tree.feature] = None
                walk(tree.left)
                walk(tree.right)

        for t in self.trees:
            walk(t)
        return list(out)


def tree_value(tree: Tree, feature: Callable[[str | int], Column]) -> Column:
    """The leaf a row reaches."""
    if not isinstance(tree, Node):
        return F.lit(float(tree))
    x = feature(tree.feature)
    goes_left = x.isin(*tree.test) if isinstance(tree.test, tuple) else x <= F.lit(tree.test)
    # a null condition is not met: null features go right
    return F.when(goes_left, tree_value(tree.left, feature)).otherwise(tree_value(tree.right, feature))


def margin(ensemble: Ensemble, feature: Callable[[str | int], Column] = F.col) -> Column:
    """Bias plus the weighted leaves, summed in the order of the trees."""
    total = F.lit(float(ensemble.bias))
    for tree, weight in zip(ensemble.trees, ensemble.weights):
        total = total + F.lit(float(weight)) * tree_value(tree, feature)
    return total


def score_ensemble(df: DataFrame, ensemble: Ensemble, served: Sequence[str], feature: Callable[[str | int], Column] = F.col) -> DataFrame:
    """``served`` columns, ``margin`` and ``prediction`` (1.0 where the margin is above 0, else 0.0)."""
    missing = [c for c in [*served, *(f for f in ensemble.features() if isinstance(f, str))] if c not in df.columns]
    if missing and feature is F.col:
        raise ValueError(f"Columns not found: {missing}")
    total = margin(ensemble, feature)
    return df.select(*served, total.alias("margin"), F.when(total > 0, 1.0).otherwise(0.0).alias("prediction"))


def from_mllib(model) -> Ensemble:
    """The trees of a fitted gradient-boosted classifier; features are indices
    of its vector (``lambda i: vector[i]`` of an array column)."""

    def walk(node) -> Tree:
        if node.getClass().getSimpleName() == "LeafNode":
            return float(node.prediction())
        split = node.split()
        if split.getClass().getSimpleName() == "CategoricalSplit":
            test: float | tuple = tuple(float(x) for x in split.leftCategories())
        else:
            test = float(split.threshold())
        return Node(int(split.featureIndex()), test, walk(node.leftChild()), walk(node.rightChild()))

    return Ensemble(tuple(walk(t._call_java("rootNode")) for t in model.trees), tuple(float(w) for w in model.treeWeights))


def by_name(columns: Mapping[str | int, Column]) -> Callable[[str | int], Column]:
    """Feature lookup in given columns."""
    return lambda f: columns[f]
