"""Boosted trees as arrays: read from and written to the plain text form of tree lists, evaluated inside Spark."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Up to so many leaves the ensemble becomes one expression; a larger one would outgrow generated methods.
EXPRESSION_LEAVES = 256


@dataclass
class Tree:
    """Inner nodes with feature, threshold and children; a negative child -k-1 is leaf k. A value up to the threshold goes left."""

    leaf_value: list[float]
    split_feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left_child: list[int] = field(default_factory=list)
    right_child: list[int] = field(default_factory=list)

    def column(self, features: list[Column], node: int = 0) -> Column:
        if node < 0 or not self.split_feature:
            return F.lit(float(self.leaf_value[-node - 1 if node < 0 else 0]))
        left, right = (self.column(features, k) for k in (self.left_child[node], self.right_child[node]))
        return F.when(features[self.split_feature[node]] <= F.lit(float(self.threshold[node])), left).otherwise(right)

    def values(self, x: np.ndarray) -> np.ndarray:
        leaves = np.asarray(self.leaf_value, float)
        if not self.split_feature:
            return np.full(len(x), leaves[0])
        feature, border = np.asarray(self.split_feature), np.asarray(self.threshold)
        left, right = np.asarray(self.left_child), np.asarray(self.right_child)
        node = np.zeros(len(x), np.int64)
        while (open_ := node >= 0).any():
            k = node[open_]
            node[open_] = np.where(x[open_, feature[k]] <= border[k], left[k], right[k])
        return leaves[-node - 1]


@dataclass
class Ensemble:
    feature_names: tuple[str, ...]
    trees: list[Tree]
    sigmoid: float = 1.0

    def probability(self, columns: list[Column] | None = None) -> Column:
        """The logistic of the sum of all trees."""
        features = columns or [F.col(n) for n in self.feature_names]
        if sum(len(t.leaf_value) for t in self.trees) <= EXPRESSION_LEAVES:
            total = F.lit(0.0)
            for t in self.trees:
                total = total + t.column(features)
        else:

            @F.pandas_udf("double")
            def added(*parts: pd.Series) -> pd.Series:
                x = np.column_stack([p.to_numpy(float) for p in parts])
                return pd.Series(sum(t.values(x) for t in self.trees))

            total = added(*features)
        return 1 / (1 + F.exp(-F.lit(self.sigmoid) * total))

    def to_text(self) -> str:
        head = ["tree", "version=v4", "num_class=1", f"max_feature_idx={len(self.feature_names) - 1}", f"objective=binary sigmoid:{self.sigmoid:g}", "feature_names=" + " ".join(self.feature_names), ""]
        for i, t in enumerate(self.trees):
            row = lambda k, v: f"{k}=" + " ".join(repr(x) if isinstance(x, float) else str(x) for x in v)
            head += [f"Tree={i}", f"num_leaves={len(t.leaf_value)}", "num_cat=0", row("split_feature", t.split_feature), row("threshold", t.threshold), row("decision_type", [2] * len(t.threshold)), row("left_child", t.left_child), row("right_child", t.right_child), row("leaf_value", t.leaf_value), ""]
        return "\n".join([*head, "end of trees", ""])

    @classmethod
    def from_text(cls, text: str) -> Ensemble:
        """Numeric splits only; categorical splits, zeros as missing values and linear leaves are errors. Features are never missing, so a split's default side isn't used."""
        body = text.split("end of trees")[0]
        blocks = body.split("\nTree=")
        head = dict(line.split("=", 1) for line in blocks[0].splitlines() if "=" in line)
        if not head.get("objective", "").startswith("binary"):
            raise ValueError("Only binary tree models can be read.")
        trees = []
        for block in blocks[1:]:
            facts = dict(line.split("=", 1) for line in block.splitlines() if "=" in line)
            if int(facts.get("num_cat", "0")):
                raise ValueError("Categorical splits can't be read.")
            kinds = [int(float(v)) for v in facts.get("decision_type", "").split()]
            if any(k & 1 for k in kinds):
                raise ValueError("Categorical splits can't be read.")
            if any(k >> 2 & 3 == 1 for k in kinds):
                raise ValueError("Splits that take zero as missing can't be read.")
            if int(facts.get("is_linear", "0")):
                raise ValueError("Linear leaves can't be read.")
            numbers = lambda k, kind: [kind(v) for v in facts.get(k, "").split()]  # noqa: E731, B023
            trees.append(Tree(numbers("leaf_value", float), numbers("split_feature", int), numbers("threshold", float), numbers("left_child", int), numbers("right_child", int)))
        sigmoid = next((float(p.split(":")[1]) for p in head["objective"].split() if p.startswith("sigmoid:")), 1.0)
        return cls(tuple(head["feature_names"].split()), trees, sigmoid)

    @classmethod
    def from_gbt(cls, model, feature_names: tuple[str, ...], num_leaves: int | None = None) -> Ensemble:
        """The trees of a fitted GBTClassificationModel; its margin counts twice in the logistic.

        A tree keeps the `num_leaves` leaves that best-first growth reaches: of all open nodes that of the largest gain
        is split next.
        """
        return cls(tuple(feature_names), [_pruned(tree._java_obj.rootNode(), weight, num_leaves) for tree, weight in zip(model.trees, model.treeWeights, strict=True)], 2.0)


def _pruned(root, weight: float, num_leaves: int | None) -> Tree:
    kept, open_ = set(), [("", root)]
    nodes = {"": root}
    while num_leaves is None or len(kept) + 1 < num_leaves:
        inner = [(name, n) for name, n in open_ if n.subtreeDepth() > 0]
        if not inner:
            break
        name, node = max(inner, key=lambda x: (x[1].gain(), -len(x[0]), x[0]))
        kept.add(name)
        children = [(name + "l", node.leftChild()), (name + "r", node.rightChild())]
        nodes.update(children)
        open_ = [x for x in open_ if x[0] != name] + children
    tree = Tree([])

    def walk(name: str) -> int:
        node = nodes[name]
        if name not in kept:
            tree.leaf_value.append(float(node.prediction()) * weight)
            return -len(tree.leaf_value)
        at, split = len(tree.split_feature), node.split()
        for part, value in ((tree.split_feature, int(split.featureIndex())), (tree.threshold, float(split.threshold())), (tree.left_child, 0), (tree.right_child, 0)):
            part.append(value)
        tree.left_child[at], tree.right_child[at] = walk(name + "l"), walk(name + "r")
        return at

    walk("")
    return tree
