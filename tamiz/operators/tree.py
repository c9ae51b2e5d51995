"""Decision trees: CART grown level by level, exact or binned, and MLlib's binned tree.

MLlib merges sibling leaves with equal prediction and never takes a split without gain, so its class
probabilities differ from those of an unpruned tree. The trees of ``growth`` have neither limit.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, feature_array, literal_array, quoted
from tamiz.functions.labels import class_counts
from tamiz.functions.running import running_totals
from tamiz.operators.balance import balanced_weights, with_class_weights
from tamiz.operators.growth import DECIMALS, Grown, Growth

# Larger trees go to the executors as arrays instead of SQL text.
LITERAL_NODES = 1024


def present(vector: Column) -> Column:
    """The vector; a NULL or NaN in it stops the job."""
    missing = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.when(missing, F.raise_error(F.lit("a tree needs features without missing values")).cast("array<double>")).otherwise(vector)


# ---------------------------------------------------------------- exact tree


@dataclass(frozen=True)
class Node:
    """``counts``: training rows per class. A leaf has feature -1."""

    depth: int
    counts: tuple[int, ...]
    feature: int = -1
    threshold: float = 0.0
    left: int = -1
    right: int = -1


@dataclass(frozen=True)
class ExactTree:
    nodes: tuple[Node, ...]
    classes: tuple[int, ...]
    weights: tuple[float, ...]
    features: tuple[str, ...]

    @property
    def depth(self) -> int:
        return max(n.depth for n in self.nodes)

    def leaf(self, vector: Column, depth: int | None = None) -> Column:
        """Node a feature vector ends in, optionally in the tree cut at ``depth``. A small tree is one expression
        over constant arrays; a larger one is walked by whole Arrow batches."""
        steps = min(self.depth, self.depth if depth is None else depth)
        if steps == 0:
            return F.lit(0)
        if len(self.nodes) > LITERAL_NODES:
            return self._walk(vector, steps)
        feature = literal_array([n.feature for n in self.nodes], "int")
        threshold = literal_array([n.threshold for n in self.nodes], "double")
        left = literal_array([n.left for n in self.nodes], "int")
        right = literal_array([n.right for n in self.nodes], "int")

        def step(node: Column, _: Column) -> Column:
            below = vector[feature[node]] <= threshold[node]
            return F.when(feature[node] < 0, node).when(below, left[node]).otherwise(right[node])

        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0), step)

    def _walk(self, vector: Column, steps: int) -> Column:
        feature = np.array([n.feature for n in self.nodes], dtype=np.int64)
        threshold = np.array([n.threshold for n in self.nodes])
        left, right = (np.array([getattr(n, side) for n in self.nodes], dtype=np.int64) for side in ("left", "right"))

        @F.pandas_udf("int")
        def walk(vectors: pd.Series) -> pd.Series:
            x = np.array(vectors.tolist(), dtype=np.float64).reshape(len(vectors), -1)
            node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
            for _ in range(steps):
                f = feature[node]
                to = np.where(x[rows, np.maximum(f, 0)] <= threshold[node], left[node], right[node])
                node = np.where(f < 0, node, to)
            return pd.Series(node.astype(np.int32))

        return walk(vector)

    def cut(self, depth: int) -> ExactTree:
        """The top of the tree: what growing to ``depth`` only would have given."""
        # Nodes are stored level by level, so the kept ones keep their positions.
        kept = [n for n in self.nodes if n.depth <= depth]
        ends = [Node(n.depth, n.counts) if n.depth == depth else n for n in kept]
        return ExactTree(tuple(ends), self.classes, self.weights, self.features)

    def leaf_shares(self) -> list[list[float]]:
        out = []
        for n in self.nodes:
            weighed = [c * w for c, w in zip(n.counts, self.weights)]
            total = sum(weighed)
            out.append([w / total for w in weighed])
        return out

    def leaf_classes(self) -> list[int]:
        """Class with the largest share, the smallest class id on a tie."""
        rounded = [[round(s, DECIMALS) for s in shares] for shares in self.leaf_shares()]
        return [self.classes[r.index(max(r))] for r in rounded]

    def predict(self, vector: Column, depth: int | None = None) -> Column:
        return literal_array(self.leaf_classes(), "long")[self.leaf(vector, depth)]

    def transform(self, df: DataFrame, depth: int | None = None) -> DataFrame:
        """``df`` with ``predicted_value`` and ``probabilities`` (in class id order, 0 for a class without training
        rows); a row with a missing feature stops the job."""
        placed = df.withColumn("_leaf", self.leaf(present(feature_array(self.features)), depth))
        c = len(self.classes)
        if len(self.nodes) * c <= LITERAL_NODES * 8:
            flat = literal_array([s for shares in self.leaf_shares() for s in shares], "double")
            return (
                placed.withColumn("predicted_value", literal_array(self.leaf_classes(), "long")[F.col("_leaf")])
                .withColumn("probabilities", F.slice(flat, F.col("_leaf") * c + 1, F.lit(c)))
                .drop("_leaf")
            )
        spark = df.sparkSession
        rows = zip(range(len(self.nodes)), self.leaf_classes(), self.leaf_shares())
        ends = spark.createDataFrame(list(rows), "_leaf int, predicted_value long, probabilities array<double>")
        # As large as the tree on the driver.
        return placed.join(F.broadcast(ends), "_leaf", "left").drop("_leaf")

    def to_json(self) -> str:
        nodes = [[n.depth, list(n.counts), n.feature, n.threshold, n.left, n.right] for n in self.nodes]
        return json.dumps(
            {"nodes": nodes, "classes": self.classes, "weights": self.weights, "features": self.features}
        )

    @staticmethod
    def from_json(text: str) -> ExactTree:
        d = json.loads(text)
        nodes = tuple(Node(n[0], tuple(n[1]), *n[2:]) for n in d["nodes"])
        return ExactTree(nodes, tuple(d["classes"]), tuple(d["weights"]), tuple(d["features"]))


def split_candidates(
    rows: DataFrame, classes: Sequence[int], weights: Sequence[float], min_leaf: int, at_most: int | None = None
) -> DataFrame:
    """All valid splits of all nodes: (node, feature, threshold, score, l_0.., t_0..).

    ``rows`` has (node, features, label). Rows become class counts per (node, feature, value), added up
    before the shuffle; the threshold is the middle between neighbouring values; ``score`` is the
    weighted gini impurity left after the split, as a share of the node's weight. ``at_most`` bounds the
    number of (node, feature, value) groups.
    """
    # As SQL text: the formulas have many terms, and each Column operation is a call of its own.
    names = [f"n_{i}" for i in range(len(classes))]
    counts = (
        rows.select("node", "label", F.posexplode("features").alias("feature", "value"))
        .groupBy("node", "feature", "value")
        .agg(*[F.expr(f"count_if(label = {c})").alias(n) for c, n in zip(classes, names)])
    )
    ranked = running_totals(counts, ["node", "feature"], "value", names, at_most)

    def add(terms: Sequence[str]) -> str:
        return "(" + " + ".join(terms) + ")"

    below = [f"{n}_before" for n in names]
    above = [f"({n}_total - {n}_before)" for n in names]
    weight = [f"{float(w)!r}D" for w in weights]

    def impurity(side: Sequence[str]) -> str:
        """Weight of a side times its gini impurity."""
        weighed = [f"{n} * {w}" for n, w in zip(side, weight)]
        squares = add([f"({x}) * ({x})" for x in weighed])
        return f"({add(weighed)} - try_divide({squares}, {add(weighed)}))"

    whole = add([f"{n}_total * {w}" for n, w in zip(names, weight)])
    return (
        ranked.where("value_prev IS NOT NULL")
        .where(f"{add(below)} >= {min_leaf} AND {add(above)} >= {min_leaf}")
        .selectExpr(
            "node",
            "feature",
            # Between neighbouring doubles there is no middle: then the lower one divides.
            "if(value_prev + (value - value_prev) / 2 < value, value_prev + (value - value_prev) / 2, value_prev) AS threshold",
            f"round(({impurity(below)} + {impurity(above)}) / {whole}, {DECIMALS}) AS score",
            *[f"{b} AS l_{i}" for i, b in enumerate(below)],
            *[f"{n}_total AS t_{i}" for i, n in enumerate(names)],
        )
    )


def best_splits(candidates: DataFrame) -> DataFrame:
    """One row per node: least impurity, then lowest feature, then lowest threshold."""
    rest = [c for c in candidates.columns if c not in ("node", "score", "feature", "threshold")]
    order = F.struct("score", "feature", "threshold", *rest)
    return candidates.groupBy("node").agg(F.min(order).alias("b")).select("node", "b.*")


def fit_exact_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    max_depth: int = 5,
    min_leaf: int = 1,
    balanced: bool = True,
    classes: Sequence[int] | None = None,
) -> ExactTree:
    """Gini CART with the best split at every node.

    A missing feature stops the job. ``classes``: all class ids, also those without rows, which then have probability 0;
    by default those of the rows.
    """
    return fit_trees(df, features, label, max_depth, (min_leaf,), balanced, classes)[min_leaf]


def fit_trees(
    df: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    max_depth: int = 5,
    leaf_sizes: Sequence[int] = (1,),
    balanced: bool = True,
    classes: Sequence[int] | None = None,
    exact: bool = True,
    max_bins: int | None = None,
) -> dict[int, ExactTree]:
    """A tree for each leaf size, all grown from the same passes over the rows. Not ``exact``: cut only between
    ``max_bins`` bins a feature, which is the same where it has no more values. Exact trees do not depend on it."""
    if max_depth < 0:
        raise ValueError(f"max_depth is 0 or more, not {max_depth}")
    if max_bins is not None and max_bins < 2:
        raise ValueError(f"max_bins is 2 or more, not {max_bins}")
    labelled = df.where(quoted(label).isNotNull())
    rows = labelled.select(quoted(label).cast("long").alias("label"), present(feature_array(features)).alias("features"))
    sizes = class_counts(rows, "label")
    if not sizes:
        raise ValueError("no rows to fit a tree on")
    if classes is not None and (unknown := set(sizes) - set(classes)):
        raise ValueError(f"labels that are no class: {sorted(unknown)}")
    by_class = balanced_weights(sizes) if balanced else {c: 1.0 for c in sizes}
    classes = sorted(sizes if classes is None else set(classes))
    weights = tuple(by_class.get(c, 1.0) for c in classes)
    counts, wanted = [sizes.get(c, 0) for c in classes], tuple(dict.fromkeys(leaf_sizes))
    if not exact and max_bins is None:
        max_bins = 256
    grown = Growth(rows, classes, weights, counts, len(features), wanted, max_depth, max_bins, exact).run()
    return {m: ExactTree(tuple(_level_by_level(grown, m)), tuple(classes), weights, tuple(features)) for m in wanted}


def _level_by_level(grown: Grown, leaf_size: int) -> list[Node]:
    """The nodes of one tree, numbered anew: level by level, left before right."""
    splits = grown.splits[leaf_size]
    order = [0]
    for node in order:
        if node in splits:
            order += [splits[node].left, splits[node].right]
    place = {node: i for i, node in enumerate(order)}
    out = []
    for node in order:
        known = grown.nodes[node]
        rest = ()
        if node in splits:
            s = splits[node]
            rest = (s.feature, s.threshold, place[s.left], place[s.right])
        out.append(Node(known.depth, tuple(known.counts.tolist()), *rest))
    return out


# ---------------------------------------------------------------- MLlib tree


@dataclass(frozen=True)
class MllibTree:
    """MLlib tree with the same face as the exact one. Inside, class ids are their positions in ``classes``."""

    model: PipelineModel
    features: tuple[str, ...]
    classes: tuple[int, ...]

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df)
        # MLlib knows the classes up to the last that has rows.
        shares = F.concat(vector_to_array("_probability"), F.array_repeat(F.lit(0.0), len(self.classes)))
        return scored.select(
            *[quoted(c) for c in df.columns],
            literal_array(self.classes, "long")[F.col("_prediction").cast("int")].alias("predicted_value"),
            F.slice(shares, 1, len(self.classes)).alias("probabilities"),
        )


def fit_mllib_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    max_depth: int = 5,
    min_leaf: int = 1,
    balanced: bool = True,
    max_bins: int = 256,
    seed: int = 1337,
    classes: Sequence[int] | None = None,
) -> MllibTree:
    """Gini tree on binned features: a fixed number of passes, sums per bin only. ``classes``: all class ids, also
    those without rows; by default those of the rows."""
    classes = sorted(class_counts(df, label) if classes is None else set(classes))
    place = F.array_position(literal_array(classes, "long"), quoted(label).cast("long"))
    unknown = F.raise_error(F.lit("a label that is no class")).cast("double")
    rows = df.withColumn("_label", F.when(place > 0, place - 1.0).otherwise(unknown))
    weight = {}
    if balanced:
        rows = with_class_weights(rows, label, "_weight")
        weight = {"weightCol": "_weight"}
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features")
    tree = DecisionTreeClassifier(
        labelCol="_label",
        featuresCol="_features",
        predictionCol="_prediction",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        impurity="gini",
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        maxBins=max_bins,
        seed=seed,
        **weight,
    )
    return MllibTree(Pipeline(stages=[assembler, tree]).fit(rows), tuple(features), tuple(classes))
