"""Parameter sweeps that share their work between models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, feature_array, quoted
from tamiz.functions.labels import class_counts
from tamiz.operators.evaluate import best_model, classification_report, confusion_matrix, goodness
from tamiz.operators.knn import SearchLimits, SearchTable, nearest_neighbours, search_table, training_table, votes, winner
from tamiz.operators.tree import ExactTree, MllibTree, fit_mllib_tree, fit_trees, present
from tamiz.session import materialise

FITS_AT_A_TIME = 3
TREE_METHODS = ("exact", "binned", "mllib")


@dataclass(frozen=True)
class KnnGrid:
    # The default grid.
    k: tuple[int, ...] = (1, 3, 5)
    weights: tuple[str, ...] = ("uniform", "distance")
    p: tuple[int, ...] = (1, 2)

    def models(self) -> dict[str, tuple[int, str, int]]:
        """{name: (k, weights, p)} in grid order: weights, then k, then p."""
        return {f"KNN-k:{k}-p:{p}-w:{w}": (k, w, p) for w in self.weights for k in self.k for p in self.p}


@dataclass(frozen=True)
class TreeGrid:
    # The default grid.
    max_depth: tuple[int, ...] = (3, 6, 9)
    min_leaf: tuple[int, ...] = (1, 2)

    def models(self) -> dict[str, tuple[int, int]]:
        """{name: (max_depth, min_leaf)} in grid order: depth, then leaf size."""
        return {f"DecisionTree-z:{d}-l:{m}": (d, m) for d in self.max_depth for m in self.min_leaf}


@dataclass(frozen=True)
class SweepResult:
    """``report``: (model, row, precision, recall, f1_score, support). ``best``: one row (name, value). ``table``: the
    training rows as neighbours were searched among them."""

    report: DataFrame
    best: DataFrame
    models: Mapping[str, object]
    table: SearchTable | None = None


def _model_confusion(scored: DataFrame, predictions: Mapping[str, Column], label: str) -> DataFrame:
    """Confusion counts of many models from one pass over their common input."""
    each = F.array(
        *[F.struct(F.lit(name).alias("model"), p.alias("predicted_value")) for name, p in predictions.items()]
    )
    long = scored.select(quoted(label).alias("_label"), F.explode(each).alias("m"))
    return confusion_matrix(long.select("_label", "m.*"), "_label", by=["model"])


def _result(confusion: DataFrame, models: Mapping[str, object], measure: str) -> SweepResult:
    # At most (models * classes^2) rows, used twice.
    report = classification_report(materialise(confusion, "confusion"), ["model"])
    return SweepResult(report, best_model(goodness(report, measure), list(models)), models)


def sweep_knn(
    train: DataFrame,
    dev: DataFrame,
    features: Sequence[str] | Column,
    classes: Sequence[int],
    key: str = "row_id",
    label: str = TARGET,
    grid: KnnGrid = KnnGrid(),
    measure: str = "weighted f1-score",
    limits: SearchLimits = SearchLimits(),
) -> SweepResult:
    """One neighbour search per distance, at the largest k; every model is a vote on its neighbours."""
    vector = features if isinstance(features, Column) else feature_array(features)
    table = search_table(training_table(train, lambda: vector, key, label), max(grid.k), limits)
    asked = dev.select(quoted(key), quoted(label), vector.alias("features"))
    models = grid.models()
    parts = []
    for p in grid.p:
        found = nearest_neighbours(table, asked, max(grid.k), p, key, limits)
        predictions = {
            name: winner(votes("neighbours", classes, k, w), classes)
            for name, (k, w, p_of) in models.items()
            if p_of == p
        }
        parts.append(_model_confusion(found, predictions, label))
    return replace(_result(reduce(DataFrame.unionByName, parts), models, measure), table=table)


def tree_method(method: str | None, exact: bool = True) -> str:
    if method is None:
        return "exact" if exact else "mllib"
    if method not in TREE_METHODS:
        raise ValueError(f"unknown trees '{method}', one of {TREE_METHODS}")
    return method


def sweep_tree(
    train: DataFrame,
    dev: DataFrame,
    features: Sequence[str],
    label: str = TARGET,
    grid: TreeGrid = TreeGrid(),
    measure: str = "weighted f1-score",
    exact: bool = True,
    max_bins: int = 256,
    classes: Sequence[int] | None = None,
    method: str | None = None,
) -> SweepResult:
    """Trees of all depths and leaf sizes. ``method``: "exact" and "binned" trees are grown once for all models, to the
    largest depth, where a shallower one is the top; "mllib" trees are fitted apart, a few at a time, on the stored
    table. Without it ``exact`` tells whether the trees are exact or of MLlib."""
    method = tree_method(method, exact)
    names = grid.models()
    if method != "mllib":
        grown = fit_trees(
            train, features, label, max(grid.max_depth), grid.min_leaf, classes=classes,
            exact=method == "exact", max_bins=max_bins if method == "binned" else None,
        )
        models: dict[str, ExactTree | MllibTree] = {n: grown[m] for n, (_, m) in names.items()}
        vector = present(feature_array(features))
        predictions = {n: grown[m].predict(F.col("_x"), d) for n, (d, m) in names.items()}
        scored = dev.select(quoted(label), vector.alias("_x"))
        confusion = _model_confusion(scored, predictions, label)
    else:
        ids = classes if classes is not None else list(class_counts(train, label))

        def fit(size: tuple[int, int]) -> MllibTree:
            return fit_mllib_tree(train, features, label, *size, max_bins=max_bins, classes=ids)

        # Small jobs of one fit leave the cluster idle; a few fits side by side fill it.
        with ThreadPoolExecutor(FITS_AT_A_TIME) as pool:
            models = dict(zip(names, pool.map(fit, names.values())))
        parts = [
            confusion_matrix(t.transform(dev).withColumn("model", F.lit(n)), label, by=["model"])
            for n, t in models.items()
        ]
        confusion = reduce(DataFrame.unionByName, parts)
    return _result(confusion, models, measure)
