"""The training job: scan, coerce, label, split, prepare, balance, sweep, report, store the best model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from tamiz.functions.columns import TARGET, Roles, drop_missing_rows, quoted, select_columns, standardise_types
from tamiz.functions.labels import derive_label_map, drop_unknown_target, map_labels
from tamiz.operators.balance import AT_LEAST_HALF, NOT_MINORITY, undersample_splits
from tamiz.operators.encode import fit_factorizer
from tamiz.operators.evaluate import GOODNESS
from tamiz.operators.knn import KnnModel, SearchLimits, training_table
from tamiz.operators.missing import SCOPES, ImputeSpec, fit_imputer, impute_all
from tamiz.operators.rescale import rescale_all
from tamiz.operators.split import random_split, stratified_split
from tamiz.operators.sweep import KnnGrid, SweepResult, TreeGrid, sweep_knn, sweep_tree, tree_method
from tamiz.operators.tree import ExactTree
from tamiz.plans.preparation import Preparation, fit_fill_and_scale
from tamiz.session import materialise
from tamiz.sources.models import Model, save_models, save_preparation
from tamiz.sources.sinks import write_report_csv, write_reports

ALGORITHMS = ("KNN", "DecisionTree")
# Fills of a categorical feature that give a category; MEAN and MEDIAN work on its codes.
TEXT_METHODS = ("MODE", "CREATE_CATEGORY", "CONSTANT")


@dataclass(frozen=True)
class TrainConfig:
    roles: Roles
    # {label: class id}; without it the sorted labels of the table are numbered.
    label_map: Mapping[str, int] | None = None
    algorithm: str = "KNN"
    dev_size: float = 0.2
    seed: int = 42
    stratify: bool = True
    # Without preparation the table is only split.
    preprocess: bool = True
    drop_missing: tuple[str, ...] = ()
    # None: mean for all features, rescaled by mean and standard deviation.
    impute: tuple[ImputeSpec, ...] | None = None
    rescale: Mapping[str, str] | None = None
    scope: str = "train"
    # None: no undersampling. A ratio for two classes, 'not minority' otherwise.
    sampling: str | float | None = "auto"
    balance_dev: bool = False
    measure: str = "weighted f1-score"
    knn_grid: KnnGrid = field(default_factory=KnnGrid)
    tree_grid: TreeGrid = field(default_factory=TreeGrid)
    exact_tree: bool = True
    max_bins: int = 256
    # "exact", "binned" or "mllib"; without it ``exact_tree`` tells exact trees from those of MLlib.
    tree_method: str | None = None
    limits: SearchLimits = field(default_factory=SearchLimits)

    def __post_init__(self):
        for value, allowed in (
            (self.algorithm, ALGORITHMS),
            (self.measure, tuple(GOODNESS)),
            (self.scope, SCOPES),
        ):
            if value not in allowed:
                raise ValueError(f"'{value}' is none of {allowed}")
        tree_method(self.tree_method, self.exact_tree)
        if not self.roles.target:
            raise ValueError("training needs a target column")
        if not 0 < self.dev_size < 1:
            raise ValueError(f"dev_size is between 0 and 1, not {self.dev_size}")


@dataclass(frozen=True)
class Trained:
    preparation: Preparation
    sweep: SweepResult
    best_name: str
    best_value: float
    # All models of the grid by name.
    models: Mapping[str, Model]
    # The best one; the first of the grid if none scored above 0.
    model: Model
    train: DataFrame
    dev: DataFrame


def labelled(df: DataFrame, config: TrainConfig) -> tuple[DataFrame, Mapping[str, int]]:
    """Typed features, key and class id; rows with an unknown label leave."""
    roles = config.roles
    wanted = [roles.key, *roles.numerical, *roles.categorical, roles.target]
    typed = standardise_types(select_columns(df, wanted), Roles(roles.numerical, roles.categorical, key=roles.key))
    label_map = config.label_map or derive_label_map(typed, roles.target)
    mapped = drop_unknown_target(map_labels(typed, roles.target, label_map))
    return mapped.select(*[quoted(c) for c in (roles.key, *roles.numerical, *roles.categorical, TARGET)]), label_map


def prepare(df: DataFrame, config: TrainConfig) -> tuple[Preparation, DataFrame]:
    """Split and prepared rows (with a ``split`` column), and what was fitted for it."""
    roles = config.roles
    # The source is scanned again by each fit, pruned to its columns; nothing is copied.
    rows, label_map = labelled(df, config)
    if config.stratify:
        rows = stratified_split(rows, roles.key, TARGET, config.dev_size, config.seed)
    else:
        rows = random_split(rows, roles.key, 1 - config.dev_size, config.seed)
    base = Preparation(roles.numerical, roles.categorical, label_map, roles.key, split="split")
    features = [*roles.numerical, *roles.categorical]
    impute = impute_all(features, "MEAN") if config.impute is None else list(config.impute)
    in_text = [s for s in impute if s.feature in roles.categorical and s.method in TEXT_METHODS]
    if config.preprocess:
        base = replace(base, drop_missing=config.drop_missing)
        if in_text:
            # Categories are filled as text, before they become codes.
            present_rows = drop_missing_rows(rows, config.drop_missing)
            base = replace(base, text_imputer=fit_imputer(present_rows, in_text, config.scope, "split"))
    if roles.categorical:
        # Codes are fitted on the whole labelled table, before the split, and stored with the model.
        filled = base.text_imputer.transform(rows) if base.text_imputer else rows
        base = replace(base, factorizer=fit_factorizer(filled, roles.categorical, roles.key))
    if not config.preprocess:
        return base, base.transform(rows)
    rescale = rescale_all(features, "AVGSTD") if config.rescale is None else dict(config.rescale)
    numbers = [s for s in impute if s not in in_text]
    encoded = base.encode(drop_missing_rows(rows, config.drop_missing))
    imputer, scaler = fit_fill_and_scale(encoded, numbers, rescale, config.scope, "split")
    prep = replace(base, imputer=imputer, scaler=scaler)
    return prep, prep.transform(rows)


def train(df: DataFrame, config: TrainConfig, output: str | None = None) -> Trained:
    """Run the whole job; with ``output`` store reports, preparation and best model there."""
    key = config.roles.key
    prep, rows = prepare(df, config)
    if config.sampling is not None:
        strategy = config.sampling
        if strategy == "auto":
            strategy = AT_LEAST_HALF if len(prep.label_map) == 2 else NOT_MINORITY
        parts = ("train", "dev") if config.balance_dev else ("train",)
        rows = undersample_splits(rows, key, TARGET, strategy, config.seed + 1, "split", parts)
    # Written once, read by every model of the sweep.
    rows = materialise(rows, "prepared", partition_by="split")
    train_rows = rows.where(quoted("split") == "train").drop("split")
    dev_rows = rows.where(quoted("split") == "dev").drop("split")

    features = prep.features
    classes = sorted(prep.label_map.values())
    if config.algorithm == "KNN":
        sweep = sweep_knn(
            train_rows, dev_rows, features, classes, key, TARGET, config.knn_grid, config.measure, config.limits
        )
    else:
        sweep = sweep_tree(
            train_rows,
            dev_rows,
            features,
            TARGET,
            config.tree_grid,
            config.measure,
            config.exact_tree,
            config.max_bins,
            classes,
            config.tree_method,
        )
    models = build_models(sweep, train_rows, prep, config)
    best = sweep.best.first()
    model = models.get(best["name"]) or next(iter(models.values()))
    result = Trained(prep, sweep, best["name"], best["value"], models, model, train_rows, dev_rows)
    if output is not None:
        store(result, config, output)
    return result


def build_models(
    sweep: SweepResult, train_rows: DataFrame, prep: Preparation, config: TrainConfig
) -> dict[str, Model]:
    if config.algorithm == "KNN":
        table = training_table(train_rows, prep.features, config.roles.key, TARGET)
        labels = dict(prep.label_map)
        return {
            name: KnnModel(table, prep.features, labels, k, weights, p, config.limits, sweep.table)
            for name, (k, weights, p) in sweep.models.items()
        }
    depths = config.tree_grid.models()
    return {
        name: tree.cut(depths[name][0]) if isinstance(tree, ExactTree) else tree for name, tree in sweep.models.items()
    }


def store(result: Trained, config: TrainConfig, output: str) -> None:
    """``<output>/reports``, ``<output>/<algorithm>/reports_csv`` and ``<output>/models/<algorithm>``."""
    spark = result.train.sparkSession
    folder = output.rstrip("/")
    write_reports(result.sweep.report, folder, config.algorithm)
    write_report_csv(result.sweep.report, f"{folder}/{config.algorithm}")
    target = f"{folder}/models/{config.algorithm}"
    save_preparation(spark, result.preparation, target)
    best = next(name for name, model in result.models.items() if model is result.model)
    save_models(spark, result.models, best, target)
