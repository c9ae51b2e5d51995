"""Stored models: what was fitted on the training rows, and the model itself, under one folder."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tamiz.operators.encode import Factorizer
from tamiz.operators.cells import NeighbourIndex
from tamiz.operators.knn import KnnModel, SearchTable, search_table
from tamiz.operators.missing import Imputer
from tamiz.operators.rescale import Scaler
from tamiz.operators.tree import ExactTree, MllibTree
from tamiz.plans.preparation import Preparation
from tamiz.sources.sinks import read_text, write_text

Model = KnnModel | ExactTree | MllibTree


def save_preparation(spark: SparkSession, prep: Preparation, folder: str) -> None:
    state = {
        "numerical": prep.numerical,
        "categorical": prep.categorical,
        "label_map": prep.label_map,
        "key": prep.key,
        "drop_missing": prep.drop_missing,
        "imputer": prep.imputer.values if prep.imputer else None,
        "scaler": prep.scaler.values if prep.scaler else None,
        "dropped": prep.scaler.dropped if prep.scaler else (),
        "factor_sizes": prep.factorizer.sizes if prep.factorizer else None,
        "factor_volumes": prep.factorizer.volumes if prep.factorizer else None,
        "split": prep.split,
        "text_imputer": prep.text_imputer.values if prep.text_imputer else None,
    }
    write_text(spark, json.dumps(state), f"{folder}/preparation")
    if prep.factorizer:
        prep.factorizer.dictionary.write.mode("overwrite").parquet(f"{folder}/dictionary")


def load_preparation(spark: SparkSession, folder: str) -> Preparation:
    d = json.loads(read_text(spark, f"{folder}/preparation"))
    scaler = None
    if d["scaler"] is not None:
        values = {c: {s: tuple(v) for s, v in by.items()} for c, by in d["scaler"].items()}
        scaler = Scaler(values, tuple(d["dropped"]), d["split"])
    factorizer = None
    if d["factor_sizes"] is not None:
        factorizer = Factorizer(spark.read.parquet(f"{folder}/dictionary"), d["factor_sizes"], d["factor_volumes"])
    return Preparation(
        numerical=tuple(d["numerical"]),
        categorical=tuple(d["categorical"]),
        label_map=d["label_map"],
        key=d["key"],
        drop_missing=tuple(d["drop_missing"]),
        imputer=Imputer(d["imputer"], d["split"]) if d["imputer"] is not None else None,
        scaler=scaler,
        factorizer=factorizer,
        split=d["split"],
        text_imputer=Imputer(d["text_imputer"], d["split"]) if d["text_imputer"] is not None else None,
    )


def save_models(spark: SparkSession, models: Mapping[str, Model], best: str, folder: str) -> None:
    """All models of a sweep. KNN models share their training rows, stored once as parquet, and beyond the direct form
    one index for each distance; exact trees are their nodes; MLlib trees store themselves. No row passes the driver."""
    states: dict[str, dict] = {}
    nearest = [m for m in models.values() if isinstance(m, KnnModel)]
    if nearest:
        save_search(spark, nearest, folder)
    for i, (name, model) in enumerate(models.items()):
        if isinstance(model, KnnModel):
            state = {"kind": "knn", "features": model.features, "label_map": model.label_map}
            states[name] = {**state, "k": model.k, "weights": model.weights, "p": model.p}
        elif isinstance(model, ExactTree):
            states[name] = {"kind": "exact_tree", "tree": model.to_json()}
        else:
            model.model.write().overwrite().save(f"{folder}/mllib/{i}")
            states[name] = {"kind": "mllib_tree", "features": model.features, "classes": model.classes, "place": i}
    write_text(spark, json.dumps({"best": best, "models": states}), f"{folder}/models")


def save_search(spark: SparkSession, models: Sequence[KnnModel], folder: str) -> None:
    """What neighbours are searched among, for models that share their training rows."""
    shared = models[0]
    shared.train.write.mode("overwrite").parquet(f"{folder}/train")
    k = max(m.k for m in models)
    table = shared.table if shared.table is not None and shared.table.k >= k else search_table(shared.train, k, shared.limits)
    state = {"n": table.n, "width": table.width, "k": table.k, "direct": table.direct, "p": sorted({m.p for m in models})}
    if not table.direct:
        for p in state["p"]:
            table.index(p).save(f"{folder}/index/{p}")
    write_text(spark, json.dumps(state), f"{folder}/search")


def load_search(spark: SparkSession, folder: str, p: int, train: DataFrame) -> SearchTable:
    """Only what searches by the distance ``p`` need."""
    d = json.loads(read_text(spark, f"{folder}/search"))
    if d["direct"]:
        return SearchTable(train, d["n"], d["width"], d["k"], True)
    index = NeighbourIndex.load(spark, f"{folder}/index/{p}")
    points = index.points.select("train_id", "features", "label")
    return SearchTable(points, d["n"], d["width"], d["k"], False, indexes={p: index})


def load_model(spark: SparkSession, folder: str, name: str | None = None) -> Model:
    """A stored model by name; the best one without a name."""
    stored = json.loads(read_text(spark, f"{folder}/models"))
    name = stored["best"] if name is None else name
    if name not in stored["models"]:
        raise ValueError(f"no model '{name}' in {folder}, only {sorted(stored['models'])}")
    d = stored["models"][name]
    if d["kind"] == "knn":
        train = spark.read.parquet(f"{folder}/train")
        table = load_search(spark, folder, d["p"], train)
        return KnnModel(train, tuple(d["features"]), d["label_map"], d["k"], d["weights"], d["p"], table=table)
    if d["kind"] == "exact_tree":
        return ExactTree.from_json(d["tree"])
    return MllibTree(PipelineModel.load(f"{folder}/mllib/{d['place']}"), tuple(d["features"]), tuple(d["classes"]))
