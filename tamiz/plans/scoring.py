"""The scoring job: load what was fitted, predict new rows, report where labels are known."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, Roles, drop_missing_rows, quoted, select_columns, standardise_types
from tamiz.functions.labels import map_labels
from tamiz.operators.evaluate import classification_report, confusion_matrix, goodness
from tamiz.operators.knn import KnnModel
from tamiz.operators.missing import ImputeSpec, fit_imputer
from tamiz.operators.score import spread_probabilities
from tamiz.plans.preparation import Preparation
from tamiz.sources.models import Model, load_model, load_preparation
from tamiz.sources.sinks import write_predictions


@dataclass(frozen=True)
class Scored:
    """``predictions``: key, features, [true class id], predicted_value, one probability per class.
    ``report`` is None for a table without labels."""

    predictions: DataFrame
    report: DataFrame | None


def predict(model: Model, df: DataFrame, key: str) -> DataFrame:
    return model.transform(df, key) if isinstance(model, KnnModel) else model.transform(df)


def evaluate_model(
    model: Model, df: DataFrame, key: str, name: str, measure: str = "weighted f1-score", target: str = TARGET
) -> tuple[DataFrame, DataFrame]:
    """(report, goodness) of a model on prepared rows with a class id; both with a column ``model``."""
    named = predict(model, df, key).withColumn("model", F.lit(name))
    report = classification_report(confusion_matrix(named, target, by=["model"]), ["model"])
    return report, goodness(report, measure)


def score(
    df: DataFrame,
    prep: Preparation,
    model: Model,
    target: str | None = None,
    refill: tuple[ImputeSpec, ...] | None = None,
) -> Scored:
    """Score ``df`` with the statistics of the training rows. ``refill`` instead fills its missing cells
    from the table itself. Rows with an unknown label are scored but not reported."""
    prep = prep.for_new_rows()
    wanted = [prep.key, *prep.numerical, *prep.categorical, *([target] if target else [])]
    typed = standardise_types(select_columns(df, wanted), Roles(prep.numerical, prep.categorical, key=prep.key))
    if target:
        typed = map_labels(typed, target, prep.label_map).drop(target)
    if refill is not None:
        encoded = prep.encode(drop_missing_rows(typed, prep.drop_missing))
        filled = fit_imputer(encoded, refill, "self", None).transform(encoded)
        rows = prep.scaler.transform(filled) if prep.scaler else filled
    else:
        rows = prep.transform(typed)
    scored = predict(model, rows, prep.key)
    predictions = spread_probabilities(scored, prep.label_map)
    if not target:
        return Scored(predictions, None)
    confusion = confusion_matrix(predictions.select(quoted(TARGET), "predicted_value"))
    return Scored(predictions, classification_report(confusion))


def score_stored(
    spark: SparkSession,
    df: DataFrame,
    folder: str,
    target: str | None = None,
    output: str | None = None,
    name: str | None = None,
) -> Scored:
    """Load preparation and model (the best, or one by name) from ``folder``, score, and optionally write the
    predictions."""
    result = score(df, load_preparation(spark, folder), load_model(spark, folder, name), target)
    if output is not None:
        write_predictions(result.predictions, output)
    return result
