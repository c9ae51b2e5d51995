"""Scored tables: class labels and probability columns next to the rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tamiz.functions.columns import quoted
from tamiz.functions.labels import labels_by_id, lookup, probability_columns


def spread_probabilities(predictions: DataFrame, label_map: Mapping[str, int], column: str = "probabilities") -> DataFrame:
    """The probability array as one column per class, ``probability_of_value_<label>`` by class id."""
    names = probability_columns(label_map)
    kept = [quoted(c) for c in predictions.columns if c != column]
    return predictions.select(*kept, *[quoted(column)[i].alias(n) for i, n in enumerate(names)])


def restore_labels(
    scored: DataFrame, label_map: Mapping[str, int], columns: Mapping[str, str]
) -> DataFrame:
    """Class ids back to labels: {id column: name of the label column}."""
    inverse = {label_map[label]: label for label in labels_by_id(label_map)}
    out = []
    for name in scored.columns:
        column = quoted(name)
        if name in columns:
            column = lookup(column, inverse, "string").alias(columns[name])
        out.append(column)
    return scored.select(*out)


def attach(table: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Left equi-join of separately stored results on the key. A repeated key in ``results`` would repeat
    rows: it must be unique there. Tables scored in one go carry their columns and need no join."""
    return table.join(results, key, "left")
