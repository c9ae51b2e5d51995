"""Missing values: drop rows, or fill with a fitted or given value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.columns import columns_except, nan_to_null, quoted
from tamiz.operators.statistics import ALL_ROWS, FeatureStats, by_scope, collect_statistics, exact_median, mode

# Names of the fill methods, and the text of the category made for missing cells.
METHODS = ("MEAN", "MEDIAN", "MODE", "CONSTANT", "CREATE_CATEGORY")
NULL_CATEGORY = "NULL_CATEGORY"

# train: fitted on the training rows, applied everywhere. per_split: each split by its own values.
# self: fitted on the very table that is filled.
SCOPES = ("train", "per_split", "self")


@dataclass(frozen=True)
class ImputeSpec:
    feature: str
    method: str
    value: float | str | None = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown fill method '{self.method}', one of {METHODS}")
        if self.method == "CONSTANT" and self.value is None:
            raise ValueError(f"CONSTANT fill of '{self.feature}' needs a value")


def impute_all(columns: Sequence[str], method: str, exceptions: Sequence[str] = ()) -> list[ImputeSpec]:
    """The same method for all columns but the exceptions."""
    return [ImputeSpec(c, method) for c in columns_except(columns, exceptions)]


def fitting_rows(df: DataFrame, scope: str, split: str | None) -> tuple[DataFrame, str | None]:
    """Rows to fit on, and the column to group by."""
    if scope not in SCOPES:
        raise ValueError(f"unknown scope '{scope}', one of {SCOPES}")
    if scope == "self":
        return df, None
    if split is None:
        raise ValueError(f"scope '{scope}' needs a split column")
    return (df, split) if scope == "per_split" else (df.where(quoted(split) == "train"), None)


@dataclass(frozen=True)
class Imputer:
    """Fitted fill values: {feature: {scope: value}}. ``transform`` is a projection with literals."""

    values: dict[str, dict[str, float | str | None]]
    split: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for field in df.schema.fields:
            column = quoted(field.name)
            if field.name in self.values:
                sql_type = field.dataType.simpleString()
                if isinstance(field.dataType, T.IntegralType) and any(map(_fraction, self.values[field.name].values())):
                    # A whole-number column takes a fraction as it is.
                    sql_type, column = "double", column.cast("double")
                if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                    column = nan_to_null(column)
                filler = by_scope(self.values[field.name], self.split, sql_type)
                column = F.coalesce(column, filler).alias(field.name)
            out.append(column)
        return df.select(*out)


def _fraction(value: float | str | None) -> bool:
    return isinstance(value, float) and not value.is_integer()


def _is_text(df: DataFrame, feature: str) -> bool:
    return isinstance(df.schema[feature].dataType, T.StringType)


def check_specs(df: DataFrame, specs: Sequence[ImputeSpec]) -> None:
    for s in specs:
        if s.feature not in df.columns:
            raise ValueError(f"no column '{s.feature}' to fill")
        if s.method == "CREATE_CATEGORY" and not _is_text(df, s.feature):
            raise ValueError(f"CREATE_CATEGORY needs a text column, '{s.feature}' is none")
        if s.method in ("MEAN", "MEDIAN") and _is_text(df, s.feature):
            raise ValueError(f"{s.method} needs a numeric column, '{s.feature}' is text")


def fit_imputer(
    df: DataFrame,
    specs: Sequence[ImputeSpec],
    scope: str = "train",
    split: str | None = "split",
    statistics: dict[str, dict[str, FeatureStats]] | None = None,
) -> Imputer:
    """Fill values of all features: one scan for the means (none if ``statistics`` are given), and one
    job for all medians and for all modes of a type."""
    check_specs(df, specs)
    rows, group = fitting_rows(df, scope, split)
    chosen = {m: [s.feature for s in specs if s.method == m] for m in METHODS}
    found: dict[str, dict[str, float | str | None]] = {s.feature: {} for s in specs}

    if chosen["MEAN"]:
        statistics = statistics or collect_statistics(rows, chosen["MEAN"], group)
        for name, stats in statistics.items():
            for feature in chosen["MEAN"]:
                found[feature][name] = stats[feature].mean
    if chosen["MEDIAN"]:
        for r in exact_median(rows, chosen["MEDIAN"], group).collect():
            found[r["feature"]][r["scope"]] = r["median"]
    text = [c for c in chosen["MODE"] if _is_text(df, c)]
    for features, value_type in ((text, "string"), (columns_except(chosen["MODE"], text), "double")):
        if features:
            for r in mode(rows, features, group, value_type).collect():
                found[r["feature"]][r["scope"]] = r["mode"]
    for s in specs:
        if s.method == "CONSTANT":
            found[s.feature] = {ALL_ROWS: s.value}
        elif s.method == "CREATE_CATEGORY":
            found[s.feature] = {ALL_ROWS: NULL_CATEGORY}
    return Imputer(found, split if group else None)
