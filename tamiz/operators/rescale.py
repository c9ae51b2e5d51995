"""Rescaling of numeric features; features without variance are dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import columns_except, quoted
from tamiz.operators.missing import Imputer, fitting_rows
from tamiz.operators.statistics import ALL_ROWS, FeatureStats, by_scope, collect_statistics

# Names of the methods. MINMAX: (x - min) / (max - min). AVGSTD: (x - mean) / sample std.
METHODS = ("MINMAX", "AVGSTD")


def rescale_all(columns: Sequence[str], method: str, exceptions: Sequence[str] = ()) -> dict[str, str]:
    """The same method for all columns but the exceptions."""
    return {c: method for c in columns_except(columns, exceptions)}


@dataclass(frozen=True)
class Scaler:
    """Fitted shift and scale: {feature: {scope: (shift, scale)}}, and the features to drop."""

    values: dict[str, dict[str, tuple[float | None, float | None]]]
    dropped: tuple[str, ...] = ()
    split: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        out = []
        for name in df.columns:
            if name in self.dropped:
                continue
            column = quoted(name)
            if name in self.values:
                shift = by_scope({k: v[0] for k, v in self.values[name].items()}, self.split, "double")
                scale = by_scope({k: v[1] for k, v in self.values[name].items()}, self.split, "double")
                column = ((column - shift) / scale).alias(name)
            out.append(column)
        return df.select(*out)


def shift_and_scale(stats: FeatureStats, method: str) -> tuple[float | None, float | None]:
    if stats.n == 0:
        return None, None
    if method == "MINMAX":
        return stats.min, stats.max - stats.min
    # A constant column has no variance, whatever the rounding of its mean.
    return stats.mean, 0.0 if stats.n > 1 and stats.min == stats.max else stats.std


def fit_scaler(
    df: DataFrame,
    specs: Mapping[str, str],
    scope: str = "train",
    split: str | None = "split",
    statistics: dict[str, dict[str, FeatureStats]] | None = None,
    imputer: Imputer | None = None,
) -> Scaler:
    """Shift and scale of all features. With ``imputer`` they describe the filled columns, although
    ``df`` or ``statistics`` are the unfilled ones: the fill enters in closed form."""
    unknown = {m for m in specs.values() if m not in METHODS}
    if unknown:
        raise ValueError(f"unknown rescale methods {sorted(unknown)}, one of {METHODS}")
    rows, group = fitting_rows(df, scope, split)
    if statistics is None:
        statistics = collect_statistics(rows, list(specs), group)
    values: dict[str, dict[str, tuple[float | None, float | None]]] = {c: {} for c in specs}
    for name, stats in statistics.items():
        for feature, method in specs.items():
            s = stats[feature]
            if imputer and feature in imputer.values:
                fills = imputer.values[feature]
                s = s.filled(fills.get(name, fills.get(ALL_ROWS)))
            values[feature][name] = shift_and_scale(s, method)
    dropped = [c for c, v in values.items() if any(scale == 0.0 for _, scale in v.values())]
    kept = {c: v for c, v in values.items() if c not in dropped}
    return Scaler(kept, tuple(dropped), split if group else None)


def scaler_table(scaler: Scaler, df: DataFrame) -> DataFrame:
    """The fitted values as a small table (feature, scope, shift, scale, dropped)."""
    rows = [(c, k, v[0], v[1], False) for c, by in scaler.values.items() for k, v in by.items()]
    rows += [(c, ALL_ROWS, None, None, True) for c in scaler.dropped]
    schema = "feature string, scope string, shift double, scale double, dropped boolean"
    return df.sparkSession.createDataFrame(rows, schema).orderBy(F.col("feature"), F.col("scope"))
