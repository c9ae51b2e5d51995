"""Preparation of a table for a model: fitted once on training rows, applied as a lazy projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from tamiz.functions.columns import drop_missing_rows, quoted
from tamiz.operators.encode import Factorizer
from tamiz.operators.missing import ImputeSpec, Imputer, fit_imputer, fitting_rows
from tamiz.operators.rescale import Scaler, fit_scaler
from tamiz.operators.statistics import ALL_ROWS, collect_statistics


@dataclass(frozen=True)
class Preparation:
    """Order of the steps: drop rows, fill categories, encode them, fill numbers, rescale (features without variance
    leave)."""

    numerical: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    label_map: Mapping[str, int] | None = None
    key: str = "row_id"
    drop_missing: tuple[str, ...] = ()
    imputer: Imputer | None = None
    scaler: Scaler | None = None
    factorizer: Factorizer | None = None
    split: str | None = None
    # Fills categories as text, before they are encoded.
    text_imputer: Imputer | None = None

    @property
    def features(self) -> tuple[str, ...]:
        gone = self.scaler.dropped if self.scaler else ()
        return tuple(c for c in (*self.numerical, *self.categorical) if c not in gone)

    def for_new_rows(self) -> Preparation:
        """The same with the statistics of the training rows for every row: new tables have no split."""

        def known(values: Mapping) -> dict:
            return {c: {ALL_ROWS: by["train"] if "train" in by else by.get(ALL_ROWS)} for c, by in values.items()}

        imputer = Imputer(known(self.imputer.values)) if self.imputer else None
        scaler = None
        if self.scaler:
            pairs = {c: {k: v or (None, None) for k, v in by.items()} for c, by in known(self.scaler.values).items()}
            scaler = Scaler(pairs, self.scaler.dropped)
        text = Imputer(known(self.text_imputer.values)) if self.text_imputer else None
        return replace(self, imputer=imputer, scaler=scaler, text_imputer=text, split=None)

    def encode(self, df: DataFrame) -> DataFrame:
        """Category codes as numbers, of the filled categories."""
        if self.text_imputer:
            df = self.text_imputer.transform(df)
        if not self.factorizer:
            return df
        coded = self.factorizer.transform(df)
        codes = set(self.categorical)
        return coded.select(*[quoted(c).cast("double").alias(c) if c in codes else quoted(c) for c in coded.columns])

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.encode(drop_missing_rows(df, self.drop_missing))
        if self.imputer:
            out = self.imputer.transform(out)
        if self.scaler:
            out = self.scaler.transform(out)
        return out


def fit_fill_and_scale(
    df: DataFrame,
    impute: Sequence[ImputeSpec],
    rescale: Mapping[str, str],
    scope: str = "train",
    split: str | None = "split",
    drop_missing: Sequence[str] = (),
) -> tuple[Imputer | None, Scaler | None]:
    """Fill values and scales from one common scan of the fitting rows (medians and modes need their own)."""
    rows = drop_missing_rows(df, drop_missing)
    fit_on, group = fitting_rows(rows, scope, split)
    means = [s.feature for s in impute if s.method == "MEAN"]
    wanted = list(dict.fromkeys([*means, *rescale]))
    statistics = collect_statistics(fit_on, wanted, group) if wanted else None
    imputer = fit_imputer(rows, impute, scope, split, statistics) if impute else None
    scaler = fit_scaler(rows, rescale, scope, split, statistics, imputer) if rescale else None
    return imputer, scaler
