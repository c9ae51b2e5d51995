"""Column statistics: one scan for count, mean, standard deviation and range; exact median and mode."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import literal_array, nan_to_null, quoted
from tamiz.functions.labels import lookup
from tamiz.functions.running import running_totals

# The functions that run in tasks travel with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ALL_ROWS = "*"
# Above this many features no aggregate of hundreds of expressions is made, which would not be compiled: moments are
# added up in Arrow blocks, sketches over (feature, value) pairs.
WIDE_TABLE = 8
SKETCH_ACCURACY = 10_000


@dataclass(frozen=True)
class FeatureStats:
    """Statistics of one feature in one scope; ``std`` is the sample standard deviation."""

    n_rows: int
    n: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None

    def filled(self, value: float | None) -> FeatureStats:
        """The statistics after the missing cells took ``value``; no second scan needed."""
        gaps = self.n_rows - self.n
        if gaps == 0 or value is None:
            return self
        if self.n == 0:
            return FeatureStats(gaps, gaps, value, 0.0 if gaps > 1 else None, value, value)
        total = self.n + gaps
        squares = (self.std or 0.0) ** 2 * (self.n - 1) + (value - self.mean) ** 2 * self.n * gaps / total
        return replace(
            self,
            n=total,
            mean=(self.mean * self.n + value * gaps) / total,
            std=math.sqrt(squares / (total - 1)),
            min=min(self.min, value),
            max=max(self.max, value),
        )


def _scope(split: str | None) -> Column:
    return (F.lit(ALL_ROWS) if split is None else quoted(split).cast("string")).alias("scope")


def unpivot(df: DataFrame, features: Sequence[str], split: str | None, value_type: str) -> DataFrame:
    """(scope, feature, value) rows; the value is NULL where the cell is missing."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), quoted(c).cast(value_type).alias("value"))
            for c in features
        ]
    )
    long = df.select(_scope(split), F.explode(cells).alias("cell")).select("scope", "cell.feature", "cell.value")
    return long.withColumn("value", nan_to_null(F.col("value"))) if value_type == "double" else long


def _aggregates(value: Column) -> list[Column]:
    return [
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def feature_statistics(df: DataFrame, features: Sequence[str], split: str | None = None) -> DataFrame:
    """(scope, feature, n_rows, n, mean, std, min, max): all features in one scan, by one aggregate or, of many features,
    by moments that each task adds up."""
    if len(features) > WIDE_TABLE:
        return _merged(_moments(df, features, split), features)
    names = ["n", "mean", "std", "min", "max"]
    columns = [F.count(F.lit(1)).alias("n_rows")]
    for i, c in enumerate(features):
        value = nan_to_null(quoted(c).cast("double"))
        columns += [a.alias(f"{name}_{i}") for a, name in zip(_aggregates(value), names)]
    wide = df.groupBy(_scope(split)).agg(*columns)
    if split is None:
        wide = wide.where("n_rows > 0")
    long = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), "n_rows", *[F.col(f"{name}_{i}").alias(name) for name in names])
            for i, c in enumerate(features)
        ]
    )
    return wide.select("scope", F.explode(long).alias("s")).select("scope", "s.*")


def _moments(df: DataFrame, features: Sequence[str], split: str | None) -> DataFrame:
    """(scope, feature, n_rows, n, mean, m2, min, max), a row per task, scope and feature (its place): rows become blocks
    of numbers and are never multiplied by the features."""
    columns = [quoted(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)]
    schema = "scope string, feature int, n_rows long, n long, mean double, m2 double, min double, max double"

    def of_block(x: np.ndarray) -> Moments:
        there = ~np.isnan(x)
        n = there.sum(axis=0)
        mean = np.divide(np.where(there, x, 0.0).sum(axis=0), n, out=np.zeros(x.shape[1]), where=n > 0)
        with np.errstate(invalid="ignore"):
            m2 = np.square(np.where(there, x - mean, 0.0)).sum(axis=0)
        low, high = (f(np.where(there, x, e), axis=0, initial=e) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
        return Moments(len(x), n, mean, m2, low, high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str | None, Moments] = {}
        for batch in batches:
            scopes = batch.column(0).dictionary_encode()
            at = scopes.indices.fill_null(-1).to_numpy()
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            for code in np.unique(at).tolist():
                scope = scopes.dictionary[code].as_py() if code >= 0 else None
                own = of_block(x[at == code])
                total[scope] = total[scope].plus(own) if scope in total else own
        for scope, m in total.items():
            k = len(features)
            known = m.n > 0
            arrays = [pa.array([scope] * k, pa.string()), pa.array(np.arange(k, dtype=np.int32)), pa.array([m.rows] * k, pa.int64())]
            arrays += [pa.array(m.n), *[pa.array(v, mask=~known) for v in (m.mean, m.m2, m.low, m.high)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["scope", "feature", "n_rows", "n", "mean", "m2", "min", "max"])

    return df.select(_scope(split), *columns).mapInArrow(run, schema)


@dataclass(frozen=True)
class Moments:
    rows: int
    n: np.ndarray
    mean: np.ndarray
    m2: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def plus(self, other: Moments) -> Moments:
        n = self.n + other.n
        step, share = other.mean - self.mean, np.divide(other.n, n, out=np.zeros(len(n)), where=n > 0)
        return Moments(
            self.rows + other.rows,
            n,
            np.where(other.n > 0, self.mean + step * share, self.mean),
            self.m2 + other.m2 + step * step * self.n * share,
            np.minimum(self.low, other.low),
            np.maximum(self.high, other.high),
        )


def _merged(parts: DataFrame, features: Sequence[str]) -> DataFrame:
    """The parts of all tasks as one, in an order that does not depend on them: a list has as many as there are tasks."""
    part = F.when(F.col("n") > 0, F.struct(F.col("n").cast("double").alias("n"), "mean", "m2"))
    grouped = parts.groupBy("scope", "feature").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sort_array(F.collect_list(part)).alias("parts"),
    )
    none = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def plus(a: Column, b: Column) -> Column:
        n, step = a["n"] + b["n"], b["mean"] - a["mean"]
        mean, m2 = a["mean"] + step * (b["n"] / n), a["m2"] + b["m2"] + step * step * a["n"] * (b["n"] / n)
        return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))

    whole = grouped.withColumn("whole", F.aggregate("parts", none, plus))
    return whole.select(
        "scope",
        literal_array(features, "string")[F.col("feature")].alias("feature"),
        "n_rows",
        "n",
        F.when(F.col("n") > 0, F.col("whole.mean")).alias("mean"),
        F.when(F.col("n") > 1, F.sqrt(F.col("whole.m2") / (F.col("n") - 1))).alias("std"),
        "min",
        "max",
    )


def collect_statistics(
    df: DataFrame, features: Sequence[str], split: str | None = None
) -> dict[str, dict[str, FeatureStats]]:
    """{scope: {feature: FeatureStats}}; one row per scope and feature reaches the driver."""
    out: dict[str, dict[str, FeatureStats]] = {}
    if features:
        for r in feature_statistics(df, features, split).collect():
            stats = FeatureStats(r["n_rows"], r["n"], r["mean"], r["std"], r["min"], r["max"])
            out.setdefault(r["scope"], {})[r["feature"]] = stats
    return out


def _brackets(df: DataFrame, features: Sequence[str], split: str | None, margin: float) -> DataFrame:
    """(scope, feature, n, bracket): approximate quantiles on either side of the middle."""

    def measures(value: Column) -> list[Column]:
        sketch = F.percentile_approx(value, [0.5 - margin, 0.5 + margin], SKETCH_ACCURACY)
        return [F.count(value).alias("n"), sketch.alias("bracket")]

    if len(features) > WIDE_TABLE:
        return unpivot(df, features, split, "double").groupBy("scope", "feature").agg(*measures(F.col("value")))
    each = [F.struct(F.lit(c).alias("feature"), *measures(nan_to_null(quoted(c).cast("double")))) for c in features]
    wide = df.groupBy(_scope(split)).agg(F.array(*each).alias("all"))
    return wide.select("scope", F.explode("all").alias("s")).select("scope", "s.*")


def exact_median(df: DataFrame, features: Sequence[str], split: str | None = None) -> DataFrame:
    """(scope, feature, median), exact and interpolated, for any number of distinct values.

    A bounded quantile sketch gives a bracket that must hold the middle ranks (its rank error is at most
    n / accuracy). Smaller values are only counted; the few inside the bracket are ordered.
    """
    margin = 2.0 / SKETCH_ACCURACY
    # Three numbers per scope and feature.
    found = {(r["scope"], r["feature"]): r for r in _brackets(df, features, split, margin).collect() if r["n"]}

    def edge(feature: str, side: int) -> Column:
        return by_scope({k: r["bracket"][side] for (k, f), r in found.items() if f == feature}, split, "double")

    cells = []
    for c in features:
        value = nan_to_null(quoted(c).cast("double"))
        # Below the bracket a cell only counts, under the value NULL.
        kept = F.struct(F.lit(c).alias("feature"), F.when(value >= edge(c, 0), value).alias("value"))
        cells.append(F.when(value <= edge(c, 1), kept))
    counted = (
        df.select(_scope(split), F.explode(F.array(*cells)).alias("cell"))
        .where(F.col("cell").isNotNull())
        .groupBy("scope", "cell.feature", "cell.value")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    # The bracket spans 2 margins, and the sketch may be off by half a margin on either side.
    at_most = sum(int(3 * margin * r["n"]) + 4 for r in found.values())
    ranked = running_totals(counted, ["scope", "feature"], "value", ["c"], at_most)
    sizes = {f"{k}|{f}": r["n"] for (k, f), r in found.items()}
    n = lookup(F.concat_ws("|", "scope", "feature"), sizes, "long")
    low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    first, last = F.col("c_before") + 1, F.col("c_before") + F.col("c")
    # Both middle ranks must lie among the ordered values: below the bracket (NULL) or beyond it there is none.
    held = (first <= low) & (low <= last), (first <= high) & (high <= last)
    middle = ranked.where(held[0] | held[1]).groupBy("scope", "feature").agg(
        ((F.min("value") + F.max("value")) / 2).alias("median"),
        (F.max(F.when(held[0] & F.col("value").isNotNull(), 1)) + F.max(F.when(held[1] & F.col("value").isNotNull(), 1))).alias("ends"),
    )
    missed = F.raise_error(F.lit("the quantile sketch missed the middle ranks")).cast("double")
    return middle.select("scope", "feature", F.when(F.col("ends") == 2, F.col("median")).otherwise(missed).alias("median"))


def by_scope(values: Mapping[str, object], split: str | None, sql_type: str) -> Column:
    """A literal, or one literal per split."""
    if ALL_ROWS in values:
        return F.lit(values[ALL_ROWS]).cast(sql_type)
    out = F.lit(None).cast(sql_type)
    for name, value in values.items():
        out = F.when(quoted(split).cast("string") == name, F.lit(value).cast(sql_type)).otherwise(out)
    return out


def mode(df: DataFrame, features: Sequence[str], split: str | None, value_type: str) -> DataFrame:
    """(scope, feature, mode): most frequent value, the smallest one on a tie."""
    counts = (
        unpivot(df, features, split, value_type)
        .where(F.col("value").isNotNull())
        .groupBy("scope", "feature", "value")
        .agg((-F.count(F.lit(1))).alias("neg_n"))
    )
    best = counts.groupBy("scope", "feature").agg(F.min(F.struct("neg_n", "value")).alias("best"))
    return best.select("scope", "feature", F.col("best.value").alias("mode"))
