"""Class balance: exact undersampling to a quota, and balanced class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, quoted
from tamiz.functions.hashing import row_hash
from tamiz.functions.labels import class_counts, lookup
from tamiz.operators.split import smallest_hash_cutoffs, within_cutoff

NOT_MINORITY, AT_LEAST_HALF = "not minority", "at least half"


def undersampling_quotas(counts: Mapping, strategy: str | float) -> dict:
    """Rows to keep of each class that is cut.

    'not minority': every class shrinks to the smallest one. 'at least half': classes of more than twice the smallest
    shrink to that. A number r (two classes only): the larger class shrinks until smaller / larger = r.
    """
    smallest = min(counts.values())
    if strategy == AT_LEAST_HALF:
        return {c: 2 * smallest for c, k in counts.items() if k > 2 * smallest}
    if strategy == NOT_MINORITY:
        return {c: smallest for c, k in counts.items() if k > smallest}
    if not isinstance(strategy, (int, float)) or not 0 < strategy <= 1:
        raise ValueError(f"strategy is '{NOT_MINORITY}', '{AT_LEAST_HALF}' or a ratio in (0, 1], not {strategy!r}")
    if len(counts) != 2:
        raise ValueError("a ratio needs exactly two classes")
    larger = max(counts, key=lambda c: counts[c])
    quota = int(smallest / strategy)
    if quota > counts[larger]:
        raise ValueError(f"ratio {strategy} would need {quota} rows of class {larger}, it has {counts[larger]}")
    return {larger: quota}


def _keep_quotas(df: DataFrame, key: str, group: str, seed: int, quotas_of) -> DataFrame:
    """Rows of uncut groups, and of the others exactly their quota by smallest hash."""
    hashed = row_hash(key, seed)
    quotas: dict = {}

    def remember(sizes: dict) -> dict:
        quotas.update(quotas_of(sizes))
        return quotas

    sizes, cutoffs = smallest_hash_cutoffs(df, group, hashed, remember)
    uncut = [c for c in sizes if c not in quotas]
    return df.where(quoted(group).isin(uncut) | within_cutoff(group, hashed, cutoffs))


def undersample(
    df: DataFrame, key: str, target: str = TARGET, strategy: str | float = NOT_MINORITY, seed: int = 42
) -> DataFrame:
    """Keep whole the classes that are not cut, and of the others exactly their quota, without replacement. Rows without
    a class belong to no sample."""
    return _keep_quotas(
        df, key, target, seed, lambda sizes: undersampling_quotas(sizes, strategy) if sizes else {}
    )


def undersample_splits(
    df: DataFrame,
    key: str,
    target: str = TARGET,
    strategy: str | float = NOT_MINORITY,
    seed: int = 42,
    split: str = "split",
    balanced: Sequence[str] = ("train",),
) -> DataFrame:
    """Undersample each of the ``balanced`` parts by itself, with common scans; other parts stay whole."""
    group = "_part_and_class"

    def quotas_of(sizes: dict) -> dict:
        out = {}
        for part in balanced:
            within = {c: n for c, n in sizes.items() if c.startswith(f"{part}|")}
            if within:
                out.update(undersampling_quotas(within, strategy))
        return out

    marked = df.withColumn(group, F.concat(quoted(split), F.lit("|"), quoted(target).cast("string")))
    return _keep_quotas(marked, key, group, seed, quotas_of).drop(group)


def balanced_weights(counts: Mapping) -> dict:
    """n / (classes * n of the class)."""
    n = sum(counts.values())
    return {c: n / (len(counts) * k) for c, k in counts.items()}


def with_class_weights(df: DataFrame, target: str = TARGET, weight: str = "weight") -> DataFrame:
    """Add the balanced class weight of each row; the few weights are literals, nothing is joined."""
    weights = balanced_weights(class_counts(df, target))
    return df.withColumn(weight, lookup(quoted(target), weights, "double"))


def class_weight_table(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(target, n, weight), one row per class."""
    counts = df.groupBy(quoted(target)).agg(F.count(F.lit(1)).alias("n"))
    # The window holds one row per class.
    classes = Window.partitionBy(F.lit(1))
    weight = F.sum("n").over(classes) / (F.count(F.lit(1)).over(classes) * F.col("n"))
    return counts.select(quoted(target), "n", weight.alias("weight"))
