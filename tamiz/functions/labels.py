"""Target labels: literal dictionaries, their inverse, and class counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, quoted

# Classes are columns of the probability output, so their number is bounded by design.
MAX_CLASSES = 4096
LITERAL_MAP_LIMIT = 256


def lookup(column: Column, mapping: Mapping, result_type: str) -> Column:
    """Dictionary lookup as an expression; a key that is not in the dictionary gives NULL."""
    if not mapping:
        return F.lit(None).cast(result_type)
    key_type = "long" if all(isinstance(k, int) for k in mapping) else "string"
    pairs = [F.lit(x).cast(t) for kv in mapping.items() for x, t in zip(kv, (key_type, result_type))]
    return F.try_element_at(F.create_map(*pairs), column.cast(key_type))


def map_labels(df: DataFrame, source: str, mapping: Mapping[str, int], target: str = TARGET) -> DataFrame:
    """Add ``target``: class id of the label in ``source``; NULL for a label without id."""
    if len(mapping) <= LITERAL_MAP_LIMIT:
        return df.withColumn(target, lookup(quoted(source).cast("string"), mapping, "long"))
    if len(mapping) > MAX_CLASSES:
        raise ValueError(f"{len(mapping)} classes, at most {MAX_CLASSES} are supported")
    table = df.sparkSession.createDataFrame(list(mapping.items()), f"_label string, `{target}` long")
    # At most MAX_CLASSES rows.
    joined = df.join(F.broadcast(table), quoted(source).cast("string") == F.col("_label"), "left")
    return joined.drop("_label")


def unmap_labels(df: DataFrame, source: str, mapping: Mapping[str, int], target: str) -> DataFrame:
    inverse = {v: k for k, v in mapping.items()}
    return df.withColumn(target, lookup(quoted(source).cast("long"), inverse, "string"))


def drop_unknown_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(quoted(target).isNotNull())


def class_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.groupBy(quoted(target)).agg(F.count(F.lit(1)).alias("n"))


def class_counts(df: DataFrame, target: str = TARGET) -> dict:
    """Class sizes on the driver; refuses a target with more than MAX_CLASSES values."""
    rows = class_distribution(df.where(quoted(target).isNotNull()), target).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"target '{target}' has more than {MAX_CLASSES} classes")
    return {r[0]: r["n"] for r in sorted(rows, key=lambda r: r[0])}


def derive_label_map(df: DataFrame, source: str) -> dict[str, int]:
    """Class ids for the sorted distinct labels of a table."""
    labels = class_counts(df.select(quoted(source).cast("string").alias(source)), source)
    return {label: i for i, label in enumerate(labels)}


def probability_columns(mapping: Mapping[str, int]) -> list[str]:
    return [f"probability_of_value_{label}" for label in labels_by_id(mapping)]


def labels_by_id(mapping: Mapping[str, int]) -> Sequence[str]:
    return sorted(mapping, key=lambda label: mapping[label])
