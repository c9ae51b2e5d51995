"""Hold-out splits, and the exact sample by smallest hash that they share with undersampling."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import TARGET, quoted
from tamiz.functions.hashing import hash_fraction_below, row_hash
from tamiz.functions.labels import MAX_CLASSES, lookup

PREFIX_STEP = 3
# Rows of one class that one task may rank; a fuller hash range is cut finer first.
RANKED_ROWS = 200_000


def stratified_quotas(counts: Mapping, dev_size: float) -> dict:
    """Rows per class of the smaller part: ceil(n * dev_size) in all, shared by largest remainder."""
    if not counts:
        raise ValueError("no rows with a class to split")
    n = sum(counts.values())
    total = math.ceil(round(n * dev_size, 9))
    small = [c for c, k in counts.items() if k < 2]
    if small:
        raise ValueError(f"classes with a single row cannot be split: {small}")
    if total < len(counts) or n - total < len(counts):
        raise ValueError(f"{total} of {n} rows cannot hold every one of {len(counts)} classes")
    # Integer arithmetic: share = k * total / n.
    quotas = {c: k * total // n for c, k in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * total % n), c))
    for c in by_remainder[: total - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


def smallest_hash_cutoffs(
    df: DataFrame, target: str, hashed: Column, quotas_of: Callable[[dict], Mapping]
) -> tuple[dict, dict]:
    """(class sizes, cutoffs): per class the hash of its last accepted row, so that a plain filter takes
    exactly the quota. ``quotas_of`` turns the class sizes into quotas.

    One scan counts rows per class and hash prefix; that gives the class sizes and the range of the last
    accepted row. Only rows of that range are ranked. No class is sorted, and the driver sees one row
    per class.
    """
    rows = df.where(quoted(target).isNotNull()).select(quoted(target).alias("c"), hashed.alias("h"))

    def prefix_counts(of: DataFrame, length: int) -> DataFrame:
        """At most 16^PREFIX_STEP rows per class."""
        return of.groupBy("c", F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n"))

    length = PREFIX_STEP
    # Used twice, and quickly counted again should an executor be lost.
    counts = prefix_counts(rows, length).persist()
    try:
        sizes = _class_sizes(counts)
        quotas = quotas_of(sizes)
        unfit = sorted(c for c, q in quotas.items() if q > sizes.get(c, 0))
        if unfit:
            raise ValueError(f"quota larger than the class: {unfit}")
        todo = {c: q for c, q in quotas.items() if q > 0}
        edge = _edges(counts, todo)
    finally:
        counts.unpersist()
    cutoffs: dict = {}
    while todo:
        # Rows still to accept inside the prefix of the last accepted row.
        inside = {r["c"]: r["p"] for r in edge}
        todo = {r["c"]: todo[r["c"]] - (r["end"] - r["n"]) for r in edge}
        ready = {r["c"] for r in edge if r["n"] <= RANKED_ROWS or length >= 30}
        here = F.substring("h", 1, length) == lookup(F.col("c"), inside, "string")
        if ready:
            order = Window.partitionBy("c").orderBy("h")
            ranked = rows.where(F.col("c").isin(list(ready)) & here).withColumn("r", F.row_number().over(order))
            for r in ranked.where(F.col("r") == lookup(F.col("c"), todo, "long")).collect():
                cutoffs[r["c"]] = r["h"]
        todo = {c: q for c, q in todo.items() if c not in ready}
        if todo:
            length += PREFIX_STEP
            edge = _edges(prefix_counts(rows.where(F.col("c").isin(list(todo)) & here), length), todo)
    return sizes, cutoffs


def _class_sizes(counts: DataFrame) -> dict:
    rows = counts.groupBy("c").agg(F.sum("n").alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    return {r["c"]: r["n"] for r in sorted(rows, key=lambda r: r["c"])}


def _edges(counts: DataFrame, wanted: Mapping) -> list:
    """Per class the prefix (c, p, n, end) in which the running count reaches the wanted number of rows."""
    if not wanted:
        return []
    so_far = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.where(F.col("c").isin(list(wanted))).withColumn("end", F.sum("n").over(so_far))
    number = lookup(F.col("c"), wanted, "long")
    return ends.where((F.col("end") >= number) & (F.col("end") - F.col("n") < number)).collect()


def within_cutoff(target: str, hashed: Column, cutoffs: Mapping) -> Column:
    """True for the rows an exact sample takes; a map-side test."""
    return F.coalesce(hashed <= lookup(quoted(target), cutoffs, "string"), F.lit(False))


def stratified_split(
    df: DataFrame, key: str, target: str = TARGET, dev_size: float = 0.2, seed: int = 42, split: str = "split"
) -> DataFrame:
    """Add ``split`` ('train' or 'dev') with exact class shares. Rows are chosen by hash of their key, so
    the result does not depend on the partition layout. Rows without a class belong to no part: theirs is NULL."""
    hashed = row_hash(key, seed)
    _, cutoffs = smallest_hash_cutoffs(df, target, hashed, lambda sizes: stratified_quotas(sizes, dev_size))
    chosen = within_cutoff(target, hashed, cutoffs)
    known = quoted(target).isNotNull()
    return df.withColumn(split, F.when(chosen, F.lit("dev")).when(known, F.lit("train")))


def random_split(df: DataFrame, key: str, train_size: float = 0.8, seed: int = 42, split: str = "split") -> DataFrame:
    """Add ``split`` without regard to classes; each row is decided alone by the hash of its key."""
    chosen = hash_fraction_below(row_hash(key, seed), train_size)
    return df.withColumn(split, F.when(chosen, F.lit("train")).otherwise(F.lit("dev")))
