"""Exact k-nearest-neighbour classification.

Neighbours are found in one of two ways with equal results:

* A training matrix of checked size is sent to every executor; queries are answered where they lie,
  without a shuffle.
* A larger training set is indexed by cells (``cells``), which tell what a query need not meet. The index serves any
  number of searches, and is stored with a model.

Ties in distance go to the smaller training key; distances are compared at 12 significant digits, votes as shares.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.columns import TARGET, feature_array, literal_array, quoted, unused_name
from tamiz.functions.distances import RING_FEATURES, by_ring, matrix, nearest_by_ring
from tamiz.operators.cells import NEIGHBOURS, NeighbourIndex, SearchLimits, build_index, neighbour_lists
from tamiz.session import materialise

# The functions that run in tasks travel with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEIGHTS = ("uniform", "distance")
# Shares of a vote, which lie between 0 and 1, are compared at this many decimals.
SHARE_DECIMALS = 9


# ---------------------------------------------------------------- direct form


def _direct(train: DataFrame, queries: DataFrame, k: int, p: int, n_train: int, key: str, limits) -> DataFrame:
    spark = queries.sparkSession
    # n_train rows, checked by the caller against the limits.
    table = train.toArrow()
    points = matrix(table["features"])
    pivot = points.mean(axis=0)
    order, r = by_ring(points, pivot, p)
    ids = table["train_id"].to_numpy().astype(np.int64)[order]
    labels = table["label"].to_numpy().astype(np.int64)[order]
    shared = spark.sparkContext.broadcast((points[order], r, ids, labels, pivot))
    kept = [f for f in queries.schema.fields if f.name != "features"]
    schema = T.StructType([*kept, T.StructField("neighbours", NEIGHBOURS)])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, r, ids, labels, pivot = shared.value
        for batch in batches:
            rows, cols, distance = nearest_by_ring(matrix(batch.column("features")), t, r, ids, pivot, k, p)
            found = neighbour_lists(batch.num_rows, rows, distance, ids[cols], labels[cols])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], found], names=[*[f.name for f in kept], "neighbours"]
            )

    # A few large input splits would leave the distances to few tasks.
    n_queries = queries.select(quoted(key)).count()
    width = max(1, points.shape[1])
    # With few features a ring holds a small part of the rows.
    compared = n_train / 8 if width <= RING_FEATURES else n_train
    tasks = min(limits.tasks, math.ceil(n_queries * compared * width / limits.task_work))
    if tasks > 1 and n_queries <= limits.spread_rows:
        queries = queries.repartition(tasks, quoted(key))
    return queries.mapInArrow(search, schema)


# ---------------------------------------------------------------- neighbours


def distinct_points(train: DataFrame, k: int) -> DataFrame:
    """Of each group of equal feature vectors the k smallest keys: the others are never among the k nearest.

    Spark limits the groups before the shuffle as well, so a vector that many rows share stays cheap.
    """
    same = Window.partitionBy("features").orderBy("train_id")
    return train.withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= k).drop("_r")


@dataclass(frozen=True)
class SearchTable:
    """Training points for up to ``k`` neighbours. A table beyond the direct form is without the copies that can be no
    neighbour, and keeps an index for each distance once it has been asked."""

    points: DataFrame
    n: int
    width: int
    k: int
    direct: bool
    limits: SearchLimits = field(default_factory=SearchLimits)
    indexes: dict[int, NeighbourIndex] = field(default_factory=dict)

    def index(self, p: int) -> NeighbourIndex:
        if p not in self.indexes:
            self.indexes[p] = build_index(self.points, self.n, self.width, self.k, p, self.limits)
        return self.indexes[p]


def search_table(train: DataFrame, k: int, limits: SearchLimits = SearchLimits()) -> SearchTable:
    """``train`` has (train_id long, features array<double>, label long)."""

    def size(points: DataFrame) -> tuple[int, int, bool]:
        r = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).first()
        n, width = r["n"], r["width"] or 0
        return n, width, n <= limits.direct_rows and n * width <= limits.direct_cells

    n, width, direct = size(train)
    if not 1 <= k <= n:
        raise ValueError(f"k = {k} neighbours asked of {n} training rows")
    if not direct:
        train = materialise(distinct_points(train, k), "points")
        n, width, direct = size(train)
    return SearchTable(train, n, width, k, direct, limits)


def nearest_neighbours(
    train: DataFrame | SearchTable,
    queries: DataFrame,
    k: int,
    p: int = 2,
    key: str = "row_id",
    limits: SearchLimits = SearchLimits(),
) -> DataFrame:
    """``queries`` without ``features`` but with ``neighbours``: their k nearest training rows in rank order.

    ``queries`` has a ``key`` and ``features``; a key that is repeated or NULL makes no difference, as rows are followed
    by numbers of their own. Several searches share one ``search_table``.
    """
    if p not in (1, 2):
        raise ValueError(f"p is 1 (Manhattan) or 2 (Euclidean), not {p}")
    table = train if isinstance(train, SearchTable) else search_table(train, k, limits)
    if k > table.k:
        raise ValueError(f"the table holds points for {table.k} neighbours, not {k}")
    if table.direct:
        return _direct(table.points, queries, k, p, table.n, key, limits)
    number = unused_name(queries.columns, "query_number")
    # Stored, so that every later use sees the same numbers.
    numbered = materialise(queries.withColumn(number, F.monotonically_increasing_id()), "queries")
    return table.index(p).search(numbered, k, number, limits).drop(number)


# ---------------------------------------------------------------- vote


def votes(neighbours: str, classes: Sequence[int], k: int, weights: str) -> Column:
    """Vote weight per class, in the order of ``classes``, of the k first in the column ``neighbours``."""
    if weights not in WEIGHTS:
        raise ValueError(f"unknown weights '{weights}', one of {WEIGHTS}")
    first, nearest, weight = f"slice(`{neighbours}`, 1, {int(k)})", "0D", "1D"
    if weights == "distance":
        # Relative to the nearest, so that no scale is too small or too large. A neighbour at distance 0 outweighs
        # all others.
        nearest = f"array_min(transform({first}, x -> x.distance))"
        weight = "if(f.nearest = 0D, if(n.distance = 0D, 1D, 0D), f.nearest / n.distance)"
    of_class = f"aggregate(f.first, 0D, (total, n) -> total + if(n.label = c, {weight}, 0D))"
    each = ", ".join(f"{int(c)}L" for c in classes)
    # A list of one binds what would be computed again for each class and neighbour.
    bound = f"array(named_struct('first', {first}, 'nearest', {nearest}))"
    return F.expr(f"transform({bound}, f -> transform(array({each}), c -> {of_class}))[0]")


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` names it."""
    return F.transform(F.array(value), f)[0]


def winner(vote: Column, classes: Sequence[int]) -> Column:
    """Class with the largest vote, the smallest class id on a tie."""
    rounded = F.transform(shares(vote), lambda v: F.round(v, SHARE_DECIMALS))
    place = _bound(rounded, lambda r: F.array_position(r, F.array_max(r)))
    return literal_array(classes, "long")[(place - 1).cast("int")]


def shares(vote: Column) -> Column:
    def of(votes: Column) -> Column:
        total = F.aggregate(votes, F.lit(0.0), lambda a, v: a + v)
        return _bound(total, lambda t: F.transform(votes, lambda v: v / t))

    return _bound(vote, of)


@dataclass(frozen=True)
class KnnModel:
    """Training rows as a table, and the parameters of the vote. ``table``: the rows as they are searched; without it
    every search makes its own."""

    train: DataFrame
    features: tuple[str, ...]
    label_map: dict[str, int]
    k: int = 5
    weights: str = "uniform"
    p: int = 2
    limits: SearchLimits = field(default_factory=SearchLimits)
    table: SearchTable | None = None

    @property
    def classes(self) -> list[int]:
        return sorted(self.label_map.values())

    def neighbours(self, df: DataFrame, key: str) -> DataFrame:
        asked = df.withColumn("features", feature_array(self.features))
        return nearest_neighbours(self.table or self.train, asked, self.k, self.p, key, self.limits)

    def transform(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with ``predicted_value`` and ``probabilities`` (in class id order)."""
        found = self.neighbours(df, key)
        vote = found.withColumn("_votes", votes("neighbours", self.classes, self.k, self.weights))
        return vote.select(
            *[quoted(c) for c in df.columns],
            winner(F.col("_votes"), self.classes).alias("predicted_value"),
            shares(F.col("_votes")).alias("probabilities"),
        )


def training_table(df: DataFrame, features: Sequence[str] | Callable[[], Column], key: str, label: str = TARGET) -> DataFrame:
    """(train_id, features, label) of prepared rows. A key that is no integer is replaced by a hash, which then
    decides ties between equally distant rows."""
    vector = features() if callable(features) else feature_array(features)
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    train_id = quoted(key).cast("long") if whole else F.xxhash64(quoted(key))
    return df.select(
        train_id.alias("train_id"),
        vector.alias("features"),
        quoted(label).cast("long").alias("label"),
    )
