"""An index of training points for exact neighbours: cells around pivots on two levels.

A bounded sample gives the pivots. Up to some number of them they are one level; beyond, a few of them are tops, and
the others are leaves below the nearest top, so that a point is placed and a query is routed by the square root of the
cells. What is known of the cells (radii, bounding boxes, where k rows lie) stays on the driver and travels to the
tasks; the points are a table by cell.

A query first meets the cell it falls into. With the distance found there, triangle inequality and boxes tell which
other cells can hold a nearer row. Cells are sent by shelves: runs of neighbouring cells of bounded size, whose number
does not grow with the table as long as they fit a task. A query is sent once to each shelf with a cell that it must
meet, however many cells of the shelf these are, and sends back only what lies within its bound. The rows of a shelf
come first in their task and the queries stream past them; they are sent again only where one task would have too many
distances to compute.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass, fields, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions import distances
from tamiz.functions.columns import literal_array, quoted
from tamiz.functions.distances import (
    TILE,
    Cells,
    Summary,
    groups,
    k_first,
    matrix,
    nearest_by_ring,
    nearest_pivot,
    shrink,
    widened,
)
from tamiz.functions.hashing import row_hash
from tamiz.session import materialise
from tamiz.sources.sinks import read_text, write_text

# The few functions that run in tasks travel with them: executors need no copy of this package.
cloudpickle.register_pickle_by_value(distances)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Blocks of rows and queries aimed at for each core, and rows that are not worth a block of their own.
BLOCKS_A_CORE = 3
FEW_ROWS = 1_024
NEIGHBOURS = T.ArrayType(
    T.StructType(
        [
            T.StructField("distance", T.DoubleType()),
            T.StructField("train_id", T.LongType()),
            T.StructField("label", T.LongType()),
        ]
    )
)


@dataclass(frozen=True)
class SearchLimits:
    """Sizes that decide how neighbours are found; none of them changes the result."""

    # Largest training matrix sent to executors (rows, and cells of the matrix: 16 MB).
    direct_rows: int = 65_536
    direct_cells: int = 2_097_152
    # Distance terms one task of the direct form should compute. Only this many queries are spread anew for
    # it; more of them come in many input splits anyway.
    task_work: float = 5e7
    spread_rows: int = 20_000_000
    # Largest number of tasks asked for.
    tasks: int = 20_000
    # Aimed rows per cell, and the largest number of pivots (pivots * features doubles are held per task).
    cell_rows: int = 1_024
    wide_cell_rows: int = 16_384
    max_pivots: int = 262_144
    max_pivot_cells: int = 4_194_304
    # More pivots than these are put on two levels.
    flat_pivots: int = 2_048
    # Cells have bounding boxes up to this many features.
    boxed_features: int = 32
    # Rows that one task holds and queries that stream past them. A search sizes both by its tables (``grown``), so that
    # the number of blocks and with it the copies sent do not grow with them, up to these cells of the matrix of rows
    # (32 MB) and this many distance terms of a block.
    block_train: int = 32_768
    block_queries: int = 1_048_576
    block_cells: int = 4_194_304
    block_work: float = 2e11


def lists(n: int, rows: np.ndarray, values: pa.Array) -> pa.ListArray:
    """One list per position 0 .. n-1 from values ordered by position."""
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def neighbour_lists(n: int, rows: np.ndarray, distance: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> pa.ListArray:
    items = [pa.array(distance), pa.array(ids), pa.array(labels)]
    return lists(n, rows, pa.StructArray.from_arrays(items, names=["distance", "train_id", "label"]))

# ---------------------------------------------------------------- building


def _sample(points: DataFrame, n: int, width: int, limits: SearchLimits) -> np.ndarray:
    rows = limits.cell_rows if width <= 16 else limits.wide_cell_rows
    most = min(limits.max_pivots, max(1, limits.max_pivot_cells // max(1, width)))
    m = max(1, min(most, n // rows))
    # A per-partition top-m by hash; m * width numbers reach the driver. The order by hash is random.
    chosen = points.select("features", row_hash("train_id", 7).alias("h")).orderBy("h").limit(m).toArrow()
    found = matrix(chosen["features"])
    return found[np.sort(np.unique(found, axis=0, return_index=True)[1])]


def _bare(pivots: np.ndarray) -> Summary:
    m = len(pivots)
    return Summary(pivots, np.zeros(m, np.int64), np.zeros((m, 2)), np.full(m, np.inf), np.empty((m, 0)), np.empty((m, 0)))


def two_levels(sample: np.ndarray, p: int, limits: SearchLimits) -> Cells:
    """Cells without rows. Up to ``limits.flat_pivots`` of the sample each pivot is a top with one leaf."""
    m = len(sample)
    if m <= limits.flat_pivots:
        return Cells(_bare(sample), _bare(sample), np.arange(m + 1))
    tops = sample[: math.ceil(math.sqrt(m))]
    of, _ = nearest_pivot(sample, tops, p)  # every top is a leaf of its own, too
    order = np.argsort(of, kind="stable")
    return Cells(_bare(tops), _bare(sample[order]), np.searchsorted(of[order], np.arange(len(tops) + 1)))


def _summarised(placed: DataFrame, bare: Cells, k: int, limits: SearchLimits) -> Cells:
    """``bare`` with what the ``placed`` rows (features, cell, r, top, r_top) tell: one row a cell on the driver."""
    m, width = bare.leaves.pivots.shape
    # Boxes of many features exclude next to nothing, and would take two aggregates per feature.
    boxed = range(width if width <= limits.boxed_features else 0)
    found = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{name}_{c}") for c in ("r", "r_top") for name, f in (("min", F.min), ("max", F.max))],
        *[F.min(F.col("features")[j]).alias(f"low_{j}") for j in boxed],
        *[F.max(F.col("features")[j]).alias(f"high_{j}") for j in boxed],
    )
    found = found.toArrow()
    at = found["cell"].to_numpy()

    def spread(names: list[str], empty: float) -> np.ndarray:
        out = np.full((m, len(names)), empty)
        if names:
            out[at] = np.stack([found[c].to_numpy() for c in names], axis=1)
        return out

    counts = np.zeros(m, dtype=np.int64)
    counts[at] = found["n"].to_numpy()
    low, high = spread([f"low_{j}" for j in boxed], np.inf), spread([f"high_{j}" for j in boxed], -np.inf)
    radius, r_top = spread(["min_r", "max_r"], 0.0), spread(["min_r_top", "max_r_top"], np.nan)

    def kth(cell: str, r: str, size: int) -> np.ndarray:
        near = Window.partitionBy(cell).orderBy(r)
        ranked = placed.select(cell, r, F.row_number().over(near).alias("i")).where(F.col("i") <= k)
        ranked = ranked.where(F.col("i") == k).select(cell, r).toArrow()
        out = np.full(size, np.inf)
        out[ranked[cell].to_numpy()] = ranked[r].to_numpy()
        return out

    leaves = Summary(bare.leaves.pivots, counts, radius, kth("cell", "r", m), low, high)
    if len(bare.tops.pivots) == m:
        return Cells(leaves, leaves, bare.starts)

    def joined(f: np.ufunc, x: np.ndarray) -> np.ndarray:
        return f.reduceat(x, bare.starts[:-1], axis=0)  # no top is without leaves

    around = np.stack([joined(np.fmin, r_top[:, 0]), joined(np.fmax, r_top[:, 1])], axis=1)
    tops = Summary(
        bare.tops.pivots,
        joined(np.add, counts),
        np.nan_to_num(around),
        kth("top", "r_top", len(bare.tops.pivots)),
        joined(np.minimum, low) if len(boxed) else np.empty((len(bare.tops.pivots), 0)),
        joined(np.maximum, high) if len(boxed) else np.empty((len(bare.tops.pivots), 0)),
    )
    return Cells(tops, leaves, bare.starts)


@dataclass(frozen=True)
class NeighbourIndex:
    """``points``: (train_id, features, label, cell, r), for up to ``k`` neighbours by the distance ``p``."""

    points: DataFrame
    cells: Cells
    k: int
    p: int

    def save(self, folder: str) -> None:
        """The points ordered by cell, so that a search reads little more than the cells that it meets."""
        spark = self.points.sparkSession
        spread = self.points.repartitionByRange("cell").sortWithinPartitions("cell", "r")
        spread.write.mode("overwrite").parquet(f"{folder}/points")
        one_level = self.cells.tops is self.cells.leaves
        for name, summary in (("leaves", self.cells.leaves), ("tops", self.cells.tops)):
            if name == "tops" and one_level:
                continue
            columns = {"cell": pa.array(np.arange(len(summary.pivots)))}
            columns |= {f.name: _arrow(getattr(summary, f.name)) for f in fields(Summary)}
            spark.createDataFrame(pa.table(columns)).write.mode("overwrite").parquet(f"{folder}/{name}")
        state = {"k": self.k, "p": self.p, "starts": None if one_level else self.cells.starts.tolist()}
        write_text(spark, json.dumps(state), f"{folder}/state")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> NeighbourIndex:
        state = json.loads(read_text(spark, f"{folder}/state"))

        def summary(name: str) -> Summary:
            rows = spark.read.parquet(f"{folder}/{name}").toArrow().sort_by("cell")
            return Summary(*(_numpy(rows[f.name].combine_chunks()) for f in fields(Summary)))

        leaves = summary("leaves")
        if state["starts"] is None:
            cells = Cells(leaves, leaves, np.arange(len(leaves.pivots) + 1))
        else:
            cells = Cells(summary("tops"), leaves, np.array(state["starts"]))
        schema = "train_id long, features array<double>, label long, cell int, r double"
        return NeighbourIndex(spark.read.schema(schema).parquet(f"{folder}/points"), cells, state["k"], state["p"])

    def search(self, queries: DataFrame, k: int, key: str, limits: SearchLimits) -> DataFrame:
        """``queries`` (a unique ``key`` of longs, features) without ``features`` but with ``neighbours``."""
        return _search(self, queries, k, key, limits)


def _arrow(x: np.ndarray) -> pa.Array:
    if x.ndim == 1:
        return pa.array(x)
    flat = pa.array(np.ascontiguousarray(x, dtype=np.float64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)


def _numpy(x: pa.Array) -> np.ndarray:
    if pa.types.is_list(x.type) or pa.types.is_large_list(x.type):
        return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x.flatten()) else np.empty((len(x), 0))
    return x.to_numpy(zero_copy_only=False)


def build_index(points: DataFrame, n: int, width: int, k: int, p: int, limits: SearchLimits) -> NeighbourIndex:
    """``points``: (train_id, features, label)."""
    bare = two_levels(_sample(points, n, width, limits), p, limits)
    names = [f.name for f in points.schema.fields]
    added = "cell int, r double, top int, r_top double"
    schema = T.StructType([*points.schema.fields, *T._parse_datatype_string(added).fields])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, r, top, r_top = bare.place(matrix(batch.column("features")), p)
            more = [pa.array(cell.astype(np.int32)), pa.array(r), pa.array(top.astype(np.int32)), pa.array(r_top)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *more], names=schema.names)

    placed = materialise(points.mapInArrow(assign, schema), "cells")
    cells = _summarised(placed, bare, k, limits)
    return NeighbourIndex(placed.select("train_id", "features", "label", "cell", "r"), cells, k, p)


# ---------------------------------------------------------------- searching


def blocks(counts: np.ndarray, asked: np.ndarray, width: int, limits: SearchLimits) -> tuple[np.ndarray, np.ndarray]:
    """(blocks of the rows, blocks of the queries) of each shelf. A row is sent once for each block of queries, which
    stream and so may be many; a query once for each block of rows."""
    rows = max(1, min(limits.block_train, limits.block_cells // max(1, width)))
    t_blocks = np.ceil(counts / rows).astype(int)
    held = np.maximum(1, np.ceil(counts / np.maximum(1, t_blocks))) * max(1, width)
    return t_blocks, np.ceil(asked / np.clip(limits.block_work // held, 1, limits.block_queries)).astype(int)


def grown(limits: SearchLimits, n: int, n_queries: int, asked: int, work: float, parallelism: int) -> SearchLimits:
    """``limits`` with blocks for a table of ``n`` rows: some for each core, whatever the size, instead of more with every
    row, cut so that rows and queries are copied alike. ``asked``: the queries of the busiest shelf; ``work``: all
    distance terms."""
    some = BLOCKS_A_CORE * parallelism
    cuts = max(1.0, math.sqrt(some * n / max(1, n_queries)))
    return replace(
        limits,
        block_train=max(min(limits.block_train, FEW_ROWS), math.ceil(n / cuts)),
        block_queries=max(limits.block_queries, math.ceil(asked / max(1.0, some / cuts))),
        block_work=max(limits.task_work, min(limits.block_work, work / some)),
    )


def shelves(counts: np.ndarray, rows: int) -> np.ndarray:
    """First cell of each run of neighbouring cells that together have at most so many rows, or are one cell; and the
    end."""
    starts, held = [0], 0
    for cell, n in enumerate(counts.tolist()):
        if held + n > rows and cell > starts[-1]:
            starts.append(cell)
            held = 0
        held += n
    return np.array([*starts, len(counts)])


def _by_shelf(
    index: NeighbourIndex, starts: np.ndarray, asked: DataFrame, key: str, k: int, onward: bool, n_queries: int, limits: SearchLimits
) -> DataFrame:
    """Nearest rows for the queries ``asked`` (key, features, reach, cell, shelf, low, high) among cells of a shelf:
    (key, neighbours), all that lie within the reach and can be among the k nearest.

    With ``onward`` in the cell of the query, and with (features, reach, cell, shelves, low, high): the other shelves to
    ask, and the first and last cell to meet there. Without, in all cells that can hold a row within the reach but
    the query's own."""
    spark, p, parallelism = index.points.sparkSession, index.p, index.points.sparkSession.sparkContext.defaultParallelism
    counts = np.add.reduceat(index.cells.leaves.counts, starts[:-1])
    width = index.cells.leaves.pivots.shape[1]
    sizes = asked.groupBy("shelf").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    sizes = sizes.toArrow()
    n_asked = np.zeros(len(counts), dtype=np.int64)
    n_asked[sizes["shelf"].to_numpy()] = sizes["n"].to_numpy()
    total = float((counts.astype(float) * n_asked).sum()) * width
    sized = grown(limits, int(counts.sum()), n_queries, int(n_asked.max(initial=0)), total, parallelism)
    t_blocks, q_blocks = blocks(counts, n_asked, width, sized)
    points = index.points
    if len(sizes):
        low, high = int(min(sizes["low"].to_pylist())), int(max(sizes["high"].to_pylist()))
        if high - low + 1 < len(index.cells.leaves.counts):
            # Statistics of the files tell which of them hold such cells.
            points = points.where(F.col("cell").between(low, high))
    # Blocks are much work and few bytes: partitions by distances to compute, not by bytes. They are dealt in turn.
    n_blocks = t_blocks * q_blocks
    work = math.ceil(total / limits.task_work)
    tasks = int(min(limits.tasks, max(1, n_blocks.sum()), max(work, BLOCKS_A_CORE * parallelism)))
    before = np.cumsum(n_blocks) - n_blocks
    shelf_of = np.repeat(np.arange(len(counts)), np.diff(starts))
    by_cell = _numbers(spark, "cell", {"shelf": shelf_of, "tn": t_blocks[shelf_of], "qn": q_blocks[shelf_of], "before": before[shelf_of]}, limits)
    by_shelf = _numbers(spark, "shelf", {"tn": t_blocks, "qn": q_blocks, "before": before}, limits)

    def copies(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    place = ["shelf", "tb", "qb"]
    part = F.pmod(F.col("before") + F.col("tb") * F.col("qn") + F.col("qb"), F.lit(tasks)).cast("int").alias("part")
    rows = (
        by_cell(points)
        .where(F.col("qn") > 0)
        .withColumn("tb", F.pmod(F.xxhash64("train_id"), F.col("tn")).cast("int"))
        .withColumn("qb", copies(F.col("qn")))
        .select(part, *place, F.lit(False).alias("asks"), F.col("train_id").alias("id"), "label", "features", "r", "cell",
                F.lit(False).alias("routes"))
    )
    hashed = F.xxhash64(quoted(key))
    queries = (
        by_shelf(asked)
        .withColumn("qb", F.pmod(hashed, F.col("qn")).cast("int"))
        # One block of the shelf sends its queries on: the bound of any block is good enough.
        .withColumn("own", F.pmod(hashed, F.col("tn")).cast("int"))
        .withColumn("tb", copies(F.col("tn")))
        .select(part, *place, F.lit(True).alias("asks"), quoted(key).alias("id"), F.lit(0).cast("long").alias("label"),
                "features", F.col("reach").alias("r"), "cell", (F.col("tb") == F.col("own")).alias("routes"))
    )
    streams = rows.unionByName(queries).repartitionById(tasks, F.col("part"))
    streams = streams.drop("part").sortWithinPartitions(*place, "asks", "cell")
    shared = spark.sparkContext.broadcast((index.cells, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (cells, starts), block, held, ready = shared.value, None, [], None
        for batch in batches:
            for mine, part in _stretches(batch):
                if mine[:3] != block:
                    block, held, ready = mine[:3], [], None
                if not mine[3]:
                    held.append(part)
                    continue
                if ready is None:
                    ready, held = _ordered(held, cells.leaves.pivots.shape[1]), []
                q, reach = matrix(part.column("features")), part.column("r").to_numpy().copy()
                homes = part.column("cell").to_numpy().astype(np.int64)
                if onward:
                    i, d, ids, labels = _met(ready, q, reach, np.arange(len(q)), homes, cells, k, p)
                else:
                    a, b = int(starts[block[0]]), int(starts[block[0] + 1])
                    found = []
                    for at in _tiles(len(q), b - a):
                        rows, cols = cells.others(q[at], reach[at], homes[at], p, a, b)
                        found.append(_met(ready, q, reach, rows + at.start, cols, cells, k, p))
                    i, d, ids, labels = (np.concatenate(x) for x in zip(*found))
                names = ["id", "neighbours"]
                out = [part.column("id"), neighbour_lists(len(q), i, d, ids, labels)]
                if onward:
                    names += ["features", "reach", "cell", "shelves", "low", "high"]
                    routes = part.column("routes").to_numpy(zero_copy_only=False)
                    out += [part.column("features"), pa.array(reach), part.column("cell")]
                    out += _onward(q, reach, homes, np.flatnonzero(routes), cells, starts, p)
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = [T.StructField("id", T.LongType()), T.StructField("neighbours", NEIGHBOURS)]
    if onward:
        added = "features array<double>, reach double, cell int, shelves array<int>, low int, high int"
        schema += T._parse_datatype_string(added).fields
    return streams.mapInArrow(run, T.StructType(schema)).withColumnRenamed("id", key)


def _tiles(n: int, cells: int) -> Iterator[slice]:
    """Ranges of queries for which all pairs with so many cells can be held."""
    step = max(1, TILE // max(1, cells))
    return (slice(start, min(n, start + step)) for start in range(0, n, step))


def _met(
    block: tuple[np.ndarray, ...], q: np.ndarray, reach: np.ndarray, rows: np.ndarray, cols: np.ndarray, cells: Cells, k: int, p: int
) -> tuple[np.ndarray, ...]:
    """(query position, distance, id, label), by query and rank, of the rows that the pairs (query position, cell) find
    in the block within ``reach``, which shrinks in place to what k rows of a cell lie within."""
    points, r, ids, labels, cell = block
    held, size = [(np.empty(0, dtype=np.int64), np.empty(0), ids[:0], labels[:0])], 0
    for c, pairs in groups(cols):
        a, b = np.searchsorted(cell, [c, c + 1])
        mine = rows[pairs]
        i, j, d = nearest_by_ring(q[mine], points[a:b], r[a:b], ids[a:b], cells.leaves.pivots[c], k, p, reach[mine])
        i = mine[i]
        keep = d <= widened(reach[i])
        i, j, d = i[keep], j[keep] + a, d[keep]
        if len(i):
            shrink(reach, i, d, k)
            held.append((i, d, ids[j], labels[j]))
            size += len(i)
            if size > TILE:
                held = [_best(held, k)]
                size = len(held[0][0])
    i, d, ids, labels = _best(held, k)
    keep = d <= widened(reach[i])
    return i[keep], d[keep], ids[keep], labels[keep]


def _best(held: list[tuple[np.ndarray, ...]], k: int) -> tuple[np.ndarray, ...]:
    found = [np.concatenate(x) for x in zip(*held)]
    best = k_first(found[0], found[1], found[2], k)
    return tuple(x[best] for x in found)


def _onward(
    q: np.ndarray, reach: np.ndarray, homes: np.ndarray, routes: np.ndarray, cells: Cells, starts: np.ndarray, p: int
) -> list[pa.Array]:
    """For each query the other shelves to ask, and the first and last cell to meet there; none but for ``routes``."""
    rows, cols = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
    low, high = np.full(len(q), np.iinfo(np.int32).max), np.full(len(q), -1)
    for at in _tiles(len(routes), len(cells.leaves.pivots)):
        some = routes[at]
        i, c = cells.others(q[some], reach[some], homes[some], p)
        np.minimum.at(low, some[i], c)
        np.maximum.at(high, some[i], c)
        pairs = np.unique(some[i] * len(starts) + np.searchsorted(starts, c, side="right") - 1)
        rows.append(pairs // len(starts))
        cols.append(pairs % len(starts))
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    return [lists(len(q), rows, pa.array(cols.astype(np.int32))), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))]


def _numbers(spark: SparkSession, name: str, numbers: dict[str, np.ndarray], limits: SearchLimits):
    """A function that adds the numbers of the row's cell or shelf, its ``name``, to a table."""
    n = len(next(iter(numbers.values())))
    if n <= limits.flat_pivots:
        of = {c: literal_array(x.tolist(), "int")[F.col(name)] for c, x in numbers.items()}
        return lambda df: df.withColumns(of)
    table = pa.table({name: pa.array(np.arange(n, dtype=np.int32)), **{c: pa.array(x.astype(np.int32)) for c, x in numbers.items()}})
    # At most limits.max_pivots rows.
    known = F.broadcast(spark.createDataFrame(table))
    return lambda df: df.join(known, name)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((shelf, row block, query block, whether queries), rows) of each stretch of a sorted batch."""
    if not batch.num_rows:
        return
    place = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("shelf", "tb", "qb", "asks")], axis=1)
    ends = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), len(place)]
    for a, b in zip(ends, ends[1:]):
        yield tuple(place[a].tolist()), batch.slice(a, b - a)


def _ordered(held: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, ...]:
    """(points, distances to the pivot, ids, labels, cells) by cell and distance to its pivot."""
    if not held:
        none = np.empty(0, dtype=np.int64)
        return np.empty((0, width)), np.empty(0), none, none, none
    rows = pa.Table.from_batches(held)
    r, cell = rows["r"].to_numpy(), rows["cell"].to_numpy().astype(np.int64)
    order = np.lexsort((r, cell))
    ids, labels = (rows[c].to_numpy().astype(np.int64)[order] for c in ("id", "label"))
    return matrix(rows["features"])[order], r[order], ids, labels, cell[order]


def _search(index: NeighbourIndex, queries: DataFrame, k: int, key: str, limits: SearchLimits) -> DataFrame:
    """Two rounds. The cell a query falls into gives k near rows, and with them a tight bound; the second
    round visits only the other cells that can hold a row within it."""
    spark, p = queries.sparkSession, index.p
    counts, width = index.cells.leaves.counts, index.cells.leaves.pivots.shape[1]
    n_queries = queries.select(quoted(key)).count()
    sized = grown(limits, int(counts.sum()), n_queries, 0, 0.0, spark.sparkContext.defaultParallelism)
    starts = shelves(counts, max(1, min(sized.block_train, sized.block_cells // max(1, width))))
    shared = spark.sparkContext.broadcast((index.cells, starts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, starts = shared.value
        for batch in batches:
            if batch.num_rows:
                cell, reach = cells.home(matrix(batch.column("features")), p)
                shelf = np.searchsorted(starts, cell, side="right") - 1
                columns = [batch.column(key), batch.column("features"), pa.array(reach)]
                columns += [pa.array(x.astype(np.int32)) for x in (cell, shelf, cell, cell)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "features", "reach", "cell", "shelf", "low", "high"])

    points = queries.select(quoted(key), "features")
    added = T._parse_datatype_string("reach double, cell int, shelf int, low int, high int").fields
    homed = points.mapInArrow(place, T.StructType([*points.schema.fields, *added]))
    homed = materialise(homed, "homed")
    first = materialise(_by_shelf(index, starts, homed, key, k, True, n_queries, limits), "first_round")
    onward = first.select(quoted(key), "features", "reach", "cell", F.explode("shelves").alias("shelf"), "low", "high")
    second = _by_shelf(index, starts, onward, key, k, False, n_queries, limits)
    found = first.select(quoted(key), "neighbours").unionByName(second)
    # Few rows a query: each block sends at most k, and only those within the bound.
    merged = found.groupBy(quoted(key)).agg(F.flatten(F.collect_list("neighbours")).alias("n"))
    best = merged.select(quoted(key), F.slice(F.array_sort("n"), 1, k).alias("neighbours"))
    return queries.drop("features").join(best, key, "left")
