"""Growth of gini trees, level by level, from class histograms over bins.

Features are binned once, by their distinct values where these are few, else by quantiles. A level is one pass over
the binned rows: counts per (node, bin, class) are added up in each task and combined in one small shuffle, and every
node is decided where its histogram lies. Trees of all leaf sizes grow from the same histograms; as long as they agree
they share their nodes.

* Exact growth also bounds what a cut inside a bin could reach. The weighted impurity is concave in the counts to the
  left of the cut, so its least value over all cuts inside a bin is not below its least value at the corners of the box
  of those counts. Only bins whose bound can still win are counted by value, in a second pass over their rows alone.
* Binned growth cuts between bins only. It counts the smaller child of each split; the histogram of the other is the
  parent's less that.

A last pass finds the middle between the values on either side of each cut.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import literal_array
from tamiz.functions.running import running_totals
from tamiz.session import materialise

# The functions that run in tasks travel with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Impurities are compared at this many decimals, so that rounding noise decides no tie.
DECIMALS = 9
# Cells of a histogram that a task adds up in place (8 bytes each), and of those that one call decides.
DENSE, BLOCK = 1 << 22, 1 << 18
# Corners of a box are all looked at up to so many classes; beyond, the slope of the impurity bounds it.
CORNER_CLASSES = 8
# Aggregates of more features are done on (feature, value) pairs.
WIDE_TABLE = 8
# Exact growth takes one bin a value where a feature has at most so many, or in a table of few rows so many; else
# quantiles. More bins make larger histograms, but need no second pass. They change no result.
VALUES, VALUES_OF_FEW_ROWS, FEW_ROWS = 256, 16_384, 1 << 20
QUANTILES, SKETCH_ACCURACY = 1_024, 10_000


# ---------------------------------------------------------------- bins


@dataclass(frozen=True)
class Bins:
    """``edges``: per feature the last value of each bin but the last, ascending. Bins of all features are numbered
    through, so that a histogram is one array [bin, class]. ``whole``: every bin holds one value."""

    edges: tuple[np.ndarray, ...]
    whole: bool = False

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(e) + 1 for e in self.edges], dtype=np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)[:-1]])

    @property
    def total(self) -> int:
        return int(self.sizes.sum())

    @property
    def feature(self) -> np.ndarray:
        """Of each bin."""
        return np.repeat(np.arange(len(self.edges)), self.sizes)

    @property
    def kind(self) -> str:
        return "<u1" if self.sizes.max(initial=1) <= 256 else "<u4"

    def place(self, x: np.ndarray) -> np.ndarray:
        """[row, feature] -> number of the bin within its feature."""
        out = np.empty(x.shape, dtype=self.kind)
        for f, edges in enumerate(self.edges):
            out[:, f] = np.searchsorted(edges, x[:, f], side="left")
        return out


def fit_bins(rows: DataFrame, width: int, bins: int) -> Bins:
    """``rows`` has features (array<double>). All values of a feature with at most ``bins`` of them, else quantiles; at
    most ``1.1 * width * bins`` numbers reach the driver."""
    quantiles = min(bins, QUANTILES)
    shares = [i / quantiles for i in range(1, quantiles)]

    def measures(value):
        return [F.percentile_approx(value, shares, SKETCH_ACCURACY).alias("q"), F.approx_count_distinct(value, 0.02).alias("n")]

    cells = rows.select(F.posexplode("features").alias("feature", "value"))
    if width > WIDE_TABLE:
        found = cells.groupBy("feature").agg(*measures(F.col("value"))).collect()
    else:
        each = [F.struct(F.lit(f).alias("feature"), *measures(F.col("features")[f])) for f in range(width)]
        found = [r[f] for r in rows.agg(*[e.alias(f"f{f}") for f, e in enumerate(each)]).collect() for f in range(width)]
    few = [r["feature"] for r in found if r["n"] and r["n"] <= 1.1 * bins]
    values: dict[int, list[float]] = {}
    if few:
        distinct = cells.where(F.col("feature").isin(few)).distinct()
        for f, v in distinct.groupBy("feature").agg(F.collect_list("value")).collect():
            values[f] = v
    edges, whole = [np.empty(0)] * width, True
    for r in found:
        own = np.unique(np.asarray(values.get(r["feature"], []), dtype=np.float64))
        if 0 < len(own) <= bins:
            edges[r["feature"]] = own[:-1]
        else:
            edges[r["feature"]], whole = np.unique(np.asarray(r["q"] or [], dtype=np.float64)), False
    return Bins(tuple(edges), whole)


# ---------------------------------------------------------------- what is known of the trees


@dataclass
class GrownNode:
    depth: int
    counts: np.ndarray


@dataclass
class Split:
    """Rows go left if their bin is at most ``cut`` or, with a ``value``, if theirs is at most that."""

    feature: int
    cut: int
    value: float | None
    left: int
    right: int
    threshold: float = 0.0


@dataclass
class Grown:
    """Nodes of all trees, and by leaf size the split of each inner node."""

    nodes: list[GrownNode]
    splits: dict[int, dict[int, Split]]

    def paths(self, leaf_size: int) -> Paths:
        n = len(self.nodes)
        out = Paths(np.full(n, -1), np.zeros(n, np.int64), np.full(n, np.nan), np.zeros(n, np.int64), np.zeros(n, np.int64))
        for i, s in self.splits[leaf_size].items():
            out.feature[i], out.cut[i], out.left[i], out.right[i] = s.feature, s.cut, s.left, s.right
            if s.value is not None:
                out.value[i] = s.value
        return out

    @property
    def by_value(self) -> bool:
        return any(s.value is not None for of in self.splits.values() for s in of.values())


@dataclass(frozen=True)
class Paths:
    """One tree as arrays over all nodes."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def step(self, node: np.ndarray, bins: np.ndarray, x: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(next node, whether it is another, whether it is the left one)."""
        rows, f = np.arange(len(node)), self.feature[node]
        inner, f = f >= 0, np.maximum(f, 0)
        below = bins[rows, f] <= self.cut[node]
        if x is not None:
            value = self.value[node]
            below = np.where(np.isnan(value), below, x[rows, f] <= value)
        return np.where(inner, np.where(below, self.left[node], self.right[node]), node), inner, below

    def walk(self, bins: np.ndarray, x: np.ndarray | None) -> np.ndarray:
        node = np.zeros(len(bins), dtype=np.int64)
        while True:
            node, inner, _ = self.step(node, bins, x)
            if not inner.any():
                return node


# ---------------------------------------------------------------- impurity


def impurity(side: np.ndarray) -> np.ndarray:
    """Weight of a side times its gini impurity; classes on the last axis."""
    total, squares = side.sum(axis=-1), (side * side).sum(axis=-1)
    return total - np.divide(squares, total, out=np.zeros_like(total), where=total > 0)


def inner_bounds(before: np.ndarray, inside: np.ndarray, totals: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """No cut inside a bin has less impurity (both sides together). ``before`` and ``inside``: counts [bin, class], two
    rows or more inside."""
    pure = np.count_nonzero(inside, axis=1) == 1
    if pure.any():
        # Along one class the ends of the bin are no cuts inside it: one row is on either side.
        out, one = np.empty(len(before)), (inside[pure] > 0).astype(np.int64)
        ends = [before[pure] + one, before[pure] + inside[pure] - one]
        out[pure] = np.minimum(*[impurity(e * weights) + impurity((totals - e) * weights) for e in ends])
        out[~pure] = inner_bounds(before[~pure], inside[~pure], totals, weights)
        return out
    classes = before.shape[1]
    if classes > CORNER_CLASSES:
        # Moving weight from one side to the other changes the sum by at most twice that weight.
        at = impurity(before * weights) + impurity((totals - before) * weights)
        after = impurity((before + inside) * weights) + impurity((totals - before - inside) * weights)
        return np.maximum(0.0, np.maximum(at, after) - 2 * (inside * weights).sum(axis=1))
    corners = (np.arange(1 << classes)[:, None] >> np.arange(classes)) & 1
    out = np.empty(len(before))
    for low in range(0, len(before), 4096):
        left = before[low : low + 4096, None, :] + corners[None] * inside[low : low + 4096, None, :]
        out[low : low + 4096] = (impurity(left * weights) + impurity((totals - left) * weights)).min(axis=1)
    return out


@dataclass
class Decision:
    """Of a node: per leaf size the best cut between bins (score, bin, counts to the left) or None, and the bins inside
    which a better one may lie, with the counts before and inside them."""

    best: list[tuple[float, int, np.ndarray] | None]
    open: np.ndarray
    before: np.ndarray
    inside: np.ndarray


def decide(counts: np.ndarray, bins: Bins, weights: np.ndarray, leaf_sizes: Sequence[int], single: np.ndarray | None) -> Decision:
    """``counts`` [bin, class]. ``single``: bins of one value; None for cuts between bins only."""
    totals = counts[: bins.sizes[0]].sum(axis=0)
    # Bins without rows part nothing; every feature has some with rows, which add up to the same totals.
    bin_of = np.flatnonzero(counts.any(axis=1))
    counts = counts[bin_of]
    through = counts.cumsum(axis=0) - bins.feature[bin_of, None] * totals
    n, n_left = int(totals.sum()), through.sum(axis=1)
    whole = (totals * weights).sum()
    score = np.round((impurity(through * weights) + impurity((totals - through) * weights)) / whole, DECIMALS)
    best: list[tuple[float, int, np.ndarray] | None] = []
    for size in leaf_sizes:
        valid = (n_left >= max(1, size)) & (n - n_left >= max(1, size))
        at = int(np.where(valid, score, np.inf).argmin())  # the lowest feature and cut of equal ones
        best.append((float(score[at]), int(bin_of[at]), through[at]) if valid[at] else None)
    none = np.empty(0, dtype=np.int64)
    if single is None:
        return Decision(best, none, none, none)
    inside_n = counts.sum(axis=1)
    before = through - counts
    least = max(1, min(leaf_sizes))
    inner = (inside_n >= 2) & ~single[bin_of] & (n_left - 1 >= least) & (n - (n_left - inside_n) - 1 >= least)
    at = np.flatnonzero(inner)
    bound = np.round(inner_bounds(before[at], counts[at], totals, weights) / whole - 1e-12, DECIMALS)
    keep = np.zeros(len(at), dtype=bool)
    for b in best:
        # An equal cut wins if it comes first: by feature, then by value.
        keep |= True if b is None else (bound < b[0]) | ((bound == b[0]) & (bin_of[at] <= b[1]))
    at = at[keep]
    return Decision(best, bin_of[at], before[at], counts[at])


# ---------------------------------------------------------------- passes over the rows


def features_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


@dataclass(frozen=True)
class Table:
    """Binned training rows (label: position of the class, bins: packed, features), and how to read them."""

    rows: DataFrame
    bins: Bins
    classes: int

    def columns(self, grown: Grown) -> DataFrame:
        """Values are only read once a tree is cut inside a bin."""
        return self.rows.select("label", "bins", *(["features"] if grown.by_value else []))

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        width = len(self.bins.edges)
        packed = np.frombuffer(b"".join(batch.column("bins").to_pylist()), self.bins.kind)
        x = features_of(batch, width) if "features" in batch.schema.names else None
        return batch.column("label").to_numpy(), packed.reshape(batch.num_rows, width), x


def store_table(rows: DataFrame, classes: Sequence[int], bins: Bins) -> Table:
    """``rows``: (label long, features array<double>)."""
    width = len(bins.edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                places = bins.place(features_of(batch, width))
                packed = pa.array([r.tobytes() for r in places], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label"), packed, batch.column("features")], names=["label", "bins", "features"]
                )

    label = F.array_position(literal_array(classes, "long"), F.col("label")).cast("int") - 1
    known = rows.select(label.alias("label"), "features")
    stored = known.mapInArrow(run, "label int, bins binary, features array<double>")
    return Table(materialise(stored, "binned"), bins, len(classes))


def without_spark(table: Table) -> Table:
    """What tasks need of it."""
    return Table(None, table.bins, table.classes)


def slot_numbers(paths: Sequence[Paths], slots: np.ndarray, bins: np.ndarray, x: np.ndarray | None) -> list[np.ndarray]:
    """Per tree the slot of each row's node, -1 for none or where an earlier tree has the row in the same node."""
    seen: list[np.ndarray] = []
    out = []
    for p in paths:
        node = p.walk(bins, x)
        mine = slots[node]
        for other in seen:
            mine = np.where(other == node, -1, mine)
        seen.append(node)
        out.append(mine)
    return out


def count_cells(table: Table, grown: Grown, nodes: Sequence[int]) -> DataFrame:
    """(block, cell, n): the histograms of ``nodes``, cell = (place in nodes * bins + bin) * classes + class."""
    known, paths = without_spark(table), [grown.paths(m) for m in grown.splits]
    slots = np.full(len(grown.nodes), -1)
    slots[list(nodes)] = np.arange(len(nodes))
    starts, size = table.bins.starts, table.bins.total * table.classes
    cells, per_block = len(nodes) * size, size * max(1, BLOCK // size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells if cells <= DENSE else 0, dtype=np.int64)
        held: list[np.ndarray] = []

        def out(cell: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            block = pa.array((cell // per_block).astype(np.int32))
            return pa.RecordBatch.from_arrays([block, pa.array(cell), pa.array(n)], names=["block", "cell", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            label, bins, x = known.read(batch)
            for slot in slot_numbers(paths, slots, bins, x):
                at = np.flatnonzero(slot >= 0)
                cell = slot[at, None] * size + (starts + bins[at]) * known.classes + label[at, None]
                if len(total):
                    total += np.bincount(cell.ravel(), minlength=cells)
                else:
                    held.append(cell.ravel())
            if sum(map(len, held)) >= DENSE:
                yield out(*np.unique(np.concatenate(held), return_counts=True))
                held.clear()
        if held:
            yield out(*np.unique(np.concatenate(held), return_counts=True))
        at = np.flatnonzero(total)
        if len(at):
            yield out(at, total[at])

    counted = table.columns(grown).mapInArrow(run, "block int, cell long, n long")
    return counted.groupBy("block", "cell").agg(F.sum("n").alias("n"))


DECISIONS = (
    "node int, scores array<double>, cuts array<int>, lefts array<bigint>, "
    "open array<int>, before array<bigint>, inside array<bigint>, counts binary"
)


def decision_rows(found: Sequence[tuple[int, Decision, np.ndarray | None]]) -> pa.Table:
    def whole(x) -> list[int]:
        return np.asarray(x, dtype=np.int64).ravel().tolist()

    rows = [
        {
            "node": node,
            "scores": [b[0] if b else None for b in d.best],
            "cuts": [b[1] if b else None for b in d.best],
            "lefts": [n for b in d.best if b for n in whole(b[2])],
            "open": whole(d.open),
            "before": whole(d.before),
            "inside": whole(d.inside),
            "counts": None if counts is None else counts.tobytes(),
        }
        for node, d, counts in found
    ]
    longs = pa.list_(pa.int64())
    kinds = {"node": pa.int32(), "scores": pa.list_(pa.float64()), "cuts": pa.list_(pa.int32()), "lefts": longs}
    kinds |= {"open": pa.list_(pa.int32()), "before": longs, "inside": longs, "counts": pa.binary()}
    return pa.Table.from_pylist(rows, schema=pa.schema(list(kinds.items())))


def read_decision(row, leaf_sizes: int, classes: int) -> Decision:
    lefts = iter(np.array(row["lefts"], dtype=np.int64).reshape(-1, classes))
    best = [None if c is None else (s, c, next(lefts)) for s, c in zip(row["scores"], row["cuts"])]
    before, inside = (np.array(row[c], dtype=np.int64).reshape(-1, classes) for c in ("before", "inside"))
    return Decision(best, np.array(row["open"], dtype=np.int64), before, inside)


def dense(cells: pa.Table, low: int, size: int, slots: int) -> np.ndarray:
    """Histograms of ``slots`` nodes from the cells of a block that begins at cell ``low``."""
    out = np.zeros(slots * size, dtype=np.int64)
    np.add.at(out, cells["cell"].to_numpy() - low, cells["n"].to_numpy())
    return out.reshape(slots, size)


@dataclass
class Level:
    """One level: nodes to decide, and by which leaf sizes they may be split (places in ``sizes``)."""

    sizes: tuple[int, ...]
    active: Mapping[int, tuple[int, ...]]


def decide_level(table: Table, grown: Grown, level: Level, weights: np.ndarray, single: np.ndarray) -> list:
    """Decisions of all nodes of the level, each from its own counts."""
    bins, classes, size = table.bins, table.classes, table.bins.total * table.classes
    nodes = list(level.active)
    per_block = max(1, BLOCK // size)
    sizes, active = level.sizes, dict(level.active)

    def run(key: tuple, cells: pa.Table) -> pa.Table:
        first = key[0].as_py() * per_block
        mine = nodes[first : first + per_block]
        found = []
        for node, counts in zip(mine, dense(cells, first * size, size, len(mine))):
            d = decide(counts.reshape(-1, classes), bins, weights, [sizes[i] for i in active[node]], single)
            found.append((node, d, None))
        return decision_rows(found)

    return count_cells(table, grown, nodes).groupBy("block").applyInArrow(run, DECISIONS).collect()


def decide_by_siblings(
    table: Table, grown: Grown, level: Level, pairs: Sequence[tuple[int, int, int]], before: DataFrame | None, weights: np.ndarray
) -> DataFrame:
    """The same from stored histograms ``before`` of the parents: of each pair (parent, smaller child, larger child) only
    the smaller is counted. Stored again, with the histograms of the level."""
    bins, classes, size = table.bins, table.classes, table.bins.total * table.classes
    per_block = max(1, BLOCK // size)
    sizes, active = level.sizes, dict(level.active)

    def decided(node: int, counts: np.ndarray) -> tuple[int, Decision, np.ndarray]:
        counts = counts.reshape(-1, classes)
        return node, decide(counts, bins, weights, [sizes[i] for i in active[node]], None), counts

    if before is None:

        def root(key: tuple, cells: pa.Table) -> pa.Table:
            return decision_rows([decided(0, dense(cells, 0, size, 1)[0])])

        counted = count_cells(table, grown, [0])
        return materialise(counted.groupBy("block").applyInArrow(root, DECISIONS), "level")

    def run(key: tuple, cells: pa.Table, parents: pa.Table) -> pa.Table:
        first = key[0].as_py() * per_block
        mine = pairs[first : first + per_block]
        whole = dict(zip(parents["slot"].to_pylist(), parents["counts"].to_pylist()))
        found = []
        for i, ((_, smaller, larger), counts) in enumerate(zip(mine, dense(cells, first * size, size, len(mine)))):
            if smaller in active:
                found.append(decided(smaller, counts))
            if larger in active:
                found.append(decided(larger, np.frombuffer(whole[first + i], dtype=np.int64) - counts))
        return decision_rows(found)

    # As many rows as the level has splits, which the driver holds anyway.
    slots = table.rows.sparkSession.createDataFrame(
        [(parent, i, i // per_block) for i, (parent, _, _) in enumerate(pairs)], "node int, slot int, block int"
    )
    parents = before.select("node", "counts").join(F.broadcast(slots), "node").select("block", "slot", "counts")
    counted = count_cells(table, grown, [smaller for _, smaller, _ in pairs])
    both = counted.groupBy("block").cogroup(parents.groupBy("block"))
    return materialise(both.applyInArrow(run, DECISIONS), "level")


def impurity_sql(side: Sequence[str], weights: Sequence[float]) -> str:
    """``impurity`` of counts given as SQL text."""
    weighed = [f"{n} * {float(w)!r}D" for n, w in zip(side, weights)]
    total = "(" + " + ".join(weighed) + ")"
    squares = "(" + " + ".join(f"({x}) * ({x})" for x in weighed) + ")"
    return f"({total} - coalesce(try_divide({squares}, {total}), 0D))"


def inner_splits(
    table: Table, grown: Grown, level: Level, decisions: Mapping[int, Decision], totals: Mapping[int, np.ndarray], weights: np.ndarray
) -> dict[tuple[int, int], tuple[float, int, float, np.ndarray]]:
    """{(node, place in sizes): (score, bin, value, counts to the left)}: the best cuts inside the open bins, counted by
    value."""
    entries = [(node, int(b), d.before[i], d.inside[i]) for node, d in decisions.items() for i, b in enumerate(d.open)]
    known, paths = without_spark(table), [grown.paths(m) for m in grown.splits]
    slots = np.full(len(grown.nodes), -1)
    slots[list(decisions)] = np.arange(len(decisions))
    place = {node: i for i, node in enumerate(decisions)}
    starts, total = table.bins.starts, table.bins.total
    keys = np.array([place[node] * total + b for node, b, _, _ in entries], dtype=np.int64)
    order = np.argsort(keys)
    keys = keys[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            label, bins, x = known.read(batch)
            for slot in slot_numbers(paths, slots, bins, x):
                at = np.flatnonzero(slot >= 0)
                for f in range(bins.shape[1]):
                    key = slot[at] * total + starts[f] + bins[at, f]
                    i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = np.flatnonzero(keys[i] == key)
                    if len(hit):
                        columns = [order[i[hit]].astype(np.int32), x[at[hit], f], label[at[hit]]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["entry", "value", "label"])

    names = [f"n_{c}" for c in range(table.classes)]
    counts = (
        table.rows.mapInArrow(run, "entry int, value double, label int")
        .groupBy("entry", "value")
        .agg(*[F.expr(f"count_if(label = {c})").alias(n) for c, n in enumerate(names)])
    )
    ranked = running_totals(counts, ["entry"], "value", names, int(sum(inside.sum() for *_, inside in entries)))
    facts = [
        (i, node, b, *before.tolist(), *totals[node].tolist()) for i, (node, b, before, _) in enumerate(entries)
    ]
    fields = [f"{k}_{c} long" for k in "bt" for c in range(table.classes)]
    spark = table.rows.sparkSession
    # One row for each open bin, of which a level has at most its nodes times its bins.
    facts = spark.createDataFrame(facts, ", ".join(["entry int", "node int", "bin int", *fields]))
    below = [f"(b_{c} + n_{c}_before)" for c in range(table.classes)]
    above = [f"(t_{c} - b_{c} - n_{c}_before)" for c in range(table.classes)]
    whole = "(" + " + ".join(f"t_{c} * {float(w)!r}D" for c, w in enumerate(weights)) + ")"
    cuts = (
        ranked.where("value_prev IS NOT NULL")
        .join(F.broadcast(facts), "entry")
        .selectExpr(
            "node",
            "bin",
            f"{MIDDLE.format(a='value_prev', b='value')} AS value",
            f"round(({impurity_sql(below, weights)} + {impurity_sql(above, weights)}) / {whole}, {DECIMALS}) AS score",
            f"array({', '.join(below)}) AS lefts",
            f"least({' + '.join(below)}, {' + '.join(above)}) AS least",
        )
    )
    first = [
        F.min(F.expr(f"CASE WHEN least >= {max(1, m)} THEN struct(score, bin, value, lefts) END")).alias(f"m_{i}")
        for i, m in enumerate(level.sizes)
    ]
    out = {}
    for r in cuts.groupBy("node").agg(*first).collect():
        for i in level.active[r["node"]]:
            if (b := r[f"m_{i}"]) is not None:
                out[r["node"], i] = b["score"], b["bin"], b["value"], np.array(b["lefts"], dtype=np.int64)
    return out


# Between neighbouring doubles there is no middle: then the lower one divides.
MIDDLE = "if({a} + ({b} - {a}) / 2 < {b}, {a} + ({b} - {a}) / 2, {a})"


def middle(a: float, b: float) -> float:
    m = a + (b - a) / 2
    return m if m < b else a


def set_thresholds(table: Table, grown: Grown) -> None:
    """One pass: the largest value to the left of each cut and the smallest to its right."""
    known, trees = without_spark(table), [(grown.paths(m), i) for i, m in enumerate(grown.splits)]
    n = len(grown.nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(n * len(trees), -np.inf), np.full(n * len(trees), np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, bins, x = known.read(batch)
            for paths, i in trees:
                node, rows = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
                while len(rows):
                    after, inner, below = paths.step(node, bins[rows], x[rows])
                    value, at = x[rows, np.maximum(paths.feature[node], 0)], i * n + node
                    np.maximum.at(low, at[inner & below], value[inner & below])
                    np.minimum.at(high, at[inner & ~below], value[inner & ~below])
                    node, rows = after[inner], rows[inner]
        at = np.flatnonzero((low > -np.inf) | (high < np.inf))
        columns = [pa.array(at.astype(np.int32)), pa.array(low[at]), pa.array(high[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "low", "high"])

    ends = table.rows.mapInArrow(run, "at int, low double, high double").groupBy("at").agg(F.max("low").alias("low"), F.min("high").alias("high"))
    sizes = list(grown.splits)
    for r in ends.collect():
        grown.splits[sizes[r["at"] // n]][r["at"] % n].threshold = middle(r["low"], r["high"])


def single_values(table: Table) -> np.ndarray:
    """Bins that hold one value: one pass, as many numbers as bins."""
    known, starts, total = without_spark(table), table.bins.starts, table.bins.total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(total, np.inf), np.full(total, -np.inf)
        for batch in batches:
            if batch.num_rows:
                _, bins, x = known.read(batch)
                at = (starts + bins).ravel()
                np.minimum.at(low, at, x.ravel())
                np.maximum.at(high, at, x.ravel())
        at = np.flatnonzero(low < np.inf)
        columns = [pa.array(at.astype(np.int32)), pa.array(low[at]), pa.array(high[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["bin", "low", "high"])

    ends = table.rows.mapInArrow(run, "bin int, low double, high double").groupBy("bin").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.ones(total, dtype=bool)
    for r in ends.collect():
        out[r["bin"]] = r["low"] == r["high"]
    return out


# ---------------------------------------------------------------- growth


@dataclass
class Growth:
    """Grows the trees of all ``leaf_sizes`` to ``max_depth``. ``counts``: rows per class, in the order of ``classes``."""

    rows: DataFrame
    classes: Sequence[int]
    weights: Sequence[float]
    counts: Sequence[int]
    width: int
    leaf_sizes: tuple[int, ...]
    max_depth: int
    # None: as many as suit the table.
    bins: int | None = None
    exact: bool = True
    grown: Grown = field(init=False)

    def may_split(self, node: int) -> tuple[int, ...]:
        """Places of the leaf sizes."""
        counts = self.grown.nodes[node].counts
        if np.count_nonzero(counts) < 2:
            return ()
        return tuple(i for i, m in enumerate(self.leaf_sizes) if counts.sum() >= max(2, 2 * m))

    def run(self) -> Grown:
        self.grown = Grown([GrownNode(0, np.array(self.counts, dtype=np.int64))], {m: {} for m in self.leaf_sizes})
        active = {0: self.may_split(0)}
        if self.max_depth < 1 or not active[0]:
            return self.grown
        bins = self.bins or (VALUES_OF_FEW_ROWS if sum(self.counts) <= FEW_ROWS else VALUES)
        table = store_table(self.rows, self.classes, fit_bins(self.rows, self.width, bins))
        if table.bins.total * table.classes > 1 << 27:
            raise ValueError("the histogram of one node has too many cells: fewer bins, please")
        weights = np.array(self.weights, dtype=np.float64)
        single = None
        if self.exact:
            # Where all values are edges there is nothing inside the bins.
            single = np.ones(table.bins.total, dtype=bool) if table.bins.whole else single_values(table)
        stored, pairs = None, []
        for depth in range(self.max_depth):
            level = Level(self.leaf_sizes, {n: m for n, m in active.items() if m})
            if not level.active:
                break
            if self.exact:
                rows = decide_level(table, self.grown, level, weights, single)
            else:
                pairs = [p for p in pairs if p[1] in level.active or p[2] in level.active]
                stored = decide_by_siblings(table, self.grown, level, pairs, stored, weights)
                rows = stored.drop("counts").collect()
            decisions = {r["node"]: read_decision(r, len(self.leaf_sizes), table.classes) for r in rows}
            inner = {}
            if any(len(d.open) for d in decisions.values()):
                totals = {n: self.grown.nodes[n].counts for n in decisions}
                inner = inner_splits(table, self.grown, level, {n: d for n, d in decisions.items() if len(d.open)}, totals, weights)
            active, pairs = self.split(table.bins, level, decisions, inner, depth)
        set_thresholds(table, self.grown)
        return self.grown

    def split(self, bins: Bins, level: Level, decisions: Mapping[int, Decision], inner: Mapping, depth: int) -> tuple[dict, list]:
        """(nodes of the next level by the leaf sizes that may split them, pairs of siblings)."""
        feature, starts = bins.feature, bins.starts
        active: dict[int, tuple[int, ...]] = {}
        pairs = []
        for node in sorted(decisions):
            made: dict[tuple, tuple[int, int]] = {}
            for i, between in zip(level.active[node], decisions[node].best):
                cuts = []
                if between is not None:
                    score, b, left = between
                    cuts.append((score, b, 1, None, left))
                if (within := inner.get((node, i))) is not None:
                    score, b, value, left = within
                    cuts.append((score, b, 0, value, left))
                if not cuts:
                    continue
                # By feature, then by value: inside a bin before its end.
                _, b, _, value, left = min(cuts, key=lambda c: c[:3])
                if (b, value) not in made:
                    children = len(self.grown.nodes), len(self.grown.nodes) + 1
                    made[b, value] = children
                    right = self.grown.nodes[node].counts - left
                    self.grown.nodes += [GrownNode(depth + 1, left), GrownNode(depth + 1, right)]
                    smaller, larger = children if left.sum() <= right.sum() else children[::-1]
                    pairs.append((node, smaller, larger))
                children = made[b, value]
                f = int(feature[b])
                self.grown.splits[self.leaf_sizes[i]][node] = Split(f, int(b - starts[f]), value, *children)
                for child in children:
                    active[child] = (*active.get(child, ()), *[j for j in self.may_split(child) if j == i])
        return active, pairs


