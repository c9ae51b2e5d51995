"""Vector codes by product quantisation, trained with adaptive distance bounds (Drake and Hamerly).

Vectors become integers and are cut into equal parts; each part position has a codebook. A part keeps, besides the
entry that it is assigned to, the b entries next to it with ordered lower bounds of their distances, and one outer
bound for all other entries. This state is a table: a round reads it, moves the bounds by how far the entries moved,
and writes the next. Where the exact distance to the assigned entry lies below the first bound, nothing else is
looked at. Otherwise the entries whose bounds it reaches are compared by integer distances, and all of them only where
it reaches the outer bound. After a round b becomes what would have been the cheapest.

Entries and their sums are a few numbers per codebook; the rows never leave the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.functions.columns import quoted
from tamiz.llm.common import ScratchTables
from tamiz.session import materialise

# Larger components would not leave room for sums of squares in 64 bits.
LARGEST = 1 << 27
# What moving one bound costs, in integer distances.
BOUND_COST = 0.25
# Label sums of so many labels are sent to the executors.
LABELS = 100_000


@dataclass(frozen=True)
class Codebooks:
    """``entries[part, entry, component]``."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all components, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: str) -> list[int]:
        """The integer vector that a code stands for."""
        at = np.frombuffer(bytes.fromhex(code), np.uint8)
        return self.entries[np.arange(len(at)), at].ravel().tolist()


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1)


def root_up(squared: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(np.sqrt(squared.astype(np.float64)), np.inf), np.inf)


def floats_below(x: np.ndarray) -> np.ndarray:
    """Bounds are stored with 32 bits, rounded down."""
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


@dataclass
class Bounds:
    """Of points in rows: the assigned entry, the ``near`` ones [point, b], and ``low`` [point, b + 1]: their lower
    bounds in order, then the outer bound."""

    assigned: np.ndarray
    near: np.ndarray
    low: np.ndarray

    def narrowed(self, b: int) -> Bounds:
        """With the ``b`` nearest only, for bounds in order: the first that goes is the new outer one."""
        return Bounds(self.assigned, self.near[:, :b], self.low[:, : b + 1])

    def moved(self, part: np.ndarray, moves: np.ndarray) -> Bounds:
        """After entry e of part p moved by ``moves[p, e]``."""
        low = self.low.astype(np.float64)
        b = self.near.shape[1]
        low[:, :b] -= moves[part[:, None], self.near]
        low[:, b] -= moves.max(axis=1, initial=0)[part]
        # Ordered again from the outside: no bound is above one behind it.
        low = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
        return Bounds(self.assigned, self.near, floats_below(low))


def all_distances(points: np.ndarray, part: np.ndarray, entries: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds from the distances to all entries, and the squares of those to the nearest; ties to lower entries."""
    k = entries.shape[1]
    d = np.stack([squares(points, entries[part, e]) for e in range(k)], axis=1)
    order = np.argsort(d, axis=1, kind="stable")
    d = np.take_along_axis(d, order, axis=1)
    low = np.full((len(points), b + 1), np.inf, dtype=np.float32)
    reach = min(k - 1, b + 1)
    low[:, :reach] = floats_below(np.sqrt(d[:, 1 : reach + 1].astype(np.float64)))
    return Bounds(order[:, 0].astype(np.uint8), order[:, 1 : b + 1].astype(np.uint8), low), d[:, 0]


def reassigned(
    points: np.ndarray, part: np.ndarray, entries: np.ndarray, old: Bounds
) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """New bounds, squared distances to the assigned entries, and how many bounds each point reached. ``old`` is moved
    already."""
    b = old.near.shape[1]
    assigned, near, low = old.assigned.copy(), old.near.copy(), old.low.copy()
    own = squares(points, entries[part, assigned])
    reached = (low.astype(np.float64) <= root_up(own)[:, None]).sum(axis=1)  # bounds are in order
    some = np.flatnonzero((reached > 0) & (reached <= b))
    if len(some):
        x, p, d, n = points[some], part[some], own[some].copy(), reached[some]
        best, place = assigned[some].copy(), np.full(len(some), -1)
        listed, bounds = near[some], low[some]
        for j in range(int(n.max())):
            at = np.flatnonzero(n > j)
            e = listed[at, j]
            found = squares(x[at], entries[p[at], e])
            bounds[at, j] = floats_below(np.sqrt(found.astype(np.float64)))
            closer = (found < d[at]) | ((found == d[at]) & (e < best[at]))
            won = at[closer]
            d[won], best[won], place[won] = found[closer], e[closer], j
        changed = np.flatnonzero(place >= 0)
        # The entry left behind takes the place of the new one.
        listed[changed, place[changed]] = assigned[some[changed]]
        bounds[changed, place[changed]] = floats_below(np.sqrt(own[some[changed]].astype(np.float64)))
        order = np.argsort(bounds[:, :b], axis=1, kind="stable")
        near[some] = np.take_along_axis(listed, order, axis=1)
        low[some, :b] = np.take_along_axis(bounds[:, :b], order, axis=1)
        assigned[some], own[some] = best, d
    far = np.flatnonzero(reached > b)
    if len(far):
        fresh, d = all_distances(points[far], part[far], entries, b)
        assigned[far], near[far], low[far], own[far] = fresh.assigned, fresh.near, fresh.low, d
    return Bounds(assigned, near, low), own, reached


def next_b(counts: Sequence[int], k: int) -> int:
    """The cheapest number of bounds, from how many points reached 0, 1, ... of them; at least k / 8."""
    b, n = len(counts) - 2, sum(counts)
    least = min(b, max(1, k // 8))

    def cost(size: int) -> float:
        exact = sum(c * (t if t <= size else k) for t, c in enumerate(counts))
        return exact + BOUND_COST * (size + 1) * n

    return min(range(least, b + 1), key=cost, default=b)


class Trainer:
    """What the tasks of a round know. ``b_old`` is the b of the table that they read, None at first."""

    def __init__(self, entries: np.ndarray, moves: np.ndarray, packing: Packing, b_old: int | None, b: int) -> None:
        self.entries, self.moves, self.packing, self.b_old, self.b = entries, moves, packing, b_old, b
        self.parts, self.k, self.width = entries.shape

    def assign(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "label", "points", "assigned", "near", "low", "reached", "error"]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x, part = self.packing.points(batch.column("points").to_pylist()), np.tile(np.arange(self.parts), n)
            if self.b_old is None:
                bounds, own = all_distances(x, part, self.entries, self.b)
                reached = np.full(len(x), self.b + 1)
            else:
                near, low, assigned = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), t)
                    for c, t in (("near", np.uint8), ("low", "<f4"), ("assigned", np.uint8))
                )
                shape = (n * self.parts, -1) if self.b_old else (n * self.parts, 0)
                old = Bounds(assigned, near.reshape(shape), low.reshape(n * self.parts, self.b_old + 1))
                bounds, own, reached = reassigned(x, part, self.entries, old.moved(part, self.moves).narrowed(self.b))

            def packed(values: np.ndarray, kind: str) -> pa.Array:
                return pa.array([row.tobytes() for row in values.astype(kind).reshape(n, -1)], pa.binary())

            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in names[:3]],
                    packed(bounds.assigned, "u1"),
                    packed(bounds.near, "u1"),
                    packed(bounds.low, "<f4"),
                    packed(reached, "u1"),
                    pa.array(own.reshape(n, self.parts).sum(axis=1), pa.int64()),
                ],
                names=names,
            )

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(cell, value): sums of components and counts per part and entry, then how many points reached how many
        bounds, for each task."""
        total = np.zeros((self.parts, self.k, self.width + 1), dtype=np.int64)
        reached = np.zeros(self.b + 2, dtype=np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = self.packing.points(batch.column("points").to_pylist()).reshape(n, self.parts, self.width)
            at, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("assigned", "reached"))
            at = at.reshape(n, self.parts)
            reached += np.bincount(t, minlength=self.b + 2)
            for p in range(self.parts):
                # Doubles add the integers of a batch exactly: they stay below 2^53.
                member = (at[:, p, None] == np.arange(self.k)).astype(np.float64)
                total[p, :, : self.width] += (member.T @ x[:, p].astype(np.float64)).astype(np.int64)
                total[p, :, self.width] += member.sum(axis=0).astype(np.int64)
        values = np.concatenate([total.ravel(), reached])
        cells = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.astype(np.int32)), pa.array(values[cells])], names=["cell", "value"]
        )


def finite_vectors(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, v: array<double>), without rows whose vector is NULL or holds a component that is NULL or not finite."""
    x = F.col("v")

    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    df = vectors.select(
        quoted(key).cast("long").alias("id"), quoted(label).alias("label"), quoted(vector).cast("array<double>").alias("v")
    )
    return df.where(x.isNotNull()).where(~F.exists(x, bad))


@dataclass(frozen=True)
class Packing:
    """How integers floor(scale * component) of a vector are laid out: ``parts`` of ``width`` each, zeros at the end."""

    scale: float
    parts: int
    width: int
    kind: str

    def rows(self, lists: pa.ListArray) -> list[bytes]:
        item = np.dtype(self.kind).itemsize
        flat = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * self.scale).astype(self.kind).tobytes()
        ends = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))]) * item
        size = self.parts * self.width * item
        return [flat[a:b].ljust(size, b"\0") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def points(self, packed: Sequence[bytes]) -> np.ndarray:
        """[row * part, component] in 64 bits."""
        flat = np.frombuffer(b"".join(packed), self.kind)
        return flat.reshape(len(packed) * self.parts, self.width).astype(np.int64)


def packing_of(df: DataFrame, scale: float, parts: int) -> Packing:
    x = F.col("v")
    longest, largest = df.agg(F.max(F.size("v")), F.max(F.array_max(F.transform(x, F.abs)))).first()
    largest = (largest or 0.0) * abs(scale) + 1
    if not largest < LARGEST:
        raise ValueError(f"components times {scale} must stay below {LARGEST}; there is one of {largest:.6g}")
    return Packing(scale, parts, -(-(longest or 0) // parts), "<i2" if largest < 1 << 15 else "<i4")


def train_codes(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: float = 4096,
) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error), codebooks): each vector's nearest entries as two hexadecimal digits a part, and the
    sum of its squared distances to them, all in integers floor(scale * component).

    A codebook starts as that part of the ``entries`` (at most 256) rows of the smallest ids (of equal ids the smaller
    vectors first, NULL ids last). A round assigns every part to the nearest entry, ties to the lower index, and
    moves each entry to the floor of the mean of its parts; an entry without parts stays. With fewer rows there are
    fewer entries.

    Rows whose vector is NULL or holds a component that is NULL or not finite are left out. Vectors of unequal lengths
    count as zero beyond their end, up to a multiple of ``parts``. Repeated rows count as often as they stand. Scaled
    components of 2^27 or more stop the job.
    """
    if not 1 <= entries <= 256:
        raise ValueError(f"entries is from 1 to 256, not {entries}")
    spark = vectors.sparkSession
    finite = finite_vectors(vectors, key, vector, label)
    packing = packing_of(finite, scale, parts)
    first = finite.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).toArrow()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(packing.rows(batch.column("v")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), rows], names=["id", "label", "points"])

    tables = ScratchTables(spark)
    packed = T.StructType([*finite.schema.fields[:2], T.StructField("points", T.BinaryType())])
    state = tables.store(finite.mapInArrow(pack, packed))
    schema = T.StructType(
        [
            *state.schema.fields[:3],
            *[T.StructField(c, T.BinaryType()) for c in ("assigned", "near", "low", "reached")],
            T.StructField("error", T.LongType()),
        ]
    )
    k, width = first.num_rows, packing.width
    start = packing.points(packing.rows(first["v"].combine_chunks())) if k else np.zeros((0, width), np.int64)
    books = np.ascontiguousarray(start.reshape(k, parts, width).transpose(1, 0, 2))
    moves, b_old, b = np.zeros((parts, k)), None, min(k - 1, max(1, entries // 4))
    for done in range(rounds + 1 if k else 0):
        trainer = Trainer(books, moves, packing, b_old, b)
        state = tables.replace(state, state.mapInArrow(trainer.assign, schema))
        if done == rounds:
            break
        cells = state.select("points", "assigned", "reached").mapInArrow(trainer.sums, "cell int, value long")
        cells = cells.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        found = {r["cell"]: int(r["value"]) for r in cells.collect()}
        after = books.copy()
        for p in range(parts):
            for e in range(k):
                at = (p * k + e) * (width + 1)
                if n := found.get(at + width):
                    after[p, e] = [found.get(at + i, 0) // n for i in range(width)]
        if np.array_equal(after, books):
            break  # further rounds change nothing
        moves, books = root_up(squares(after, books)), after
        reached = [found.get(parts * k * (width + 1) + t, 0) for t in range(b + 2)]
        # The first round has no bounds yet to tell anything by.
        b_old, b = b, b if b_old is None else next_b(reached, k)
    if not k:
        codes = state.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        codes = state.select("id", "label", F.lower(F.hex("assigned")).alias("code"), "error")
    codes = materialise(codes, "codes")
    tables.drop()
    return codes, Codebooks(books)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the error of all rows of the same label (NULL is one)."""
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = materialise(sums.withColumnRenamed("label", "of"), "label_errors")
    if sums.count() <= LABELS:
        sums = F.broadcast(sums)
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
