"""Distance blocks inside a task: NumPy on the Arrow batches that Spark hands over."""

from __future__ import annotations

import math
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa

# Distances are compared at this many significant digits, whatever their scale.
DIGITS = 12
# Distances held at a time, and those of a block that stay in a core's cache while features are added up.
TILE = 2_000_000
BLOCK = 262_144
# Vectors of more features are first compared roughly: by a matrix product, or in single precision.
ROUGH_FEATURES = 8
# Rows looked at first to bound a ring, and the most features for which that pays.
RING_LOOK = 512
RING_FEATURES = 16


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrow list column -> (rows, features)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty((0, 0))
    out = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    if not np.isfinite(out).all():
        raise ValueError("neighbour search needs features without missing or infinite values")
    return out


def pair_distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """All distances between the rows of two blocks, one feature at a time."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = np.subtract.outer(a[:, j], b[:, j])
        out += np.abs(step) if p == 1 else step * step
    return out if p == 1 else np.sqrt(out)


def nearest_pivot(points: np.ndarray, pivots: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the nearest pivot, distance to it) of each point."""
    cell, r = np.empty(len(points), dtype=np.int64), np.empty(len(points))
    step = max(1, TILE // len(pivots))
    for start in range(0, len(points), step):
        d = pair_distances(points[start : start + step], pivots, p)
        cell[start : start + step] = d.argmin(axis=1)
        r[start : start + step] = d.min(axis=1)
    return cell, r


def significant(x: np.ndarray) -> np.ndarray:
    """Rounded to DIGITS significant digits."""
    out = x.copy()
    part = (x > 1e-280) & (x < 1e280)
    scale = 10.0 ** (DIGITS - 1 - np.floor(np.log10(x[part])))
    out[part] = np.round(x[part] * scale) / scale
    return out


def _squared_by_product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared Euclidean distances through a matrix product, with a bound of their error."""
    na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    out = a @ b.T
    out *= -2.0
    out += na[:, None]
    out += nb[None, :]
    return out, 1e-12 * float(na.max() + nb.max())


def _in_single_precision(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Manhattan distances of single precision, with a bound of their error (infinite if they do not fit)."""
    centre = b[0]
    a, b = a - centre, b - centre
    largest = float(np.abs(a).sum(axis=1).max() + np.abs(b).sum(axis=1).max())
    if not 1e-20 < largest < 1e30:
        return np.zeros((len(a), len(b)), dtype=np.float32), math.inf
    left, right = (np.ascontiguousarray(x.T, dtype=np.float32) for x in (a, b))
    out, step = np.zeros((len(a), len(b)), dtype=np.float32), np.empty((len(a), len(b)), dtype=np.float32)
    for x, y in zip(left, right):
        np.subtract.outer(x, y, out=step)
        np.abs(step, out=step)
        out += step
    return out, 2.0**-22 * (len(left) + 2) * largest


def _close(q: np.ndarray, t: np.ndarray, k: int, p: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query position, row position): every row that could round to a distance within ``limit``, which shrinks in place
    to what k rows of this block lie within."""
    many = 4 * k * len(q)
    if q.shape[1] > ROUGH_FEATURES:
        if p == 2:
            near, error = _squared_by_product(q, t)

            def within() -> np.ndarray:
                return near <= (np.square(limit) + 2 * error)[:, None]

        else:
            near, error = _in_single_precision(q, t)

            def within() -> np.ndarray:
                return near <= np.minimum(limit + 2 * error, 1e38).astype(np.float32)[:, None]

        close = within()
        if math.isfinite(error) and np.count_nonzero(close) > many and len(t) >= k:
            kth = np.partition(near, k - 1, axis=1)[:, k - 1].astype(np.float64) + error
            np.minimum(limit, widened(np.sqrt(np.maximum(kth, 0.0)) if p == 2 else kth), out=limit)
            close = within()
        # Where values are large beside their differences, rough distances tell nothing.
        if np.count_nonzero(close) <= 4 * many:
            return np.nonzero(close)
    near = pair_distances(q, t, p)
    close = near <= limit[:, None]
    if np.count_nonzero(close) > many and len(t) >= k:
        np.minimum(limit, widened(np.partition(near, k - 1, axis=1)[:, k - 1]), out=limit)
        close = near <= limit[:, None]
    return np.nonzero(close)


def k_first(rows: np.ndarray, distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k nearest hits of each row, by row and rank; equal distances by id."""
    order = np.lexsort((ids, distance, rows))
    mine = rows[order]
    return order[np.arange(len(mine)) - np.searchsorted(mine, mine) < k]


def shrink(reach: np.ndarray, rows: np.ndarray, distance: np.ndarray, k: int) -> None:
    """Lower ``reach`` in place to the k-th distance of rows with k hits, which are ordered by row and rank."""
    full = np.flatnonzero(np.bincount(rows, minlength=len(reach)) >= k)
    reach[full] = np.minimum(reach[full], distance[np.searchsorted(rows, full) + k - 1])


def nearest_in_block(
    queries: np.ndarray, train: np.ndarray, ids: np.ndarray, k: int, p: int, reach: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query position, training position, rounded distance), the k nearest per query in rank order. With ``reach``
    farther rows may be left out."""
    parts = []
    k = min(k, len(train))
    for start in range(0, len(queries) if k else 0, 1024):
        q = queries[start : start + 1024]
        limit = np.full(len(q), np.inf) if reach is None else widened(reach[start : start + 1024])
        held, size = [], 0
        step = max(k, BLOCK // len(q))
        for low in range(0, len(train), step):
            t = train[low : low + step]
            rows, cols = _close(q, t, k, p, limit)
            if not len(rows):
                continue
            gap = q[rows] - t[cols]
            exact = np.abs(gap).sum(axis=1) if p == 1 else np.sqrt(np.square(gap).sum(axis=1))
            held.append((rows, cols + low, significant(exact)))
            size += len(rows)
            if size > 4 * k * len(q):
                held = [_merged(held, ids, k, limit)]
                size = len(held[0][0])
        if held:
            rows, cols, exact = _merged(held, ids, k, limit)
            parts.append((rows + start, cols, exact))
    if not parts:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*parts))


def _merged(held: list[tuple], ids: np.ndarray, k: int, limit: np.ndarray) -> tuple[np.ndarray, ...]:
    """The k nearest of the hits (query, row, distance) held so far; they lower the limit in place."""
    rows, cols, exact = (np.concatenate(x) for x in zip(*held))
    best = k_first(rows, exact, ids[cols], k)
    rows, cols, exact = rows[best], cols[best], exact[best]
    shrink(limit, rows, widened(exact), k)
    return rows, cols, exact


def ring_bound(to_pivot: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """[query, cell]: no row of a cell is nearer, by its smallest and largest distance to the pivot."""
    return np.maximum(radius[:, 0] - to_pivot, to_pivot - radius[:, 1])


def box_bound(queries: np.ndarray, low: np.ndarray, high: np.ndarray, p: int) -> np.ndarray:
    """[query, cell]: the distance to each bounding box; without boxes 0."""
    gap = np.zeros((len(queries), len(low)))
    for j in range(low.shape[1]):
        x = queries[:, j, None]
        outside = np.maximum(np.maximum(low[:, j] - x, x - high[:, j]), 0.0)
        gap += outside if p == 1 else outside * outside
    return gap if p == 1 else np.sqrt(gap)


@dataclass(frozen=True)
class Summary:
    """What is known of the rows of some cells, in arrays over the cells."""

    pivots: np.ndarray
    counts: np.ndarray
    radius: np.ndarray  # (cells, 2): smallest and largest distance to the pivot
    kth: np.ndarray  # distance to the pivot within which the cell holds k rows; inf if it has fewer
    low: np.ndarray  # (cells, features): bounding boxes, without columns if there are none
    high: np.ndarray

    def part(self, a: int, b: int) -> Summary:
        return Summary(*(getattr(self, f.name)[a:b] for f in fields(self)))

    def possible(self, queries: np.ndarray, reach: np.ndarray, p: int, to_home: np.ndarray) -> np.ndarray:
        """[query, cell]: whether the cell can hold a row within ``reach``. ``to_home``: how far a pivot is to which the
        rows of these cells would have gone if it were nearer; infinite if there is none."""
        to_pivot = pair_distances(queries, self.pivots, p)
        bound = np.maximum(ring_bound(to_pivot, self.radius), box_bound(queries, self.low, self.high, p))
        # A row of a cell is nearer to its own pivot than to the home pivot.
        np.maximum(bound, (to_pivot - to_home[:, None]) / 2, out=bound)
        # Differences of large distances are known to their last digits only.
        return (bound - 1e-12 * to_pivot <= widened(reach)[:, None]) & (self.counts > 0)


@dataclass(frozen=True)
class Cells:
    """Two levels: rows belong to the nearest pivot of ``tops``, and among the cells of that top to the nearest pivot
    of ``leaves``. Leaves are ordered by top: those of top t are ``starts[t]`` to ``starts[t + 1]``."""

    tops: Summary
    leaves: Summary
    starts: np.ndarray

    @property
    def top_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def place(self, points: np.ndarray, p: int) -> tuple[np.ndarray, ...]:
        """(cell, distance to its pivot, top, distance to its pivot) of each point."""
        top, r_top = nearest_pivot(points, self.tops.pivots, p)
        cell, r = np.empty(len(points), dtype=np.int64), np.empty(len(points))
        for t, rows in groups(top):
            a, b = self.starts[t], self.starts[t + 1]
            if b - a == 1:
                cell[rows] = a
                r[rows] = pair_distances(points[rows], self.leaves.pivots[a:b], p)[:, 0]
            else:
                near, r[rows] = nearest_pivot(points[rows], self.leaves.pivots[a:b], p)
                cell[rows] = a + near
        return cell, r, top, r_top

    def home(self, queries: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance within which the k nearest rows lie) of each query."""
        cell, _, top, _ = self.place(queries, p)
        reach = np.empty(len(queries))
        step = max(1, TILE // len(self.tops.pivots))
        for start in range(0, len(queries), step):
            d = pair_distances(queries[start : start + step], self.tops.pivots, p)
            # Some top holds k rows within this distance.
            reach[start : start + step] = (d + self.tops.kth).min(axis=1)
        for t, rows in groups(top):
            own = self.leaves.part(self.starts[t], self.starts[t + 1])
            if len(own.pivots) > 1:
                d = pair_distances(queries[rows], own.pivots, p)
                reach[rows] = np.minimum(reach[rows], (d + own.kth).min(axis=1))
        return cell, reach

    def others(
        self, queries: np.ndarray, reach: np.ndarray, homes: np.ndarray, p: int, low: int = 0, high: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(query position, cell) pairs outside the home cells that can hold a row within ``reach``, among the cells
        from ``low`` up to ``high``."""
        high = len(self.leaves.pivots) if high is None else high
        rows, cols = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        first, last = np.searchsorted(self.starts, [low, high - 1], side="right") - 1
        home_top = np.searchsorted(self.starts, homes, side="right") - 1
        to_leaf, to_top = _to_own(queries, self.leaves.pivots, homes, p), _to_own(queries, self.tops.pivots, home_top, p)
        step = max(1, TILE // (last + 1 - first))
        for start in range(0, len(queries), step):
            tile = slice(start, start + step)
            tops = self.tops.part(first, last + 1).possible(queries[tile], reach[tile], p, to_top[tile])
            if len(self.tops.pivots) == len(self.leaves.pivots):
                r, c = np.nonzero(tops)
                rows.append(r + start)
                cols.append(c + first)
                continue
            for t in (np.flatnonzero(tops.any(axis=0)) + first).tolist():
                a, b = max(low, int(self.starts[t])), min(high, int(self.starts[t + 1]))
                asking = np.flatnonzero(tops[:, t - first]) + start
                own = self.leaves.part(a, b)
                part = max(1, TILE // (b - a))
                for at in range(0, len(asking), part):
                    some = asking[at : at + part]
                    to_home = np.where(home_top[some] == t, to_leaf[some], np.inf)
                    r, c = np.nonzero(own.possible(queries[some], reach[some], p, to_home))
                    rows.append(some[r])
                    cols.append(c + a)
        rows, cols = np.concatenate(rows), np.concatenate(cols)
        away = cols != homes[rows]
        return rows[away], cols[away]


def _to_own(queries: np.ndarray, pivots: np.ndarray, own: np.ndarray, p: int) -> np.ndarray:
    """Distance of each query to the pivot named for it."""
    out = np.zeros(len(queries))
    for j in range(queries.shape[1]):
        gap = queries[:, j] - pivots[own, j]
        out += np.abs(gap) if p == 1 else gap * gap
    return out if p == 1 else np.sqrt(out)


def groups(of: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(value, positions) of each value."""
    order = np.argsort(of, kind="stable")
    values, first = np.unique(of[order], return_index=True)
    return list(zip(values.tolist(), np.split(order, first[1:]), strict=True)) if len(values) else []


def widened(reach: np.ndarray) -> np.ndarray:
    """A distance with slack for the rounding of all distances it is compared with. In proportion only: features may be
    of any scale."""
    return reach * (1 + 1e-9)


def by_ring(train: np.ndarray, pivot: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows by distance to the pivot, those distances)."""
    r = pair_distances(train, pivot[None, :], p)[:, 0]
    order = np.argsort(r, kind="stable")
    return order, r[order]


def nearest_by_ring(
    queries: np.ndarray,
    train: np.ndarray,
    r: np.ndarray,
    ids: np.ndarray,
    pivot: np.ndarray,
    k: int,
    p: int,
    reach: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``nearest_in_block`` for rows ordered by ``r``, their distance to the pivot.

    A row within some distance of a query lies in a ring around the pivot, which is a slice of the rows.
    The distance is ``reach``, or what the rows next to the query in this order show to be enough.
    """
    n, width = train.shape
    if len(queries) == 0 or n == 0:
        return nearest_in_block(queries, train[:0], ids[:0], k, p)
    reach = np.full(len(queries), np.inf) if reach is None else reach.copy()
    to_pivot = pair_distances(queries, pivot[None, :], p)[:, 0]
    order = np.argsort(to_pivot, kind="stable")
    # Rings of many features hold nearly all rows: a first look would be in vain.
    look = max(RING_LOOK, k) if width <= RING_FEATURES and n > 4 * max(RING_LOOK, k) else 0
    parts = []
    # Small groups of queries share a narrow ring; where rings do not pay, larger ones save steps.
    step = 64 if look else 1024
    for start in range(0, len(queries), step):
        tile = order[start : start + step]
        q = queries[tile]
        if look:
            a = int(np.clip(np.searchsorted(r, np.median(to_pivot[tile])) - look // 2, 0, n - look))
            near = pair_distances(q, train[a : a + look], p)
            reach[tile] = np.minimum(reach[tile], np.partition(near, k - 1, axis=1)[:, k - 1])
        span = widened(reach[tile]) + 1e-9 * np.abs(to_pivot[tile])
        a = np.searchsorted(r, (to_pivot[tile] - span).min(), side="left")
        b = np.searchsorted(r, (to_pivot[tile] + span).max(), side="right")
        i, t, d = nearest_in_block(q, train[a:b], ids[a:b], k, p, reach[tile])
        parts.append((tile[i], t + a, d))
    rows, cols, distance = (np.concatenate(x) for x in zip(*parts))
    # Back to query order; rank order within a query stays.
    back = np.argsort(rows, kind="stable")
    return rows[back], cols[back], distance[back]
