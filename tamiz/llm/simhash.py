"""SimHash near-duplicates found through vantage-point trees.

Equal fingerprints are one node. A tree over a bounded sample of them cuts the space into shards by Hamming
distance from vantage points; a fingerprint near a boundary belongs to both sides, so that every pair within the
radius meets in a shard. A shard goes on cutting itself in the same way down to small sets that are compared
directly. It returns spanning links, not pairs; their components are the groups.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, row_hash, unused, utf8
from tamiz.llm.components import components
from tamiz.session import materialise

SEED = 42
# Fingerprints of the sample that shapes the shards, aimed at in a shard, taken at most by a task, compared directly.
SAMPLE, SHARD, TASK, DIRECT = 1 << 14, 1 << 14, 1 << 17, 256
# A cut is used if both sides together are at most so many times the set.
GROWTH = 1.4


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash over shingles of words (between ASCII white space, A-Z lower-cased), repeats included."""
    words = [] if text is None else text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *[e + 1 for e in ends]]
    digest = xxhash.xxh64_digest
    ones, n = np.zeros(64, dtype=np.int64), len(words) - shingle + 1
    for low in range(0, n, 1 << 16):  # very long texts piece by piece
        part = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[low : low + (1 << 16)], ends[low + shingle - 1 :], strict=False)])
        bits = np.unpackbits(np.frombuffer(part, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_fingerprint(docs: DataFrame, text: str, shingle: int, name: str) -> DataFrame:
    def make():
        def step(texts: pa.Array) -> list[int]:
            return [signed(fingerprint(t, shingle)) for t in utf8(texts)]

        return step

    return append(docs, [text], make, "long", name)


def distances(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def cut_point(points: np.ndarray, radius: int, tries: int = 4) -> tuple[np.uint64, int] | None:
    """A vantage point and the median distance from it, as a cut; None if no cut of ``tries`` pays.

    Pairs within ``radius`` differ by that much in their distance to the vantage point: the inner side reaches
    to the cut + radius - 1 and the outer begins at the cut, so a pair has both ends on one of them.
    """
    best = None
    for i in range(tries):
        vantage = points[(i * 2654435761 + 7) % len(points)]
        d = distances(points, vantage)
        cut = int(np.median(d))
        for at in (cut, cut + 1):
            inner, outer = int((d < at + radius).sum()), int((d >= at).sum())
            if max(inner, outer) < len(points) and inner + outer <= GROWTH * len(points):
                cost = inner + outer + 0.1 * max(inner, outer)
                if best is None or cost < best[0]:
                    best = cost, vantage, at
    return None if best is None else best[1:]


def build_tree(sample: np.ndarray, leaf: int, radius: int) -> list[tuple]:
    """Nodes (vantage, cut, inner node, outer node) and leaves (None, leaf number, 0, 0), the root first."""
    nodes: list[tuple] = []
    leaves = 0

    def grow(points: np.ndarray) -> int:
        nonlocal leaves
        me = len(nodes)
        nodes.append(())
        found = cut_point(points, radius) if len(points) > leaf else None
        if found is None:
            nodes[me] = (None, leaves, 0, 0)
            leaves += 1
        else:
            vantage, at = found
            d = distances(points, vantage)
            inner = grow(points[d < at + radius])
            nodes[me] = (vantage, at, inner, grow(points[d >= at]))
        return me

    grow(sample)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """(leaf, rows of ``points``) for each leaf that any of them reaches."""
    out, open_nodes = [], [(0, np.arange(len(points)))]
    while open_nodes:
        node, rows = open_nodes.pop()
        vantage, at, inner, outer = nodes[node]
        if vantage is None:
            out.append((at, rows))
            continue
        d = distances(points[rows], vantage)
        for child, mask in ((inner, d < at + radius), (outer, d >= at)):
            if mask.any():
                open_nodes.append((child, rows[mask]))
    return out


def near_pairs(points: np.ndarray, radius: int, found: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Calls ``found`` with the ends of all pairs within ``radius``, some more than once."""
    stack = [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        own = points[rows]
        cut = cut_point(own, radius) if len(rows) > DIRECT else None
        if cut is not None:
            d = distances(own, cut[0])
            stack += [rows[d < cut[1] + radius], rows[d >= cut[1]]]
            continue
        height = max(1, (1 << 20) // len(rows))
        for low in range(0, len(rows), height):
            block = own[low : low + height]
            a, b = np.nonzero(np.bitwise_count(block[:, None] ^ own[None, low:]) <= radius)
            keep = a < b
            if keep.any():
                found(rows[low + a[keep]], rows[low + b[keep]])


class Forest:
    """Roots of a growing set of links; keeps one link for each join of two sets."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            root = self.roots()
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.parent, np.maximum(x, y), np.minimum(x, y))


def spanning_links(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (point, smallest point of its group) among ``points``, for those that are not their own root."""
    points = np.unique(points)
    forest = Forest(len(points))
    near_pairs(points, radius, forest.link)
    root = forest.roots()
    rows = np.flatnonzero(root != np.arange(len(points)))
    return points[rows], points[root[rows]]


def similar_links(nodes: DataFrame, radius: int, sample: int = SAMPLE, shard: int = SHARD, task: int = TASK) -> DataFrame:
    """(a, b): links that span all groups of the distinct fingerprints ``nodes`` (fp long) within ``radius`` bits."""
    n = nodes.count()
    every = max(1, -(-n // sample))
    chosen = nodes.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).toPandas()["fp"].to_numpy(dtype=np.int64)
    tree = build_tree(np.unique(chosen.view(np.uint64)), max(1, shard // every), radius)

    def routed(blocks: dict[int, int] | None):
        """Rows (leaf, i, j, fp): with ``blocks``, a leaf of more rows than a task takes is dealt into blocks, and
        each pair of them is a task."""

        def run(batches):
            for batch in batches:
                points = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for leaf, rows in route(tree, points.view(np.uint64), radius):
                    own, b = points[rows], 1 if blocks is None else blocks.get(leaf, 1)
                    block = (own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(b)
                    for other in range(b):
                        mine = block != other if b > 1 else slice(None)
                        i, j = np.minimum(block[mine], other), np.maximum(block[mine], other)
                        leaves = np.full(len(i), leaf, dtype=np.int32)
                        columns = [leaves, i.astype(np.int32), j.astype(np.int32), own[mine]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["leaf", "i", "j", "fp"])

        return nodes.mapInArrow(run, "leaf int, i int, j int, fp long")

    sizes = {r["leaf"]: r["n"] for r in routed(None).groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    blocks = {leaf: -(-2 * size // task) for leaf, size in sizes.items() if size > task}

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        a, b = spanning_links(rows["fp"].to_numpy(dtype=np.int64).view(np.uint64), radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return routed(blocks).groupBy("leaf", "i", "j").applyInPandas(compare, "a long, b long")


def fingerprint_groups(prints: DataFrame, first: list[Column], radius: int) -> DataFrame:
    """(fp, first): the smallest struct of the columns ``first`` over all rows whose fingerprints are linked with fp
    (long)."""
    nodes = materialise(prints.groupBy("fp").agg(F.min(F.struct(*first)).alias("first")), "fingerprints")
    found = components(similar_links(nodes.select("fp"), radius))
    named = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("first"))
    return named.drop("first").join(smallest, "root").select("fp", "first")


def id_first() -> list[Column]:
    """Ids in order, NULL behind them."""
    return [F.col("id").isNull().alias("none"), F.col("id")]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """Per row of ``docs``: key, fingerprint (16 hexadecimal digits) and component_id, the smallest key reachable
    over links of at most ``radius`` differing bits.

    A text of fewer words than a shingle is one shingle; NULL and empty texts have the fingerprint zero, and link
    like any other. Rows with a NULL key link others, and name a component only if it has no other row (NULL).
    Repeated rows give repeated results; no rows, no results.
    """
    df = with_fingerprint(docs.select(quoted(key).cast("long").alias("id"), quoted(text).alias("text")), "text", shingle, "fp")
    prints = materialise(df.select("id", "fp"), "prints")
    groups = fingerprint_groups(prints, id_first(), radius)
    return prints.join(groups, "fp").select(
        F.col("id").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest key, NULL keys last; of
    rows that share it, the one with the smallest hash of all columns, once if rows are equal throughout."""
    print_name, hash_name = unused(docs.columns, "fp"), unused(docs.columns, "row_hash")
    hashed = docs.withColumn(hash_name, row_hash(docs))
    prints = with_fingerprint(
        hashed.select(quoted(key).cast("long").alias("id"), quoted(text).alias("text"), quoted(hash_name).alias("row_hash")),
        "text", shingle, print_name,
    )
    prints = materialise(prints.select("id", "row_hash", quoted(print_name).alias("fp")), "prints")
    groups = fingerprint_groups(prints, [*id_first(), F.col("row_hash")], radius)
    winners = groups.select(F.col("first.row_hash").alias("w_hash"), F.col("first.id").alias("w_id")).distinct()
    # Only the hash deals the rows out, so that the window below needs no other shuffle.
    own, won = F.col(f"d.`{key}`").cast("long"), F.col("w.w_id")
    equal = (own == won) | (own.isNull() & won.isNull())
    kept = hashed.alias("d").join(
        winners.alias("w"), (F.col(f"d.{hash_name}") == F.col("w.w_hash")) & equal, "left_semi"
    )
    number = unused(kept.columns, "number")
    same = Window.partitionBy(quoted(hash_name), quoted(key)).orderBy(F.lit(1))
    return kept.withColumn(number, F.row_number().over(same)).where(quoted(number) == 1).select(*[quoted(c) for c in docs.columns])
