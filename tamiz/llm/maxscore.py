"""Exact top-k search by inner product with MaxScore over sharded postings.

Vectors become integer term weights. A dimension is a term and its postings are the rows by weight; a query term has
a bound, the most that any posting of the shard can add to a score. Terms are ordered by bound. The non-essential
ones are the longest tail whose bounds together stay below the k-th best score so far: no row is found through them
alone. Postings of the essential terms are traversed, stage by stage; the other terms are probed one by one, only
for rows that stay competitive. Every shard of rows answers all queries, which stream past it; the best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append
from tamiz.session import materialise

# Rows of a shard, and of a stage of its traversal.
SHARD_ROWS, STAGE_ROWS = 1 << 14, 1 << 11
EXACT = 1 << 53


class Postings:
    """The rows of a shard: ids and, for each dimension, the weights of all rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.largest = int(np.abs(weights).max(initial=0))
        # Doubles add integers exactly below 2^53, and fast.
        self.exact = self.largest**2 * max(1, weights.shape[1]) < EXACT
        self.weights = np.ascontiguousarray(weights.T, dtype=np.float64 if self.exact else np.int64)
        self.highest, self.lowest = self.weights.max(axis=1, initial=0), self.weights.min(axis=1, initial=0)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best rows but row ``own``, ties to smaller ids."""
        terms = self.weights.shape[0]
        fits = int(np.abs(query).max(initial=0)) * max(self.largest, 1) * max(1, terms) < EXACT
        weights = self.weights if fits or not self.exact else self.weights.astype(np.int64)
        query = np.resize(np.append(query, np.zeros(max(0, terms - len(query)))), terms).astype(weights.dtype)
        bounds = np.maximum(query * self.highest.astype(weights.dtype), query * self.lowest.astype(weights.dtype))
        order = np.argsort(-bounds, kind="stable")
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # rest[j]: what the terms from the j-th on can add
        bar, best, scores = None, np.zeros(0, np.int64), np.zeros(0, weights.dtype)
        for low in range(0, len(self.ids), STAGE_ROWS):
            high = min(low + STAGE_ROWS, len(self.ids))
            essential = terms if bar is None else min(terms, int(np.count_nonzero(rest >= bar)))
            head = query
            if essential < terms:
                head = np.zeros_like(query)
                head[order[:essential]] = query[order[:essential]]
            partial = head @ weights[:, low:high]
            if bar is None:
                at = np.arange(high - low)
            else:
                at = np.flatnonzero(partial + rest[essential] >= bar)
            partial = partial[at]
            at = at + low
            for j in range(essential, terms):
                if not len(at):
                    break
                partial = partial + query[order[j]] * weights[order[j], at]
                live = partial + rest[j + 1] >= bar
                at, partial = at[live], partial[live]
            other = self.rows[at] != own
            best, scores = np.concatenate([best, at[other]]), np.concatenate([scores, partial[other]])
            if len(best) > k:
                first = np.lexsort((self.ids[best], -scores))[:k]
                best, scores = best[first], scores[first]
            if len(best) == k:
                bar = scores.min()
        return best, scores.astype(np.int64)


def integer_weights(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(row, id, weights): floor(scale * component) of each vector as packed 64-bit integers. Rows without id or
    vector, or with a component that is NULL or not finite, are left out."""
    x = F.col("v")

    def bad(c: Column) -> Column:
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    df = vectors.select(quoted(key).cast("long").alias("id"), quoted(vector).cast("array<double>").alias("v"))
    df = df.where(F.col("id").isNotNull() & x.isNotNull()).where(~F.exists(x, bad))
    longest, largest = df.agg(F.max(F.size(x)), F.max(F.array_max(F.transform(x, F.abs)))).first()
    weight = (largest or 0.0) * abs(scale) + 1
    if not weight < 2.0**32 or not (longest or 0) * weight * weight < 2.0**63:
        raise ValueError(f"scores do not fit 63 bits: {longest} components of up to {weight:.6g}")

    def make():
        def step(column: pa.Array) -> list[bytes]:
            parts = column.flatten().to_numpy(zero_copy_only=False)
            packed = np.floor(parts * scale).astype("<i8").tobytes()
            ends = np.concatenate([[0], np.cumsum(np.diff(column.offsets.to_numpy()))]) * 8
            return [packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

        return step

    return append(df, ["v"], make, "binary", "weights").select(
        F.monotonically_increasing_id().alias("row"), "id", "weights"
    )


def _matrix(packed: list[bytes]) -> np.ndarray:
    width = max(map(len, packed), default=0)
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in packed), "<i8").reshape(len(packed), -1)


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 64,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score): for each row of ``vectors`` where ``queries`` (a condition on ``key``) holds, the k
    other rows of the highest integer inner product, ties to the smaller id.

    Rows without id or vector, or with a component that is NULL or not finite, take no part. Vectors of unequal
    lengths count as zero beyond their end. Repeated rows are rows of their own: each is found by the others, and
    each asks. Weights whose scores might not fit 63 bits stop the job.
    """
    ids = materialise(integer_weights(vectors, key, vector, scale), "weights")
    n = max(1, -(-ids.count() // shard_rows))
    # A shard's rows come first, then all queries.
    rows = ids.select(F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias("shard"), F.lit(False).alias("asks"), "*")
    asked = ids.withColumnRenamed("id", key).where(queries).withColumnRenamed(key, "id")
    asked = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("shard"), F.lit(True).alias("asks"), "*")
    streams = rows.unionByName(asked).repartitionById(n, "shard").sortWithinPartitions("shard", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, postings = None, [], None
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, held, postings = row["shard"], [], None
                if not row["asks"]:
                    held.append(row)
                    continue
                if postings is None:
                    numbers = np.array([[r["id"], r["row"]] for r in held], dtype=np.int64).reshape(-1, 2)
                    postings = Postings(numbers[:, 0], numbers[:, 1], _matrix([r["weights"] for r in held]))
                    held = []
                at, scores = postings.search(np.frombuffer(row["weights"], "<i8"), row["row"], k)
                out += [
                    (row["row"], row["id"], i, s)
                    for i, s in zip(postings.ids[at].tolist(), scores.tolist(), strict=True)
                ]
            if out:
                columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "query_id", "id", "score"])

    found = streams.mapInArrow(run, "row long, query_id long, id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
