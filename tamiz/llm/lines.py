"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of line hashes, each with the number of documents that hold the line and the largest of their ids,
dealt into buckets and sorted inside each. Documents come in batches, from the largest ids down. A batch counts its
own lines, drops by merge-anti-joins those that some run already knows to stand in enough documents, and adds the
rest as a run of level 0. A level holds one run: two runs of a level are merged into one of the next. Runs are bucketed
alike, so neither the anti-joins nor the merges shuffle or sort a run.

Lines are told apart by 128 bits: two hashes of 64 bits, the second seeded by the first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import ScratchTables, append, unused
from tamiz.session import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \t\n\x0b\x0c\r"
# Batches of a table, and the most lines that are sent to all executors (24 bytes each).
BATCHES, HOT_LINES = 8, 80_000
HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.xxhash64(key), F.lit("line"), key).alias("h2"))


class LineRuns:
    """Levelled runs (h1, h2, n, top). ``n`` is exact up to ``min_docs``; beyond it a line that is hot in no batch may
    count fewer documents than it has."""

    def __init__(self, spark: SparkSession, min_docs: int, buckets: int | None = None) -> None:
        self.spark, self.min_docs = spark, min_docs
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.tables = ScratchTables(spark)
        self.levels: dict[int, DataFrame] = {}

    def _store(self, run: DataFrame) -> DataFrame:
        return self.tables.store(run.sortWithinPartitions(*HASHES), self.buckets, HASHES)

    def add(self, entries: DataFrame, hot: int) -> None:
        """Adds the batch ``entries`` (h1, h2, doc), of smaller documents than all before. Lines of ``hot`` documents or
        more are added even if known."""
        distinct = entries.select(*HASHES, "doc").distinct()
        # NULL ids are one document, below all others.
        run = distinct.groupBy(*HASHES).agg(F.count("*").alias("n"), F.max("doc").alias("top"))
        run = run.repartition(self.buckets, *HASHES)
        for level in self.levels.values():
            known = level.where(F.col("n") >= self.min_docs).alias("k").hint("merge")
            same = [F.col(f"r.{h}") == F.col(f"k.{h}") for h in HASHES]
            run = run.alias("r").join(known, [*same, F.col("r.n") < hot], "left_anti")
        self._settle(self._store(run), 0)

    def _settle(self, run: DataFrame, level: int) -> None:
        while level in self.levels:
            other = self.levels.pop(level)
            merged = self._store(merged_runs(other, run))
            self.tables.remove(other)
            self.tables.remove(run)
            run, level = merged, level + 1
        self.levels[level] = run

    def repeated(self) -> DataFrame:
        """(h1, h2, n, top) of the lines of at least ``min_docs`` documents; all runs become one."""
        while len(self.levels) > 1:
            low, high = sorted(self.levels)[:2]
            # The lower run counts as one of the level above.
            self._settle(self.levels.pop(low), high)
        if not self.levels:
            return self.spark.createDataFrame([], "h1 long, h2 long, n long, top long")
        return next(iter(self.levels.values())).where(F.col("n") >= self.min_docs)

    def drop(self) -> None:
        self.tables.drop()


def merged_runs(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.alias("a").hint("merge"), right.alias("b").hint("merge")
    both = a.join(b, [F.col(f"a.{h}") == F.col(f"b.{h}") for h in HASHES], "full_outer")
    return both.select(
        *[F.coalesce(f"a.{h}", f"b.{h}").alias(h) for h in HASHES],
        (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
        F.greatest("a.top", "b.top").alias("top"),
    )


def line_entries(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(doc, h1, h2): the lines of at least ``min_chars`` code points, once per row."""
    keys = F.transform(text_lines(quoted(text)), line_key)
    long = F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))
    df = docs.select(quoted(key).cast("long").alias("doc"), F.explode(long).alias("k"))
    return df.select("doc", line_hash(F.col("k")).alias("h")).select("doc", "h.*")


def lost_lines(
    docs: DataFrame, key: str, text: str, min_chars: int, min_docs: int, batches: int, buckets: int | None
) -> DataFrame:
    """(doc, lost): for each document that loses lines the hashes of those lines."""
    entries = line_entries(docs, key, text, min_chars)
    cuts = docs.agg(F.percentile_approx(quoted(key).cast("long"), [i / batches for i in range(1, batches)])).first()[0]
    batch = F.lit(batches)  # NULL ids come last
    for i, cut in enumerate(cuts or []):
        batch = F.when(F.col("doc") > cut, batches - 1 - i).otherwise(batch)
    entries = materialise(entries.withColumn("batch", batch), "line_entries", partition_by="batch")
    sizes = {r["batch"]: r["count"] for r in entries.groupBy("batch").count().collect()}
    # Lines of so many documents or more are hot; as every entry counts once, there are at most HOT_LINES of them.
    hot = max(min_docs, -(-sum(sizes.values()) // HOT_LINES))

    runs = LineRuns(docs.sparkSession, min_docs, buckets)
    for b in sorted(sizes):
        runs.add(entries.where(F.col("batch") == b).drop("batch"), hot)
    found = runs.repeated()
    # Hot lines are looked up where the entries lie. Any other line has fewer than ``hot`` documents in a batch.
    often, seldom = F.broadcast(found.where(F.col("n") >= hot)), found.where(F.col("n") < hot)
    rest = entries.join(F.broadcast(found.where(F.col("n") >= hot).select(*HASHES)), HASHES, "left_anti")
    decided = [e.join(f, HASHES).where("doc IS NULL OR doc < top").select("doc", *HASHES) for e, f in ((entries, often), (rest, seldom))]
    lost = decided[0].unionByName(decided[1]).groupBy("doc").agg(F.collect_set(F.struct(*HASHES)).alias("lost"))
    lost = materialise(lost, "lost_lines")
    runs.drop()
    return lost


def drop_repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = BATCHES,
    buckets: int | None = None,
) -> tuple[DataFrame, str]:
    """``docs`` with a column more, and its name: a struct of n_lines, n_dropped and kept, the text without the lines
    that stand in ``min_docs`` documents or more and, as the same line, in one of a larger id.

    Lines end at a newline; they are the same if equal without white space at both ends and with A-Z lower-cased. Lines
    of fewer than ``min_chars`` code points then always stay. A NULL or empty text is one empty line. Rows that share an
    id are one document, as are the rows without id, which count as the smallest; a line that repeats in one document
    stays or goes there as often as it stands. No rows, no results.
    """
    lost = lost_lines(docs, key, text, min_chars, min_docs, batches, buckets)
    doc, gone, hashes, made = (unused(docs.columns, n) for n in ("doc", "lost", "hashes", "lines"))
    lost = lost.select(F.col("doc").alias(doc), F.col("lost").alias(gone))
    joined = docs.join(lost, quoted(key).cast("long").eqNullSafe(lost[doc]), "left").drop(doc)
    # Only texts that lose lines are hashed again.
    each = F.when(quoted(gone).isNotNull(), F.transform(text_lines(quoted(text)), lambda x: line_hash(line_key(x))))
    result = "struct<n_lines: bigint, n_dropped: bigint, kept: string>"
    return append(joined.withColumn(hashes, each), [text, hashes, gone], _kept_lines, result, made).drop(gone, hashes), made


def _kept_lines():
    def pairs(column: pa.Array) -> np.ndarray:
        """Both hashes of the flat structs of a list column, as one value of 16 bytes."""
        flat = column.flatten()
        both = np.stack([flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2)], axis=1)
        return np.ascontiguousarray(both).view("V16").ravel()

    def step(texts: pa.Array, hashes: pa.Array, lost: pa.Array) -> list[dict]:
        own, gone = pairs(hashes), pairs(lost)
        out, a, b = [], 0, 0
        sizes = [pc.fill_null(pc.list_value_length(c), 0).to_pylist() for c in (hashes, lost)]
        for line, n, m in zip(texts.to_pylist(), *sizes, strict=True):
            kept, lines = line or "", 1 + (line or "").count("\n")
            dropped = 0
            if m:
                known = set(gone[b : b + m].tolist())
                left = [x for x, h in zip(kept.split("\n"), own[a : a + n].tolist(), strict=True) if h not in known]
                kept, dropped = "\n".join(left), n - len(left)
            out.append({"n_lines": lines, "n_dropped": dropped, "kept": kept})
            a, b = a + n, b + m
        return out

    return step
