"""Running totals in a large ordered group without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.session import materialise


# Rows that one task may order.
SMALL_ROWS = 1_000_000


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str], at_most: int | None = None
) -> DataFrame:
    """For rows unique in (group, order) add, for each column s of ``sums``,

    ``s_before`` (total of smaller rows of the group) and ``s_total`` (total of the group), and
    ``<order>_prev`` (the next smaller value of the group, NULL at its start).

    Few rows (``at_most`` if the caller knows a bound, else counted) take a plain window per group. More
    are spread by range, so that one large group spans many partitions.
    """
    if at_most is None:
        df = materialise(df, "totals")
        at_most = df.count()
    if at_most <= SMALL_ROWS:
        return _by_window(df, group, order, sums)
    return _by_range(df, group, order, sums, -(-at_most // max(1, SMALL_ROWS)))


def _by_window(df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str]) -> DataFrame:
    # As SQL text: one call instead of several per sum.
    part = "PARTITION BY " + ", ".join(f"`{g}`" for g in group)
    smaller = f"({part} ORDER BY `{order}` ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return df.selectExpr(
        "*",
        f"lag(`{order}`) OVER ({part} ORDER BY `{order}`) AS `{order}_prev`",
        *[f"coalesce(sum(`{s}`) OVER {smaller}, 0) AS `{s}_before`" for s in sums],
        *[f"sum(`{s}`) OVER ({part}) AS `{s}_total`" for s in sums],
    )


def _by_range(df: DataFrame, group: Sequence[str], order: str, sums: Sequence[str], ranges_wanted: int) -> DataFrame:
    """Per range and group one summary row is kept (at most ranges + groups rows), whose running total is
    added to the total inside the range."""
    ranged = df.repartitionByRange(max(2, ranges_wanted), *[quoted(g) for g in group], quoted(order))
    # Stored, so that every later use sees the same range numbers.
    ranged = materialise(ranged.withColumn("_range", F.spark_partition_id()), "ranges")

    keys = [*group, "_range"]
    per_range = ranged.groupBy(*[quoted(k) for k in keys]).agg(
        F.max(quoted(order)).alias("_last"), *[F.sum(quoted(s)).alias(s) for s in sums]
    )
    ranges = Window.partitionBy(*[quoted(g) for g in group])
    earlier = ranges.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[quoted(k) for k in keys],
        F.lag("_last").over(ranges.orderBy("_range")).alias("_last"),
        *[F.coalesce(F.sum(quoted(s)).over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *[F.sum(quoted(s)).over(ranges).alias(f"{s}_total") for s in sums],
    )

    inside = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(quoted(order))
    smaller = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "*",
        F.lag(quoted(order)).over(inside).alias("_prev"),
        *[F.coalesce(F.sum(quoted(s)).over(smaller), F.lit(0)).alias(f"_{s}_local") for s in sums],
    )
    # Equi-join on (group, range); the optimiser broadcasts the summary when its measured size allows.
    joined = local.join(offsets, keys)
    return joined.select(
        *[quoted(c) for c in df.columns],
        F.coalesce("_prev", "_last").alias(f"{order}_prev"),
        *[(quoted(f"_{s}_local") + quoted(f"_{s}_offset")).alias(f"{s}_before") for s in sums],
        *[quoted(f"{s}_total") for s in sums],
    )
