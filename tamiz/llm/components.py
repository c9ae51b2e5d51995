"""Connected components of a large link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a long, b long), root the smallest node of its component.

    Each round turns every node's larger neighbours towards its smallest neighbour, then its smaller ones
    (large and small star); the rounds end when the links are stars. Links never leave the executors; each
    round is stored. NULL ends and links of a node to itself are left out.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    before = None
    while True:
        stars = materialise(_small_star(_large_star(links)), "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, links = state, stars
    found = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return found.unionByName(roots)


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    turned = pairs.where("v > u").join(_smallest(pairs), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return turned.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have a > b."""
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    lowest = _smallest(pairs)
    turned = pairs.join(lowest, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(own).where("a <> b").distinct()
