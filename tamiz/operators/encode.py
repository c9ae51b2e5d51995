"""Categories to integer codes in order of first appearance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.functions.labels import LITERAL_MAP_LIMIT, lookup
from tamiz.functions.running import running_totals
from tamiz.session import materialise

MISSING_CODE = -1
# Dictionary rows that may be sent to every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Factorizer:
    """``dictionary``: (feature, value, code). ``sizes``: rows per feature; ``volumes``: bytes of their values."""

    dictionary: DataFrame
    sizes: dict[str, int]
    volumes: dict[str, int]

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace categories by codes; missing and unseen ones become -1.

        Small dictionaries become literals, middling ones a broadcast join, larger ones a plain
        equi-join (adaptive execution splits the rows of a frequent value).
        """
        small = [c for c, n in self.sizes.items() if n <= LITERAL_MAP_LIMIT]
        codes: dict[str, dict[str, int]] = {c: {} for c in small}
        if small:
            for r in self.dictionary.where(F.col("feature").isin(small)).collect():
                codes[r["feature"]][r["value"]] = r["code"]
        out = df
        for feature, n in self.sizes.items():
            value = quoted(feature).cast("string")
            if feature in codes:
                code = lookup(value, codes[feature], "long")
                out = out.withColumn(feature, F.coalesce(code, F.lit(MISSING_CODE).cast("long")))
                continue
            table = self.dictionary.where(F.col("feature") == feature).select(
                F.col("value").alias("_value"), F.col("code").alias("_code")
            )
            if n <= BROADCAST_ROWS and self.volumes[feature] <= BROADCAST_BYTES:
                table = F.broadcast(table)
            out = (
                out.join(table, value == F.col("_value"), "left")
                .withColumn(feature, F.coalesce(F.col("_code"), F.lit(MISSING_CODE).cast("long")))
                .drop("_value", "_code")
            )
        return out.select(*[quoted(c) for c in df.columns])


def first_appearance_codes(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """(feature, value, code): distinct values numbered from 0 by the smallest key they occur with.

    Only the dictionary is ordered, spread over ranges of the first key; the rows are just aggregated.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), quoted(c).cast("string").alias("value")) for c in features]
    )
    first = (
        df.select(quoted(key).alias("_key"), F.explode(cells).alias("c"))
        .where(F.col("c.value").isNotNull())
        .groupBy("c.feature", "c.value")
        .agg(F.min("_key").alias("first_key"))
        .withColumn("one", F.lit(1).cast("long"))
    )
    ranked = running_totals(first, ["feature"], "first_key", ["one"])
    return ranked.select("feature", "value", F.col("one_before").alias("code"))


def fit_factorizer(df: DataFrame, features: Sequence[str], key: str) -> Factorizer:
    dictionary = materialise(first_appearance_codes(df, features, key), "dictionary")
    sizes, volumes = {c: 0 for c in features}, {c: 0 for c in features}
    measured = dictionary.groupBy("feature").agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("bytes"))
    for r in measured.collect():
        sizes[r["feature"]], volumes[r["feature"]] = r["n"], r["bytes"]
    return Factorizer(dictionary, sizes, volumes)
