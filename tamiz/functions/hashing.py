"""Reproducible pseudo-random order of rows from their key, equal for every partition layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted


def row_hash(key: str, seed: int) -> Column:
    """md5 of ``seed|key`` as hex text. The key must be an integer or a string, and unique."""
    return F.md5(F.concat(F.lit(f"{seed}|"), quoted(key).cast("string")).cast("binary"))


def hash_fraction_below(hashed: Column, fraction: float) -> Column:
    """True for about ``fraction`` of all hashes: compares the first 8 hex digits."""
    if fraction >= 1.0:
        return F.lit(True)
    bound = int(round(fraction * 16**8))
    return F.substring(hashed, 1, 8) < F.lit(f"{bound:08x}")
