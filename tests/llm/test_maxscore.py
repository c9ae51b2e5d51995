"""Top-k search against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import tamiz.llm.maxscore as maxscore
from tamiz.llm.maxscore import Postings, top_k

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k):
    usable = [
        (v, [math.floor(64 * x) for x in e])
        for v, e in rows
        if v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for i, (q, w) in enumerate(usable):
        if q % 20:
            continue
        scores = [(-sum(a * b for a, b in zip(w, o, strict=False)), c) for j, (c, o) in enumerate(usable) if j != i]
        out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def collection(seed, n=300, width=8):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-16, 16) / 16 for _ in range(width)]) for i in range(n)]
    rows += [(i, [0.5] * width) for i in range(1000, 1100)]  # one common vector
    rows += [(2000, None), (2020, [None] + [1.0] * (width - 1)), (2040, [float("nan")] * width), (2060, [float("inf")] * width)]
    return rows + [(None, [1.0] * width), (2080, []), (2100, [1.0, -1.0]), (-20, [0.0] * width)]


@pytest.mark.parametrize(("seed", "shard_rows"), [(1, 1 << 14), (2, 50)])
def test_equals_brute_force(spark, seed, shard_rows):
    rows = collection(seed)
    df = spark.createDataFrame([(*r, 1) for r in rows], VECTORS + ", shard int").repartition(3)
    found = top_k(df, F.col("vec_id") % 20 == 0, 20, shard_rows=shard_rows)
    assert sorted(map(tuple, found.collect())) == brute(rows, 20)


def test_fewer_rows_than_k_repeated_rows_and_none(spark):
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [0.5, 0.5])]
    df = spark.createDataFrame(rows, VECTORS)
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 20 == 0, 20).collect())) == brute(rows, 20)
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


@pytest.mark.parametrize("large", [False, True])
def test_stages_and_probes_lose_nothing(monkeypatch, large):
    monkeypatch.setattr(maxscore, "STAGE_ROWS", 32)
    rng = np.random.default_rng(5)
    weights = rng.integers(-9, 10, (700, 12)) * (1 << 24 if large else 1)
    weights[:, 6:] //= 8  # terms with small bounds are probed
    ids = rng.permutation(700)
    shard = Postings(ids, np.arange(700), weights)
    for own in range(0, 700, 50):
        at, scores = shard.search(weights[own], own, 5)
        full = weights @ weights[own]
        order = [i for i in np.lexsort((ids, -full)) if i != own][:5]
        assert sorted(at.tolist()) == sorted(order) and sorted(scores.tolist()) == sorted(full[order].tolist())


@pytest.mark.parametrize("x", [2e8, 1e300, -1e300])
def test_scores_that_do_not_fit_stop_the_job(spark, x):
    df = spark.createDataFrame([(20, [x, 1.0]), (21, [x, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="63 bits"):
        top_k(df, F.col("vec_id") % 20 == 0, 20)


def test_large_scores_that_fit_are_exact(spark):
    rows = [(20, [2.0**24, 1.0]), (21, [2.0**24, 3.0]), (22, [-(2.0**24), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, top_k(df, F.col("vec_id") % 20 == 0, 20).collect())) == brute(rows, 20)
