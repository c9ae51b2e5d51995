import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamiz.functions.columns import feature_array
from tamiz.functions.distances import by_ring, nearest_by_ring, nearest_in_block, significant
from tamiz.operators.knn import (
    KnnModel,
    SearchLimits,
    distinct_points,
    nearest_neighbours,
    shares,
    training_table,
    votes,
    winner,
)
from tests.conftest import collected

DIRECT = SearchLimits()
# Forces the partitioned form, with several cells and several blocks per cell.
CELLS = SearchLimits(direct_rows=0, cell_rows=40, wide_cell_rows=40, block_train=16, block_queries=8)
# Pivots on two levels.
LEVELS = SearchLimits(direct_rows=0, cell_rows=4, wide_cell_rows=4, flat_pivots=10, block_train=16, block_queries=8)
ONE_CELL = SearchLimits(direct_rows=0, cell_rows=10**6, wide_cell_rows=10**6, block_train=50)


def brute(train, queries, k, p):
    """{query key: [(distance, id)]} by definition."""
    out = {}
    for key, q in queries:
        d = []
        for i, t, _ in train:
            step = np.abs(np.array(q) - np.array(t))
            d.append((float(significant(np.array([step.sum() if p == 1 else np.sqrt((step**2).sum())]))[0]), i))
        out[key] = sorted(d)[:k]
    return out


def search(spark, train, queries, k, p, limits):
    t = spark.createDataFrame(train, "train_id long, features array<double>, label long").repartition(3)
    q = spark.createDataFrame(queries, "row_id long, features array<double>").repartition(2)
    rows = nearest_neighbours(t, q, k, p, "row_id", limits).collect()
    assert len(rows) == len(queries)
    return {r["row_id"]: [(n["distance"], n["train_id"]) for n in r["neighbours"]] for r in rows}


def points(seed, n, width, kind):
    rng = np.random.default_rng(seed)
    if kind == "grid":
        x = rng.integers(0, 6, (n, width)).astype(float)
    elif kind == "hot":
        x = rng.normal(size=(n, width))
        x[: n // 3] = x[0]
    else:
        x = np.concatenate([rng.normal(size=(n // 2, width)), 50 + 3 * rng.normal(size=(n - n // 2, width))])
    return [row.tolist() for row in x]


@pytest.mark.parametrize("limits", [DIRECT, CELLS, LEVELS, ONE_CELL], ids=["direct", "cells", "levels", "one_cell"])
@pytest.mark.parametrize("kind, width", [("grid", 2), ("hot", 3), ("clusters", 12)])
@pytest.mark.parametrize("p", [1, 2])
def test_search_equals_brute_force(spark, limits, kind, width, p):
    train = [(1000 - i, x, i % 3) for i, x in enumerate(points(1, 240, width, kind))]
    queries = list(enumerate(points(2, 40, width, kind) + [train[0][1]]))
    assert search(spark, train, queries, 5, p, limits) == brute(train, queries, 5, p)


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_block_search_equals_brute_force(data):
    width = data.draw(st.integers(1, 10))
    cell = st.one_of(st.integers(-3, 3).map(float), st.floats(-1e3, 1e3, allow_nan=False, width=32))
    vectors = st.lists(cell, min_size=width, max_size=width)
    train = data.draw(st.lists(vectors, min_size=1, max_size=30))
    queries = data.draw(st.lists(vectors, min_size=1, max_size=6))
    k, p = data.draw(st.integers(1, 7)), data.draw(st.sampled_from([1, 2]))
    ids = np.arange(len(train))[::-1] + 5
    q, t, d = nearest_in_block(np.array(queries), np.array(train), ids, k, p)
    for i, query in enumerate(queries):
        step = np.array(query) - np.array(train)
        exact = significant(np.abs(step).sum(axis=1) if p == 1 else np.sqrt((step**2).sum(axis=1)))
        expected = sorted(zip(exact, ids))[:k]
        assert [(a, ids[b]) for a, b in zip(d[q == i], t[q == i])] == expected


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-12, 0.0), (1e-3, 1e9), (1e60, 0.0)])
def test_rough_distances_decide_nothing(p, scale, offset):
    x = np.array(points(11, 900, 40, "hot"))
    t, ids = x[:800] * scale + offset, np.arange(800)[::-1].copy()
    q = np.concatenate([x[800:] * scale + offset, t[:30]])
    d = np.stack([significant(np.abs(t - a).sum(axis=1) if p == 1 else np.sqrt(np.square(t - a).sum(axis=1))) for a in q])
    want = [sorted(zip(row, ids))[:5] for row in d]
    for reach in (None, np.array([w[-1][0] for w in want])):
        i, j, near = nearest_in_block(q, t, ids, 5, p, reach)
        assert [list(zip(near[i == n], ids[j[i == n]])) for n in range(len(q))] == want


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("kind, width", [("grid", 2), ("hot", 1), ("clusters", 3)])
def test_ring_search_equals_block_search(kind, width, p):
    t, q = np.array(points(3, 5000, width, kind)), np.array(points(4, 300, width, kind))
    ids = np.arange(len(t))[::-1].copy()
    order, r = by_ring(t, t.mean(axis=0), p)
    for reach in (None, np.full(len(q), 1e9)):
        i, j, d = nearest_by_ring(q, t[order], r, ids[order], t.mean(axis=0), 5, p, reach)
        a, b, c = nearest_in_block(q, t, ids, 5, p)
        assert (i == a).all() and (ids[order][j] == ids[b]).all() and (d == c).all()


def test_more_neighbours_than_rows_is_an_error(spark):
    with pytest.raises(ValueError, match="training rows"):
        search(spark, [(1, [0.0], 0)], [(1, [0.0])], 2, 2, DIRECT)
    with pytest.raises(ValueError, match="p is 1"):
        search(spark, [(1, [0.0], 0)], [(1, [0.0])], 1, 3, DIRECT)


@pytest.mark.parametrize("limits", [DIRECT, CELLS])
def test_missing_features_stop_the_job(spark, limits):
    t = spark.createDataFrame([(1, [0.0, None], 0), (2, [1.0, 2.0], 0)], "train_id long, features array<double>, label long")
    q = spark.createDataFrame([(1, [0.0, 0.0])], "row_id long, features array<double>")
    with pytest.raises(Exception, match="without missing"):
        nearest_neighbours(t, q, 1, 2, "row_id", limits).collect()


@pytest.mark.parametrize("limits", [DIRECT, CELLS])
def test_no_queries(spark, limits):
    train = [(i, [float(i)], 0) for i in range(100)]
    t = spark.createDataFrame(train, "train_id long, features array<double>, label long")
    q = spark.createDataFrame([], "row_id long, features array<double>")
    assert nearest_neighbours(t, q, 3, 2, "row_id", limits).count() == 0


def test_copies_of_a_point_are_cut_to_k(spark):
    t = spark.range(0, 1000, 1, 8).selectExpr("id as train_id", "array(if(id % 3 = 0, 0d, double(id))) as features", "0L as label")
    kept = distinct_points(t, 2)
    assert collected(kept.where("features[0] = 0").select("train_id"), "train_id") == [(0,), (3,)]
    assert kept.count() == 2 + sum(1 for i in range(1000) if i % 3)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def one_vote(spark, neighbours, k, weights, classes=(0, 1, 2)):
    df = spark.createDataFrame(
        [(1, neighbours)], "row_id long, neighbours array<struct<distance double, train_id long, label long>>"
    )
    v = votes("neighbours", classes, k, weights)
    return df.select(winner(v, classes), shares(v)).first()


def test_uniform_vote_and_tie(spark):
    near = [(1.0, 1, 2), (2.0, 2, 1), (3.0, 3, 1)]
    assert one_vote(spark, near, 3, "uniform")[0] == 1
    assert one_vote(spark, near, 1, "uniform")[0] == 2
    # One vote each: the smaller class id.
    assert tuple(one_vote(spark, near, 2, "uniform")) == (1, [0.0, 0.5, 0.5])


def test_distance_vote_and_zero_distance(spark):
    near = [(0.5, 1, 2), (1.0, 2, 1), (1.0, 3, 1)]
    assert tuple(one_vote(spark, near, 3, "distance")) == (1, [0.0, 0.5, 0.5])
    hit = [(0.0, 1, 2), (0.0, 2, 0), (0.1, 3, 1)]
    assert tuple(one_vote(spark, hit, 3, "distance")) == (0, [0.5, 0.0, 0.5])
    with pytest.raises(ValueError, match="unknown weights"):
        one_vote(spark, near, 3, "gravity")


def test_direct_search_does_not_shuffle_queries(spark):
    train = spark.createDataFrame([(i, float(i), i % 2) for i in range(50)], "row_id long, x double, `__target__` long")
    model = KnnModel(training_table(train, ["x"], "row_id"), ("x",), {"a": 0, "b": 1}, 3)
    scored = model.transform(spark.range(20).selectExpr("id as row_id", "double(id) + 0.1 as x", "'kept' as note"), "row_id")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan
    assert scored.columns == ["row_id", "x", "note", "predicted_value", "probabilities"]
    assert scored.where("note = 'kept'").count() == 20


def test_layout_does_not_matter(spark):
    train = [(i, x, i % 4) for i, x in enumerate(points(5, 120, 2, "grid"))]
    got = []
    for partitions in (1, 4, 17):
        t = spark.createDataFrame(train, "train_id long, features array<double>, label long").repartition(partitions)
        q = spark.range(30).select(F.col("id").alias("row_id"), feature_array(["id", "id"]).alias("features"))
        near = nearest_neighbours(t, q.repartition(partitions), 4, 1, "row_id", CELLS)
        got.append(collected(near, "row_id"))
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_a_vote_computes_nothing_again_for_each_class(spark, weights):
    classes = list(range(6))
    vote = winner(votes("neighbours", classes, 5, weights), classes)
    # Once as the neighbours that vote, once for the nearest of them.
    assert vote._jc.toString().count("slice(") <= 2
    lists = spark.createDataFrame(
        [(1, [(2.0, 7, 4), (2.0, 8, 1), (4.0, 9, 1)]), (2, [(0.0, 7, 5), (1.0, 8, 1), (1.0, 9, 1)]), (3, None)],
        "id int, neighbours array<struct<distance double, train_id long, label long>>",
    )
    got = collected(lists.select("id", vote.alias("v"), shares(votes("neighbours", classes, 1, weights)).alias("s")), "id")
    assert [r[1] for r in got] == [1, 1 if weights == "uniform" else 5, None]
    assert got[0][2] == [0.0, 0.0, 0.0, 0.0, 1.0, 0.0] and got[2][2] == [None] * 6
