"""The stored index of training points."""

import math

import numpy as np
import pytest

import tamiz.operators.cells as cells_module
import tamiz.operators.knn as knn_module
from tamiz.functions.distances import pair_distances, widened
from tamiz.operators.cells import NeighbourIndex, SearchLimits, blocks, build_index, grown, shelves, two_levels
from tamiz.operators.knn import KnnModel, search_table, training_table
from tamiz.plans.preparation import Preparation
from tamiz.plans.scoring import score_stored
from tamiz.sources.models import load_model, save_models, save_preparation
from tests.conftest import collected
from tests.test_knn import CELLS, LEVELS, brute, points

SCHEMA = "train_id long, features array<double>, label long"


def table_of(spark, train):
    return spark.createDataFrame(train, SCHEMA).repartition(3)


def neighbours(df):
    return {r["row_id"]: [(n["distance"], n["train_id"]) for n in r["neighbours"]] for r in df.collect()}


@pytest.mark.parametrize("limits", [CELLS, LEVELS], ids=["one_level", "two_levels"])
@pytest.mark.parametrize("width", [2, 40])
def test_a_loaded_index_finds_the_same(spark, tmp_path, limits, width):
    train = [(i, x, i % 3) for i, x in enumerate(points(1, 200, width, "clusters"))]
    queries = list(enumerate(points(2, 30, width, "clusters")))
    asked = spark.createDataFrame(queries, "row_id long, features array<double>")
    index = build_index(table_of(spark, train), 200, width, 4, 2, limits)
    index.save(f"{tmp_path}/index")
    loaded = NeighbourIndex.load(spark, f"{tmp_path}/index")
    for mine, other in ((index.cells.leaves, loaded.cells.leaves), (index.cells.tops, loaded.cells.tops)):
        for name in ("pivots", "counts", "radius", "kth", "low", "high"):
            assert np.array_equal(getattr(mine, name), getattr(other, name)), name
    assert np.array_equal(index.cells.starts, loaded.cells.starts)
    assert (len(index.cells.tops.pivots) < len(index.cells.leaves.pivots)) == (limits is LEVELS)
    assert neighbours(loaded.search(asked, 4, "row_id", limits)) == brute(train, queries, 4, 2)


def test_points_are_placed_and_summarised(spark):
    train = [(i, x, 0) for i, x in enumerate(points(3, 300, 3, "clusters"))]
    index = build_index(table_of(spark, train), 300, 3, 2, 1, LEVELS)
    cells, rows = index.cells, index.points.collect()
    assert len(rows) == 300 == cells.leaves.counts.sum() == cells.tops.counts.sum()
    for r in rows:
        x, c = np.array([r["features"]]), r["cell"]
        t = cells.top_of[c]
        own = slice(cells.starts[t], cells.starts[t + 1])
        assert pair_distances(x, cells.tops.pivots, 1).argmin() == t
        assert cells.starts[t] + pair_distances(x, cells.leaves.pivots[own], 1).argmin() == c
        for s, i in ((cells.leaves, c), (cells.tops, t)):
            d = pair_distances(x, s.pivots[i : i + 1], 1)[0, 0]
            assert s.radius[i, 0] - 1e-9 <= d <= s.radius[i, 1] + 1e-9
            assert (s.low[i] <= x[0]).all() and (x[0] <= s.high[i]).all()


def test_many_pivots_are_routed_by_few(spark):
    sample = np.random.default_rng(0).normal(size=(5000, 2))
    bare = two_levels(sample, 2, SearchLimits(flat_pivots=100))
    assert len(bare.tops.pivots) == 71 and len(bare.leaves.pivots) == 5000 and (np.diff(bare.starts) > 0).all()
    # A large table takes many cells of few rows instead of a fixed number of large ones.
    assert SearchLimits().max_pivots * SearchLimits().cell_rows > 10**8


def test_rows_are_sent_once_however_many_queries_there_are():
    counts = np.array([1000, 5, 100_000])
    limits = SearchLimits()
    for asked in (1, 10_000, 1_000_000):
        t, q = blocks(counts, np.full(3, asked), 4, limits)
        assert (q == 1).all() and t.tolist() == [1, 1, 4]
    assert blocks(counts, np.array([0, 3_000_000, 1]), 4, limits)[1].tolist() == [0, 3, 1]


@pytest.mark.parametrize("limits", [SearchLimits(), SearchLimits(direct_rows=0, block_train=512, block_queries=256)])
@pytest.mark.parametrize("cell_rows", [256, 16_384])
def test_copies_sent_and_work_of_a_task_stay_in_proportion(limits, cell_rows):
    cores, width, sent = 12, 64, []
    for n in (100_000, 600_000):
        queries, counts = n // 4, np.full(math.ceil(n / cell_rows), cell_rows)
        sized = grown(limits, n, queries, 0, 0.0, cores)
        starts = shelves(counts, sized.block_train)
        held = np.add.reduceat(counts, starts[:-1])
        asked = np.full(len(held), queries)  # unstructured: every query meets every shelf
        work = float((held * asked).sum()) * width
        t, q = blocks(held, asked, width, grown(limits, n, queries, queries, work, cores))
        sent.append((held * q).sum() + (asked * t).sum())
        assert (t * q).sum() >= 2 * cores
        terms = np.ceil(held / t) * np.ceil(asked / q) * width
        assert terms.max() <= max(work / cores, limits.block_work)
    assert sent[1] <= 8 * sent[0] and sent[0] < 20 * 100_000


def test_shelves_are_runs_of_cells_of_bounded_size():
    counts = np.array([3, 4, 0, 50, 1, 1, 8, 2])
    assert shelves(counts, 8).tolist() == [0, 3, 4, 6, 7, 8]
    assert shelves(counts, 1000).tolist() == [0, 8] and shelves(counts[:1], 1).tolist() == [0, 1]


@pytest.mark.parametrize("limits", [CELLS, LEVELS], ids=["one_level", "two_levels"])
@pytest.mark.parametrize("p", [1, 2])
def test_small_scales_exclude_as_many_cells(spark, limits, p):
    x, q = np.array(points(7, 300, 2, "clusters")), np.array(points(8, 50, 2, "clusters"))
    met = []
    for scale in (1.0, 2.0**-40):
        train = [(i, (row * scale).tolist(), 0) for i, row in enumerate(x)]
        cells = build_index(table_of(spark, train), 300, 2, 3, p, limits).cells
        home, reach = cells.home(q * scale, p)
        met.append(len(cells.others(q * scale, reach, home, p)[0]))
    assert met[0] == met[1] < 50 * len(cells.leaves.pivots) / 2
    assert widened(np.array([1e-12]))[0] < 1.001e-12


@pytest.mark.parametrize("limits", [CELLS, LEVELS], ids=["one_level", "two_levels"])
def test_a_search_sends_a_query_once_to_a_shelf(spark, monkeypatch, limits):
    x = points(9, 400, 20, "hot")
    train, queries = [(i, v, 0) for i, v in enumerate(x)], list(enumerate(points(10, 60, 20, "hot")))
    index, stored_first, write = build_index(table_of(spark, train), 400, 20, 4, 1, limits), [], cells_module.materialise

    def spy(df, name):
        out = write(df, name)
        if name == "first_round":
            stored_first.append(out)
        return out

    monkeypatch.setattr(cells_module, "materialise", spy)
    asked = spark.createDataFrame(queries, "row_id long, features array<double>")
    assert neighbours(index.search(asked, 4, "row_id", limits)) == brute(train, queries, 4, 1)
    shelves_asked = [r["shelves"] for r in stored_first[0].collect()]
    assert all(len(set(s)) == len(s) for s in shelves_asked)
    # Shelves hold at least as many rows as are worth a block, here several cells.
    assert max(map(len, shelves_asked)) < len(index.cells.leaves.pivots)


def stored(spark, folder, limits):
    train = spark.createDataFrame([(i, float(x[0]), float(x[1]), i % 3) for i, x in enumerate(points(5, 240, 2, "clusters"))],
                                  "row_id long, x double, y double, `__target__` long")
    labels = {"a": 0, "b": 1, "c": 2}
    known = training_table(train, ["x", "y"], "row_id")
    table = search_table(known, 5, limits)
    models = {f"{k}{p}": KnnModel(known, ("x", "y"), labels, k, "distance", p, limits, table) for k in (1, 5) for p in (1, 2)}
    save_preparation(spark, Preparation(("x", "y"), (), labels, "row_id"), folder)
    save_models(spark, models, "52", folder)
    return models


@pytest.mark.parametrize("limits", [CELLS, SearchLimits()], ids=["index", "direct"])
def test_scoring_with_a_stored_model_builds_nothing(spark, tmp_path, monkeypatch, limits):
    models = stored(spark, f"{tmp_path}", limits)
    asked = spark.range(40).selectExpr("id AS row_id", "double(id) AS x", "double(id % 7) AS y")
    want = {name: collected(m.transform(asked, "row_id"), "row_id") for name, m in models.items()}

    def refuse(*_):
        raise AssertionError("built anew")

    written = []
    write = cells_module.materialise
    monkeypatch.setattr(knn_module, "build_index", refuse)
    monkeypatch.setattr(knn_module, "search_table", refuse)
    monkeypatch.setattr(cells_module, "materialise", lambda df, name: written.append(name) or write(df, name))
    sc, jobs = spark.sparkContext, []
    for turn, name in enumerate(("51", "52", "11", "12", "52")):
        sc.setJobGroup(f"{tmp_path}-{turn}", name)
        got = load_model(spark, f"{tmp_path}", name).transform(asked, "row_id")
        assert collected(got, "row_id") == want[name]
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"{tmp_path}-{turn}")))
    sc.setJobGroup("", "")
    assert "cells" not in written and jobs[1] == jobs[4]
    assert score_stored(spark, asked, f"{tmp_path}").predictions.count() == 40


def test_a_search_reads_only_the_cells_it_meets(spark, tmp_path):
    train = [(i, [float(i)], 0) for i in range(2000)]
    limits = SearchLimits(direct_rows=0, cell_rows=20)
    index = build_index(table_of(spark, train), 2000, 1, 3, 2, limits)
    index.save(f"{tmp_path}/index")
    loaded = NeighbourIndex.load(spark, f"{tmp_path}/index")
    asked = spark.createDataFrame([(1, [700.2])], "row_id long, features array<double>")
    plans = []
    where = type(loaded.points).where

    def spy(df, condition):
        out = where(df, condition)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    type(loaded.points).where = spy
    try:
        found = neighbours(loaded.search(asked, 3, "row_id", limits))
    finally:
        type(loaded.points).where = where
    assert found == brute(train, [(1, [700.2])], 3, 2)
    assert any("PushedFilters: [IsNotNull(cell), GreaterThanOrEqual(cell," in p for p in plans)
