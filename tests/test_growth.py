"""Growth by histograms, against trees by definition."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import tamiz.operators.growth as growth
from tamiz.operators.growth import Bins, decide, fit_bins, impurity, inner_bounds
from tamiz.operators.sweep import TreeGrid, sweep_tree
from tamiz.operators.tree import fit_exact_tree, fit_trees
from tests.test_tree import gini_tree, shares_of

SCHEMA = "x double, y double, `__target__` long"


def points(n, seed, classes=3, values=None):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y = (rng.random(), rng.gauss(0, 1)) if values is None else (rng.randrange(values) / 7, rng.randrange(values) * 3.0)
        c = int(x * 2 + y > 1) + int(rng.random() < 0.3) + int(y > 0.4) * rng.randrange(2)
        out.append((x, y, (c + rng.randrange(2) * (rng.random() < 0.2)) % classes))
    return out


def balanced(data):
    classes = sorted({c for *_, c in data})
    return classes, {c: len(data) / (len(classes) * sum(k == c for *_, k in data)) for c in classes}


def same(tree, definition, data, asked, df):
    classes, weights = balanced(data)
    got = tree.transform(df(asked)).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r["probabilities"] == pytest.approx(shares_of(definition, (r["x"], r["y"]), weights, classes))


@pytest.fixture
def table(rows):
    return lambda data: rows(SCHEMA, data, 3)


@pytest.mark.parametrize(("bins", "values"), [(4, None), (16, None), (256, None), (4, 9), (5, 40)])
def test_exact_trees_do_not_depend_on_bins(table, bins, values):
    data = points(240, 1, values=values)
    trees = fit_trees(table(data), ["x", "y"], max_depth=4, leaf_sizes=(1, 2, 7), max_bins=bins)
    classes, weights = balanced(data)
    for m, tree in trees.items():
        definition = gini_tree(data, 4, m, weights, classes)
        same(tree, definition, data, data + [(x + 0.003, y - 0.01, c) for x, y, c in data], table)


@pytest.mark.parametrize("corners", [8, 1])
def test_many_classes_are_bounded_by_slope(table, monkeypatch, corners):
    monkeypatch.setattr(growth, "CORNER_CLASSES", corners)
    data = points(150, 2, classes=5)
    tree = fit_trees(table(data), ["x", "y"], max_depth=3, max_bins=5)[1]
    classes, weights = balanced(data)
    same(tree, gini_tree(data, 3, 1, weights, classes), data, data, table)


def binned_tree(data, depth, min_leaf, weights, classes, edges):
    """CART by definition that may only cut where an edge lies between."""

    def weight_of(part):
        return [sum(weights[c] for *_, k in part if k == c) for c in classes]

    def gini(part):
        w = weight_of(part)
        return sum(w) - sum(v * v for v in w) / sum(w)

    if depth == 0 or len({r[2] for r in data}) == 1 or len(data) < 2 * min_leaf:
        return data
    options = []
    for f in (0, 1):
        for edge in edges[f]:
            left, right = [r for r in data if r[f] <= edge], [r for r in data if r[f] > edge]
            if min(len(left), len(right)) >= min_leaf:
                cut = (max(r[f] for r in left) + min(r[f] for r in right)) / 2
                options.append((round((gini(left) + gini(right)) / sum(weight_of(data)), 9), f, cut, left, right))
    if not options:
        return data
    _, f, cut, left, right = min(options, key=lambda o: o[:3])
    again = (depth - 1, min_leaf, weights, classes, edges)
    return f, cut, binned_tree(left, *again), binned_tree(right, *again)


@pytest.mark.parametrize("bins", [2, 6, 300])
def test_binned_trees_of_all_leaf_sizes(table, bins):
    data = points(260, 3)
    classes, weights = balanced(data)
    features = table(data).selectExpr("array(x, y) AS features")
    edges = fit_bins(features, 2, bins).edges
    assert all(len(e) < bins for e in edges)
    trees = fit_trees(table(data), ["x", "y"], max_depth=5, leaf_sizes=(1, 2, 9), exact=False, max_bins=bins)
    for m, tree in trees.items():
        same(tree, binned_tree(data, 5, m, weights, classes, edges), data, data, table)


def test_binned_leaves_on_900_prices_are_those_of_the_exact_tree(table):
    rng = random.Random(11)
    data = [(rng.randint(1, 50) * 1.0, 900 + i + rng.randint(0, 99) / 100, rng.choice([i * 4 // 900, rng.randrange(4)])) for i in range(900)]
    classes, weights = balanced(data)
    trees = fit_trees(table(data), ["x", "y"], max_depth=6, leaf_sizes=(1, 2), exact=False, max_bins=1024)
    for m, tree in trees.items():
        same(tree, gini_tree(data, 6, m, weights, classes), data, data, table)


def test_only_the_smaller_child_of_a_split_is_counted(table, monkeypatch):
    counted, count = [], growth.count_cells

    def spy(known, grown, nodes):
        counted.append([int(grown.nodes[n].counts.sum()) for n in nodes])
        return count(known, grown, nodes)

    monkeypatch.setattr(growth, "count_cells", spy)
    fit_trees(table(points(400, 4)), ["x", "y"], max_depth=4, leaf_sizes=(1, 2), exact=False)
    assert counted[0] == [400] and len(counted) == 4
    assert all(sum(sizes) <= 2 * 200 for sizes in counted[1:])


def test_leaf_sizes_share_the_nodes_they_agree_on(table):
    data = points(300, 5)
    trees = fit_trees(table(data), ["x", "y"], max_depth=2, leaf_sizes=(1, 2))
    assert trees[1] == trees[2]
    assert trees[1] == fit_exact_tree(table(data), ["x", "y"], max_depth=2)


def test_rows_are_written_once_and_no_level_is(table, monkeypatch):
    written, write = [], growth.materialise
    monkeypatch.setattr(growth, "materialise", lambda df, name, *a: written.append(name) or write(df, name, *a))
    fit_trees(table(points(200, 6)), ["x", "y"], max_depth=4, max_bins=8)
    assert written == ["binned"]


def test_tables_of_many_rows_take_fewer_bins(table, monkeypatch):
    data = points(120, 10)
    passes, inner = [], growth.inner_splits
    monkeypatch.setattr(growth, "inner_splits", lambda *a: passes.append(a) or inner(*a))
    whole = fit_exact_tree(table(data), ["x", "y"], max_depth=3)
    assert not passes
    monkeypatch.setattr(growth, "FEW_ROWS", 100)
    monkeypatch.setattr(growth, "VALUES", 6)
    assert fit_exact_tree(table(data), ["x", "y"], max_depth=3) == whole and passes


def test_sparse_histograms_and_small_blocks_change_nothing(table, monkeypatch):
    data = points(150, 7)
    whole = [fit_trees(table(data), ["x", "y"], max_depth=4, leaf_sizes=(1, 3), exact=e, max_bins=9) for e in (True, False)]
    monkeypatch.setattr(growth, "DENSE", 5)
    monkeypatch.setattr(growth, "BLOCK", 1)
    assert [fit_trees(table(data), ["x", "y"], max_depth=4, leaf_sizes=(1, 3), exact=e, max_bins=9) for e in (True, False)] == whole


def test_wide_tables(rows):
    rng = random.Random(8)
    names = [f"f{i}" for i in range(40)]
    data = [[rng.randrange(5) * 1.0 if i % 2 else rng.random() for i in range(40)] for _ in range(120)]
    labelled = [(*r, int(r[7] + r[12] * 3 > 3)) for r in data]
    schema = ", ".join(f"{n} double" for n in names) + ", `__target__` long"
    narrow = [(r[7], r[12], r[-1]) for r in labelled]
    tree = fit_exact_tree(rows(schema, labelled), names, max_depth=2)
    assert tree.nodes[0].feature in range(40)
    small = fit_exact_tree(rows(SCHEMA, narrow), ["x", "y"], max_depth=1)
    score = [sum(abs(a - b) for a, b in zip(s, (0.5, 0.5))) for s in tree.leaf_shares()]
    assert len(score) == len(tree.nodes) and small.nodes[0].counts == tree.nodes[0].counts


def test_rows_without_class_do_not_count(rows):
    data = [(0.0, 0.0, 0), (1.0, 0.0, 1), (0.5, 0.0, None)]
    tree = fit_exact_tree(rows(SCHEMA, data), ["x", "y"])
    assert tree.nodes[0].counts == (1, 1) and tree.nodes[0].threshold == 0.5


def test_neighbouring_doubles_and_signed_zeros(rows):
    a = 0.1
    b = float(np.nextafter(a, 1))
    tree = fit_exact_tree(rows(SCHEMA, [(a, -0.0, 0), (b, 0.0, 1)]), ["x", "y"])
    assert tree.nodes[0].threshold == a and len(tree.nodes) == 3


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_no_cut_inside_a_bin_is_below_its_bound(data):
    classes = data.draw(st.integers(2, 4))
    weights = np.array(data.draw(st.lists(st.floats(0.1, 9), min_size=classes, max_size=classes)))
    labels = data.draw(st.lists(st.integers(0, classes - 1), min_size=2, max_size=14))
    before, after = (np.array(data.draw(st.lists(st.integers(0, 9), min_size=classes, max_size=classes))) for _ in range(2))
    inside = np.bincount(labels, minlength=classes)
    totals = before + inside + after
    cuts = [before + np.bincount(labels[:i], minlength=classes) for i in range(1, len(labels))]
    true = min(float(impurity(c * weights) + impurity((totals - c) * weights)) for c in cuts)
    for limit in (8, 0):
        growth.CORNER_CLASSES, kept = limit, growth.CORNER_CLASSES
        bound = inner_bounds(before[None], inside[None], totals, weights)[0]
        growth.CORNER_CLASSES = kept
        assert bound <= true + 1e-9


def test_bins_that_cannot_win_stay_closed():
    rng = np.random.default_rng(0)
    # Two classes that part at a boundary of bins: nothing inside a bin does as well.
    counts = np.zeros((64, 2), dtype=np.int64)
    counts[:32, 0], counts[32:, 1] = rng.integers(50, 90, 32), rng.integers(50, 90, 32)
    bins = Bins((np.arange(63.0),))
    found = decide(counts, bins, np.ones(2), [1], np.zeros(64, dtype=bool))
    assert found.best[0][1] == 31 and len(found.open) == 0
    # Mixed classes, well apart: few bins are open.
    share = 1 / (1 + np.exp(-(np.arange(64) - 31.5) / 3))
    counts = np.stack([rng.poisson(1 + 500 * share), rng.poisson(501 - 500 * share)], axis=1)
    found = decide(counts, bins, np.ones(2), [1], np.zeros(64, dtype=bool))
    assert 0 < len(found.open) < 8


def test_method_of_a_sweep(table):
    data = points(200, 9)
    df = table(data)
    grid = TreeGrid((1, 3), (1, 2))
    reports = {
        m: sweep_tree(df, df, ["x", "y"], grid=grid, method=m, max_bins=1024).report.orderBy("model", "row").collect()
        for m in ("exact", "binned")
    }
    assert reports["exact"] == reports["binned"]
    with pytest.raises(ValueError, match="unknown trees"):
        sweep_tree(df, df, ["x", "y"], grid=grid, method="random")
