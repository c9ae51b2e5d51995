import pytest
from pyspark.sql import functions as F

import tamiz.functions.running as running
from tamiz.operators.sweep import KnnGrid, TreeGrid, sweep_knn, sweep_tree
from tamiz.operators.tree import ExactTree, fit_exact_tree, fit_mllib_tree
from tests.conftest import collected

SCHEMA = "row_id long, x double, y double, `__target__` long"


def gini_tree(rows, depth, min_leaf, weights, classes):
    """CART by definition, on lists of (x, y, class)."""

    def weight_of(part):
        return [sum(weights[c] for *_, k in part if k == c) for c in classes]

    def impurity(part):
        w = weight_of(part)
        return sum(w) - sum(v * v for v in w) / sum(w)

    if depth == 0 or len({r[2] for r in rows}) == 1 or len(rows) < 2 * min_leaf:
        return rows
    options = []
    for f in (0, 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            left = [r for r in rows if r[f] <= cut]
            right = [r for r in rows if r[f] > cut]
            if min(len(left), len(right)) >= min_leaf:
                score = round((impurity(left) + impurity(right)) / sum(weight_of(rows)), 9)
                options.append((score, f, cut, left, right))
    if not options:
        return rows
    _, f, cut, left, right = min(options, key=lambda o: o[:3])
    again = (depth - 1, min_leaf, weights, classes)
    return f, cut, gini_tree(left, *again), gini_tree(right, *again)


def shares_of(node, x, weights, classes):
    while isinstance(node, tuple):
        f, cut, left, right = node
        node = left if x[f] <= cut else right
    w = [sum(weights[c] for *_, k in node if k == c) for c in classes]
    return [v / sum(w) for v in w]


@pytest.mark.parametrize("small", [10**6, 0])
@pytest.mark.parametrize("min_leaf", [1, 4])
def test_exact_tree_equals_definition(rows, monkeypatch, small, min_leaf):
    monkeypatch.setattr(running, "SMALL_ROWS", small)
    data = [(i, float(i * 37 % 23), float(i * 11 % 19), (i * i + i // 7) % 3) for i in range(60)]
    df = rows(SCHEMA, data, 5)
    classes = [0, 1, 2]
    sizes = [sum(1 for r in data if r[3] == c) for c in classes]
    weights = {c: 60 / (3 * n) for c, n in zip(classes, sizes)}
    for depth in (0, 1, 3) if small else (2,):
        expected = gini_tree([r[1:] for r in data], depth, min_leaf, weights, classes)
        fitted = fit_exact_tree(df, ["x", "y"], max_depth=depth, min_leaf=min_leaf)
        for r in fitted.transform(df).collect():
            want = shares_of(expected, (r["x"], r["y"]), weights, classes)
            assert r["probabilities"] == pytest.approx(want)
            rounded = [round(v, 9) for v in want]
            assert r["predicted_value"] == rounded.index(max(rounded))


def test_leaves_with_equal_prediction_keep_their_shares(rows):
    data = [(i, 0.0, 0.0, 0) for i in range(10)] + [(10 + i, 1.0, 0.0, 0 if i < 6 else 1) for i in range(10)]
    fitted = fit_exact_tree(rows(SCHEMA, data), ["x", "y"], max_depth=1, balanced=False)
    got = fitted.transform(rows(SCHEMA, [(1, 0.0, 0.0, 0), (2, 1.0, 0.0, 0)]))
    assert collected(got.select("row_id", "predicted_value", "probabilities"), "row_id") == [
        (1, 0, [1.0, 0.0]),
        (2, 0, [0.6, 0.4]),
    ]


def test_splits_without_gain_are_taken(rows):
    xor = [(i, float(i % 2), float(i // 2), (i % 2) ^ (i // 2)) for i in range(4)]
    df = rows(SCHEMA, xor)
    fitted = fit_exact_tree(df, ["x", "y"], max_depth=2)
    assert fitted.transform(df).where("predicted_value <> `__target__`").count() == 0


def test_constant_features_and_single_class_give_a_leaf(rows):
    flat = fit_exact_tree(rows(SCHEMA, [(1, 1.0, 1.0, 0), (2, 1.0, 1.0, 1)]), ["x", "y"])
    assert flat.depth == 0
    pure = fit_exact_tree(rows(SCHEMA, [(1, 1.0, 1.0, 4), (2, 2.0, 1.0, 4)]), ["x", "y"])
    assert pure.transform(rows(SCHEMA, [(1, 9.0, 9.0, 4)])).first()["predicted_value"] == 4
    with pytest.raises(ValueError, match="no rows"):
        fit_exact_tree(rows(SCHEMA, []), ["x"])
    with pytest.raises(ValueError, match="max_depth"):
        fit_exact_tree(rows(SCHEMA, [(1, 1.0, 1.0, 4)]), ["x"], max_depth=-1)


def test_cut_tree_equals_shallow_tree(rows):
    data = [(i, float(i * 37 % 23), float(i * 11 % 19), (i * i + i // 7) % 3) for i in range(60)]
    df = rows(SCHEMA, data)
    deep = fit_exact_tree(df, ["x", "y"], max_depth=4)
    for depth in (0, 1, 2):
        shallow = fit_exact_tree(df, ["x", "y"], max_depth=depth)
        assert deep.cut(depth) == shallow
        assert collected(deep.transform(df, depth), "row_id") == collected(shallow.transform(df), "row_id")
    assert ExactTree.from_json(deep.to_json()) == deep


def test_exact_and_mllib_agree_without_ties(rows):
    data = [(i, float(i), float((i * 29) % 101), 0 if i < 30 else (1 if (i * 29) % 101 < 50 else 2)) for i in range(100)]
    df = rows(SCHEMA, data)
    exact = fit_exact_tree(df, ["x", "y"], max_depth=3).transform(df)
    binned = fit_mllib_tree(df, ["x", "y"], max_depth=3).transform(df)
    pick = ["row_id", "predicted_value"]
    assert collected(exact.select(*pick), "row_id") == collected(binned.select(*pick), "row_id")


def test_prediction_is_map_only(rows):
    data = [(i, float(i), float(-i), i % 2) for i in range(20)]
    fitted = fit_exact_tree(rows(SCHEMA, data), ["x", "y"], max_depth=3)
    plan = fitted.transform(rows(SCHEMA, data))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_grid_order_and_names():
    assert list(KnnGrid().models())[:3] == ["KNN-k:1-p:1-w:uniform", "KNN-k:1-p:2-w:uniform", "KNN-k:3-p:1-w:uniform"]
    assert len(KnnGrid().models()) == 12
    assert list(TreeGrid().models())[:2] == ["DecisionTree-z:3-l:1", "DecisionTree-z:3-l:2"]


def test_tree_sweep_uses_its_grid(rows):
    # Needs depth 2: shallower trees cannot reach it.
    data = [(i, float(i % 2), float((i // 2) % 2), (i % 2) * 2 + (i // 2) % 2) for i in range(40)]
    df = rows(SCHEMA, data)
    for exact in (True, False):
        sweep = sweep_tree(df, df, ["x", "y"], grid=TreeGrid((1, 2), (1,)), exact=exact)
        value = {r["model"]: r["f1_score"] for r in sweep.report.where("row = 'weighted avg'").collect()}
        assert value["DecisionTree-z:1-l:1"] < value["DecisionTree-z:2-l:1"] == 1.0
        assert tuple(sweep.best.first()) == ("DecisionTree-z:2-l:1", 1.0)


def test_knn_sweep_first_of_equal_models_wins(rows):
    data = [(i, float(i), 0.0, 0 if i < 20 else 1) for i in range(40)]
    train = rows(SCHEMA, data)
    dev = train.where("row_id % 10 = 1").withColumn("x", F.col("x") + 0.25)
    sweep = sweep_knn(train, dev, ["x", "y"], [0, 1])
    assert tuple(sweep.best.first()) == ("KNN-k:1-p:1-w:uniform", 1.0)
    assert sweep.report.select("model").distinct().count() == 12
