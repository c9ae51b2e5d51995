"""Answers that must not depend on the scale of numbers, the size of tables or the form of a search."""

import math

import pytest

from tamiz.functions.columns import Roles, feature_array, standardise_types
from tamiz.operators.balance import undersample
from tamiz.operators.evaluate import multiclass_auc
from tamiz.operators.knn import SearchLimits, nearest_neighbours, shares, training_table, votes, winner
from tamiz.operators.missing import ImputeSpec, fit_imputer
from tamiz.operators.split import stratified_split
from tamiz.operators.sweep import KnnGrid
from tamiz.operators.tree import fit_exact_tree, fit_mllib_tree
from tamiz.plans.scoring import score
from tamiz.plans.training import TrainConfig, train
from tamiz.sources.sinks import write_csv
from tamiz.sources.tables import read_csv
from tests.conftest import collected

CELLS = SearchLimits(direct_rows=0, cell_rows=4, wide_cell_rows=4, block_train=4, block_queries=4)
POINTS = "id long, x double, label long"


def neighbours(rows, train_rows, asked, k, limits=SearchLimits(), key="long"):
    known = training_table(rows(POINTS, train_rows), ["x"], "id", "label")
    queries = rows(f"row_id {key}, x double", asked).withColumn("features", feature_array(["x"])).drop("x")
    return nearest_neighbours(known, queries, k, 2, "row_id", limits)


def test_tiny_distances_differ(rows):
    found = neighbours(rows, [(1, 5e-10, 0), (2, 0.0, 1)], [(1, 1e-12)], 1).first()
    assert found["neighbours"][0]["train_id"] == 2 and found["neighbours"][0]["distance"] == pytest.approx(1e-12)


@pytest.mark.parametrize("limits", [SearchLimits(), CELLS])
def test_repeated_and_missing_keys_are_rows_of_their_own(rows, limits):
    points = [(i, float(i), i % 2) for i in range(20)]
    found = neighbours(rows, points, [(9, 1.2), (9, 15.2), (None, 7.2)], 2, limits).collect()
    ids = sorted(sorted(n["train_id"] for n in r["neighbours"]) for r in found)
    assert ids == [[1, 2], [7, 8], [15, 16]] and sorted(str(r["row_id"]) for r in found) == ["9", "9", "None"]


def test_text_keys(rows):
    known = rows("id string, x double, label long", [("a", 1.0, 0), ("b", 5.0, 1)])
    table = training_table(known, ["x"], "id", "label")
    asked = rows("row_id string, x double", [("q", 4.0)]).withColumn("features", feature_array(["x"])).drop("x")
    assert nearest_neighbours(table, asked, 1).first()["neighbours"][0]["label"] == 1


@pytest.mark.parametrize("scale", [1e-100, 1e-12, 1.0, 1e10, 1e100])
def test_votes_by_distance(rows, scale):
    data = [(1, 1.0 * scale, 1), (2, -2.0 * scale, 0)]
    found = neighbours(rows, data, [(1, 0.0)], 2)
    vote = votes("neighbours", [0, 1], 2, "distance")
    r = found.select(winner(vote, [0, 1]).alias("w"), shares(vote).alias("s")).first()
    assert r["w"] == 1 and r["s"] == pytest.approx([1 / 3, 2 / 3])


def test_curve_of_tiny_scores(rows):
    data = [(0, 4e-12, 1e-12), (0, 3e-12, 2e-12), (1, 2e-12, 3e-12), (1, 1e-12, 4e-12)]
    df = rows("label long, a double, b double", data)
    assert multiclass_auc(df, {0: "a", 1: "b"}, "label").first()["auc"] == 1.0


def test_csv_types(spark, rows, tmp_path):
    df = rows("id long, code string, big string, n string", [(1234567890123456789, "1D", "99999999999999999999", "1.5"), (1234567890123456788, "2F", "99999999999999999998", "2e3")])
    write_csv(df, str(tmp_path))
    out = read_csv(spark, str(tmp_path))
    assert dict(out.dtypes) == {"id": "bigint", "code": "string", "big": "string", "n": "double"}
    assert sorted(r["id"] for r in out.collect()) == [1234567890123456788, 1234567890123456789]
    with pytest.raises(ValueError, match="not in"):
        read_csv(spark, str(tmp_path), {"id": "long", "gone": "double"})


def test_java_suffixes_are_no_numbers(rows):
    df = rows("row_id int, x string", [(1, "1D"), (2, " 2.5 "), (3, "-1e3"), (4, None)])
    assert collected(standardise_types(df, Roles(("x",)), lenient=True), "row_id") == [(1, None), (2, 2.5), (3, -1000.0), (4, None)]


def test_missing_features_stop_a_tree(rows):
    whole = [(i, float(i), i % 2) for i in range(8)]
    for gap in (None, float("nan")):
        holed = rows(POINTS, [*whole, (9, gap, 0)])
        with pytest.raises(Exception, match="missing"):
            fit_exact_tree(holed, ["x"], "label")
        with pytest.raises(Exception, match="missing"):
            fit_exact_tree(rows(POINTS, whole), ["x"], "label").transform(holed).collect()


def test_neighbouring_doubles_are_divided(rows):
    a = 1.0 + 2**-52
    b = math.nextafter(a, 2)
    for low, high in ((a, b), (-1.7e308, 1.7e308)):
        df = rows(POINTS, [(1, low, 0), (2, high, 1)])
        tree = fit_exact_tree(df, ["x"], "label")
        assert collected(tree.transform(df).select("id", "predicted_value"), "id") == [(1, 0), (2, 1)]


def test_classes_of_the_map_without_rows(rows):
    df = rows(POINTS, [(i, float(i), 1 if i < 5 else 2) for i in range(10)])
    for fit in (fit_exact_tree, fit_mllib_tree):
        got = collected(fit(df, ["x"], "label", classes=[1, 2, 7]).transform(df).select("id", "predicted_value", "probabilities"), "id")
        assert got[0] == (0, 1, [1.0, 0.0, 0.0]) and got[9] == (9, 2, [0.0, 1.0, 0.0])
    with pytest.raises(ValueError, match="no class"):
        fit_exact_tree(df, ["x"], "label", classes=[1])


def test_deep_trees_are_walked_in_batches(rows, monkeypatch):
    import tamiz.operators.tree as tree_module

    df = rows(POINTS, [(i, float(i), i * 7 % 3) for i in range(40)])
    small = fit_exact_tree(df, ["x"], "label", max_depth=30)
    want = collected(small.transform(df), "id")
    monkeypatch.setattr(tree_module, "LITERAL_NODES", 1)
    assert fit_exact_tree(df, ["x"], "label", max_depth=30) == small
    assert sorted(map(tuple, small.transform(df).select("id", "x", "label", "predicted_value", "probabilities").collect())) == want


def test_whole_numbers_take_fractions(rows):
    df = rows("id int, n int", [(1, 1), (2, 2), (3, None), (4, 2)])
    for spec, want in ((ImputeSpec("n", "MEAN"), 5 / 3), (ImputeSpec("n", "MEDIAN"), 2), (ImputeSpec("n", "CONSTANT", 0.5), 0.5)):
        out = fit_imputer(df, [spec], "self", None).transform(df)
        assert collected(out, "id")[2][1] == pytest.approx(want)


def test_rows_without_class_belong_to_no_part(rows):
    df = rows("id long, t string", [(i, "ab"[i % 2]) for i in range(20)] + [(50, None)])
    assert [r["split"] for r in stratified_split(df, "id", "t").where("t IS NULL").collect()] == [None]
    assert undersample(df, "id", "t").where("t IS NULL").count() == 0


ROWS = "row_id long, x double, c string, t string"


def test_job_fills_categories_before_coding_and_leaves_even_classes(rows):
    data = [(i, float(i % 13), None if i % 5 == 0 else "uv"[i % 2], "yes" if i % 2 else "no") for i in range(60)]
    df = rows(ROWS, data)
    grid = KnnGrid((1,), ("uniform",), (1,))
    for method in ("CREATE_CATEGORY", "MODE"):
        config = TrainConfig(
            Roles(("x",), ("c",), target="t"), {"no": 0, "yes": 1}, knn_grid=grid,
            impute=(ImputeSpec("x", "MEAN"), ImputeSpec("c", method)), rescale={},
        )
        done = train(df, config)
        codes = {r["c"] for r in done.train.unionByName(done.dev).select("c").collect()}
        assert codes == ({0.0, 1.0, 2.0} if method == "CREATE_CATEGORY" else {0.0, 1.0})
        # Thirty rows of each class: nothing to balance.
        assert done.train.count() + done.dev.count() == 60


def test_refill_drops_the_rows_that_the_plain_form_drops(rows):
    data = [(i, None if i % 5 == 0 else float(i % 13), "u", "yes" if i % 2 else "no") for i in range(60)]
    df = rows(ROWS, data)
    config = TrainConfig(
        Roles(("x",), target="t"), {"no": 0, "yes": 1}, knn_grid=KnnGrid((1,), ("uniform",), (1,)), drop_missing=("x",)
    )
    done = train(df, config)
    again = score(df, done.preparation, done.model, refill=(ImputeSpec("x", "MEAN"),))
    assert again.predictions.count() == score(df, done.preparation, done.model).predictions.count() == 48
