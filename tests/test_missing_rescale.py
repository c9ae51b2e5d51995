import math
import statistics

import pytest

import tamiz.functions.running as running
from tamiz.operators.missing import ImputeSpec, fit_imputer, impute_all
from tamiz.operators.rescale import fit_scaler, rescale_all, scaler_table
from tamiz.operators.statistics import FeatureStats, collect_statistics, exact_median, feature_statistics, mode
from tamiz.plans.preparation import fit_fill_and_scale
from tests.conftest import collected

NAN = float("nan")
SPLIT = "i int, split string, x double"
DATA = [(1, "train", 1.0), (2, "train", 3.0), (3, "train", None), (4, "dev", 10.0), (5, "dev", NAN)]


@pytest.mark.parametrize(
    "scope, filled", [("train", (2.0, 2.0)), ("per_split", (2.0, 10.0)), ("self", (14 / 3, 14 / 3))]
)
def test_mean_by_scope(rows, scope, filled):
    df = rows(SPLIT, DATA)
    out = fit_imputer(df, [ImputeSpec("x", "MEAN")], scope).transform(df)
    got = [r["x"] for r in out.orderBy("i").collect()]
    assert got == pytest.approx([1.0, 3.0, filled[0], 10.0, filled[1]])


def test_median_interpolates(rows):
    df = rows("x double, y double", [(1.0, 5.0), (2.0, None), (3.0, NAN), (10.0, None)])
    assert collected(exact_median(df, ["x", "y"]), "feature") == [("*", "x", 2.5), ("*", "y", 5.0)]


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_median_of_many_values_in_both_forms(spark, monkeypatch, small):
    monkeypatch.setattr(running, "SMALL_ROWS", small)
    df = spark.range(0, 50_001, 1, 7).selectExpr(
        "cast(pmod(id * 7919, 50001) as double) as a",
        "cast(if(id % 3 = 0, 4, id) as double) as hot",
        "if(id % 2 = 0, 'p', 'q') as split",
    )
    got = {(r["scope"], r["feature"]): r["median"] for r in exact_median(df, ["a", "hot"], "split").collect()}
    table = df.toPandas()
    for scope, part in table.groupby("split"):
        assert got[scope, "a"] == statistics.median(part["a"])
        assert got[scope, "hot"] == statistics.median(part["hot"])


def test_mode_takes_smallest_on_tie(rows):
    df = rows("x double, s string", [(3.0, "b"), (3.0, "b"), (1.0, "a"), (1.0, "a"), (2.0, None)])
    assert collected(mode(df, ["x"], None, "double"), "feature") == [("*", "x", 1.0)]
    assert collected(mode(df, ["s"], None, "string"), "feature") == [("*", "s", "a")]


def test_constant_category_and_mode(rows):
    df = rows("i int, c string, m string, n int", [(1, None, "u", 4), (2, "v", None, None), (3, "v", "u", 4)])
    specs = [ImputeSpec("c", "CREATE_CATEGORY"), ImputeSpec("m", "MODE"), ImputeSpec("n", "CONSTANT", 9)]
    out = fit_imputer(df, specs, "self", None).transform(df)
    assert collected(out, "i") == [(1, "NULL_CATEGORY", "u", 4), (2, "v", "u", 9), (3, "v", "u", 4)]
    assert out.schema["n"].dataType.simpleString() == "int"


def test_column_without_any_value_stays_missing(rows):
    df = rows("x double, y double", [(None, 1.0), (NAN, 2.0)])
    for method in ("MEAN", "MEDIAN", "MODE"):
        out = fit_imputer(df, [ImputeSpec("x", method)], "self", None).transform(df)
        assert [r["x"] for r in out.collect()] == [None, None]


def test_empty_table(rows):
    df = rows("x double", [])
    imputer, scaler = fit_fill_and_scale(df, impute_all(["x"], "MEAN"), {"x": "AVGSTD"}, "self", None)
    assert scaler.transform(imputer.transform(df)).count() == 0


def test_bad_specs(rows):
    df = rows("x double, s string", [(1.0, "a")])
    with pytest.raises(ValueError, match="unknown fill"):
        ImputeSpec("x", "GUESS")
    with pytest.raises(ValueError, match="needs a value"):
        ImputeSpec("x", "CONSTANT")
    for spec in (ImputeSpec("s", "MEAN"), ImputeSpec("x", "CREATE_CATEGORY"), ImputeSpec("z", "MEAN")):
        with pytest.raises(ValueError):
            fit_imputer(df, [spec], "self", None)
    with pytest.raises(ValueError, match="unknown scope"):
        fit_imputer(df, [ImputeSpec("x", "MEAN")], "both")
    with pytest.raises(ValueError, match="unknown rescale"):
        fit_scaler(df, {"x": "LOG"}, "self", None)


def test_impute_all_leaves_out_exceptions():
    assert [s.feature for s in impute_all(["a", "b", "c"], "MEAN", ["b"])] == ["a", "c"]
    assert rescale_all(["a", "b"], "MINMAX", ["a"]) == {"b": "MINMAX"}


def test_rescale_by_train_and_by_split(rows):
    df = rows(SPLIT, [(1, "train", 0.0), (2, "train", 4.0), (3, "dev", 2.0), (4, "dev", 6.0)])
    by_train = fit_scaler(df, {"x": "MINMAX"}).transform(df)
    assert [r["x"] for r in by_train.orderBy("i").collect()] == [0.0, 1.0, 0.5, 1.5]
    by_split = fit_scaler(df, {"x": "MINMAX"}, "per_split").transform(df)
    assert [r["x"] for r in by_split.orderBy("i").collect()] == [0.0, 1.0, 0.0, 1.0]
    z = fit_scaler(df, {"x": "AVGSTD"}).transform(df).orderBy("i").collect()
    assert [r["x"] for r in z] == pytest.approx([v / math.sqrt(8) for v in (-2.0, 2.0, 0.0, 4.0)])


def test_constant_features_leave(rows):
    schema = "i int, split string, flat double, dev_flat double, x double"
    data = [(i, "train" if i < 4 else "dev", 0.1, float(i) if i < 4 else 0.3, float(i)) for i in range(8)]
    df = rows(schema, data)
    specs = rescale_all(["flat", "dev_flat", "x"], "AVGSTD")
    assert fit_scaler(df, specs, "per_split").dropped == ("flat", "dev_flat")
    scaler = fit_scaler(df, specs, "train")
    assert scaler.dropped == ("flat",)
    assert scaler.transform(df).columns == ["i", "split", "dev_flat", "x"]
    assert scaler_table(scaler, df).where("dropped").count() == 1


def test_single_row_has_no_deviation(rows):
    df = rows("x double", [(5.0,)])
    assert fit_scaler(df, {"x": "MINMAX"}, "self", None).dropped == ("x",)
    assert fit_scaler(df, {"x": "AVGSTD"}, "self", None).transform(df).collect()[0]["x"] is None


@pytest.mark.parametrize("method", ["MEAN", "MEDIAN", "MODE", "CONSTANT"])
@pytest.mark.parametrize("rescale", ["MINMAX", "AVGSTD"])
def test_scale_after_filling_equals_a_second_scan(rows, method, rescale):
    data = [(i, "train" if i % 3 else "dev", None if i % 4 == 0 else float(i * i % 17)) for i in range(40)]
    df = rows(SPLIT, data)
    specs = [ImputeSpec("x", method, 50.0 if method == "CONSTANT" else None)]
    for scope in ("train", "per_split", "self"):
        imputer, scaler = fit_fill_and_scale(df, specs, {"x": rescale}, scope)
        filled = fit_imputer(df, specs, scope).transform(df)
        again = fit_scaler(filled, {"x": rescale}, scope)
        for name, (shift, scale) in again.values["x"].items():
            assert scaler.values["x"][name] == pytest.approx((shift, scale))


def test_wide_tables_use_pairs_with_equal_result(rows):
    names = [f"f{i}" for i in range(70)]
    data = [tuple(float((r * (c + 3)) % 11) if (r + c) % 9 else None for c in range(70)) for r in range(30)]
    df = rows(", ".join(f"{n} double" for n in names), data)
    wide = collect_statistics(df, names)["*"]
    narrow = {}
    for part in (names[i : i + 8] for i in range(0, 70, 8)):
        narrow.update(collect_statistics(df, part)["*"])
    for n in names:
        assert (wide[n].n_rows, wide[n].n, wide[n].min, wide[n].max) == (
            narrow[n].n_rows,
            narrow[n].n,
            narrow[n].min,
            narrow[n].max,
        )
        assert wide[n].mean == pytest.approx(narrow[n].mean) and wide[n].std == pytest.approx(narrow[n].std)


def test_statistics_do_not_depend_on_layout(rows):
    data = [(float(i % 13) / 7,) for i in range(500)]
    got = [feature_statistics(rows("x double", data, p), ["x"]).first() for p in (1, 4, 17)]
    for r in got[1:]:
        assert (r["n"], r["min"], r["max"]) == (got[0]["n"], got[0]["min"], got[0]["max"])
        assert r["std"] == pytest.approx(got[0]["std"], rel=1e-12)


def test_filled_statistics_in_closed_form():
    s = FeatureStats(5, 3, 2.0, 1.0, 1.0, 3.0).filled(7.0)
    values = [1.0, 2.0, 3.0, 7.0, 7.0]
    assert (s.n, s.min, s.max) == (5, 1.0, 7.0)
    assert s.mean == pytest.approx(statistics.mean(values)) and s.std == pytest.approx(statistics.stdev(values))


def test_moments_of_wide_tables(rows):
    """Many features, gaps, splits, a large mean with a small spread; the same for every layout."""
    wide = [f"f{i}" for i in range(12)]
    schema = "part string, " + ", ".join(f"{c} double" for c in wide)
    data = [("a" if i % 3 else "b", *[None if (i + j) % 4 == 0 else 1e9 + i * 0.5 + j for j in range(10)], float("nan"), 7.0) for i in range(50)]
    for partitions in (1, 4, 17):
        found = collect_statistics(rows(schema, data, partitions), wide, "part")
        for scope in ("a", "b"):
            own = [r for r in data if r[0] == scope]
            for j in range(10):
                values = [r[j + 1] for r in own if r[j + 1] is not None]
                mean = math.fsum(values) / len(values)
                std = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / (len(values) - 1))
                s = found[scope][f"f{j}"]
                assert (s.n_rows, s.n, s.min, s.max) == (len(own), len(values), min(values), max(values))
                assert s.mean == pytest.approx(mean, rel=1e-14) and s.std == pytest.approx(std, rel=1e-7)
            assert found[scope]["f10"] == FeatureStats(len(own), 0, None, None, None, None)
            assert found[scope]["f11"] == FeatureStats(len(own), len(own), 7.0, 0.0, 7.0, 7.0)
    assert collect_statistics(rows(schema, []), wide) == {}
