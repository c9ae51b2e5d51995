import itertools

import pytest

import tamiz.functions.running as running
from tamiz.operators.evaluate import best_model, classification_report, confusion_matrix, goodness, multiclass_auc
from tests.conftest import collected


def report_of(rows, pairs):
    df = rows("`__target__` long, predicted_value long", pairs)
    return {r["row"]: tuple(r)[1:] for r in classification_report(confusion_matrix(df)).collect()}


def test_report_by_hand(rows):
    pairs = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 1), (None, 2)]
    report = report_of(rows, pairs)
    assert report["0"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert report["1"] == pytest.approx((1 / 3, 1 / 2, 2 / 5, 2))
    # Never predicted: precision 0/0 counts as 0.
    assert report["2"] == (0.0, 0.0, 0.0, 1.0)
    assert report["accuracy"] == pytest.approx((0.5, 0.5, 0.5, 0.5))
    assert report["macro avg"] == pytest.approx((1 / 3, 7 / 18, (2 / 3 + 2 / 5) / 3, 6))
    assert report["weighted avg"][2] == pytest.approx((3 * 2 / 3 + 2 * 2 / 5) / 6)


def test_predicted_class_absent_from_truth(rows):
    report = report_of(rows, [(0, 0), (0, 5)])
    assert report["5"] == (0.0, 0.0, 0.0, 0.0)
    assert report["macro avg"][1] == pytest.approx(0.25)


def test_confusion_per_model(rows):
    df = rows("m string, t long, p long", [("a", 0, 0), ("a", 0, 0), ("b", 0, 1)])
    assert collected(confusion_matrix(df, "t", "p", ["m"]), "m") == [("a", 0, 0, 2), ("b", 0, 1, 1)]


def test_goodness_names(rows):
    report = rows("model string, row string, f1_score double", [("a", "macro avg", 0.2), ("a", "weighted avg", 0.4)])
    assert goodness(report, "macro f1-score").first()["value"] == 0.2
    assert goodness(report, "weighted f1-score").first()["value"] == 0.4
    with pytest.raises(ValueError, match="unknown measure"):
        goodness(report, "accuracy")


def test_best_model_first_wins(rows):
    scores = rows("model string, value double", [("b", 0.5), ("c", 0.7), ("a", 0.7 + 1e-16)])
    assert tuple(best_model(scores, ["b", "c", "a"]).first()) == ("c", 0.7)
    assert tuple(best_model(scores, ["a", "b", "c"]).first())[0] == "a"


def test_no_model_above_zero(rows):
    assert tuple(best_model(rows("model string, value double", [("a", 0.0)]), ["a"]).first()) == ("empty", 0.0)
    assert tuple(best_model(rows("model string, value double", []), ["a"]).first()) == ("empty", 0.0)


def auc_by_pairs(data, classes):
    out = []
    for i, j in itertools.permutations(classes, 2):
        a = [r[1 + classes.index(i)] for r in data if r[0] == i]
        b = [r[1 + classes.index(i)] for r in data if r[0] == j]
        if a and b:
            won = sum((x > y) + (x == y) / 2 for x in a for y in b)
            out.append(won / (len(a) * len(b)))
    return sum(out) / len(out)


@pytest.mark.parametrize("small", [10**6, 0])
def test_auc_equals_all_pairs(rows, monkeypatch, small):
    monkeypatch.setattr(running, "SMALL_ROWS", small)
    data = [(i % 3, (i * 7 % 10) / 10, (i * 3 % 8) / 10, (i * i % 6) / 10) for i in range(90)]
    df = rows("t long, a double, b double, c double", data)
    got = multiclass_auc(df, {0: "a", 1: "b", 2: "c"}, "t").first()["auc"]
    assert got == pytest.approx(auc_by_pairs(data, [0, 1, 2]))


def test_binary_auc_and_absent_class(rows):
    data = [(0, 0.9, 0.1), (0, 0.6, 0.4), (1, 0.6, 0.4), (1, 0.2, 0.8)]
    df = rows("t long, a double, b double", data)
    assert multiclass_auc(df, {0: "a", 1: "b"}, "t").first()["auc"] == pytest.approx(0.875)
    three = multiclass_auc(df.selectExpr("*", "0d as c"), {0: "a", 1: "b", 2: "c"}, "t")
    assert three.first()["auc"] == pytest.approx(0.875)
