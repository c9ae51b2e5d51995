"""Binned trees on features with more values than bins, against a brute-force version."""

import random

import pytest

from tamiz.catalogue import queries
from tamiz.operators.evaluate import classification_report, confusion_matrix
from tamiz.operators.split import stratified_split
from tamiz.operators.sweep import TreeGrid
from tamiz.plans.training import prepare, train

BINS = 256
X, Y = queries.PART_FEATURES
SCHEMA = "p_partkey long, p_brand string, p_type string, p_size long, p_retailprice double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """900 parts of 900 prices, every 12th with gaps."""
    rng = random.Random(11)
    kinds = sorted(queries.PART_TYPES)
    rows = []
    for i in range(900):
        size, price = rng.randint(1, 50), 900 + i + rng.randint(0, 99) / 100
        at = i * 6 // 900 if rng.random() < 0.6 else (size - 1) * 6 // 50
        rows.append((i, f"Brand#{7 if i % 12 == 0 else i % 5}", kinds[at], size, price))
    place = str(tmp_path_factory.mktemp("parts"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{place}/part.parquet")
    return place


def cuts(values):
    """Between which of the values, given with weights, a binned tree may split: between all, or where the next bin's
    share of the weight is nearest."""
    known = sorted({v for v, _ in values})
    if len(known) <= BINS:
        return [(a + b) / 2 for a, b in zip(known, known[1:])]
    counts = [sum(w for v, w in values if v == k) for k in known]
    stride = sum(w for _, w in values) / BINS
    out, current, target = [], counts[0], stride
    for i in range(1, len(known)):
        before, current = current, current + counts[i]
        if abs(before - target) < abs(current - target):
            out.append((known[i - 1] + known[i]) / 2)
            target += stride
    return out


def binned_tree(rows, depth, min_leaf):
    """Nodes by definition on lists of (x, y, class): (feature, cut, left, right) or the class of a leaf."""
    classes = sorted({r[2] for r in rows})
    weight = {c: len(rows) / (len(classes) * sum(r[2] == c for r in rows)) for c in classes}
    edges = [cuts([(r[f], weight[r[2]]) for r in rows]) for f in (0, 1)]

    def sums(part):
        return [weight[c] * sum(r[2] == c for r in part) for c in classes]

    def gini(w):
        return 1 - sum((v / sum(w)) ** 2 for v in w)

    def grow(part, depth):
        w = sums(part)
        best = (0.0, None)
        if depth:
            for f in (0, 1):
                for cut in edges[f]:
                    left = [r for r in part if r[f] <= cut]
                    if min(len(left), len(part) - len(left)) < min_leaf:
                        continue
                    a = sums(left)
                    b = [u - v for u, v in zip(w, a)]
                    gain = gini(w) - (sum(a) * gini(a) + sum(b) * gini([max(0.0, v) for v in b])) / sum(w)
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, cut))
        if best[1] is None:
            return classes[max(range(len(classes)), key=lambda i: (round(w[i], 9), -i))]
        f, cut = best[1]
        return f, cut, grow([r for r in part if r[f] <= cut], depth - 1), grow([r for r in part if r[f] > cut], depth - 1)

    return grow(rows, depth)


def predict(node, row):
    while isinstance(node, tuple):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def points(df, label):
    return [(r[X], r[Y], r[label]) for r in df.collect()]


def best_f1(truth, made):
    """Macro mean of F1 over the classes that occur."""
    out = []
    for c in sorted({*truth, *made}):
        hit = sum(t == m == c for t, m in zip(truth, made))
        out.append(2 * hit / max(1, truth.count(c) + made.count(c)))
    return sum(out) / len(out)


def parts_of(spark, folder):
    split = stratified_split(queries.stored_parts(spark, folder), "p_partkey", "label")
    return split.where("split = 'train'"), split.where("split = 'dev'")


def test_prediction_on_more_prices_than_bins(spark, folder):
    train_rows, dev_rows = parts_of(spark, folder)
    known = points(train_rows, "label")
    assert len({y for _, y, _ in known}) > BINS
    tree = binned_tree(known, 5, 1)
    want = {r["p_partkey"]: predict(tree, (r[X], r[Y])) for r in dev_rows.collect()}
    got = queries.QUERIES["tree_mllib_predict"](spark, folder).collect()
    assert {r["p_partkey"]: r["predicted_value"] for r in got} == want


def shallow():
    """Models whose nodes are so large that no two splits tie."""
    return {n: size for n, size in TreeGrid().models().items() if size[0] == 3}


def test_sweep_on_more_prices_than_bins(spark, folder):
    train_rows, dev_rows = parts_of(spark, folder)
    known, asked = points(train_rows, "label"), points(dev_rows, "label")
    made = []
    for name, (depth, leaf) in shallow().items():
        tree = binned_tree(known, depth, leaf)
        made += [(name, c, predict(tree, (x, y))) for x, y, c in asked]
    df = spark.createDataFrame(made, "model string, label long, predicted_value long")
    want = queries.report_columns(classification_report(confusion_matrix(df, "label", by=["model"]), ["model"]))
    got = queries.QUERIES["tree_sweep_report"](spark, folder).collect()
    assert {r["model"] for r in got} == set(TreeGrid().models())
    assert sorted(str(r) for r in got if r["model"] in shallow()) == sorted(map(str, want.collect()))


def test_job_fills_gaps_and_bins_prices(spark, folder):
    config = queries.part_config(algorithm="DecisionTree", exact_tree=False, measure="macro f1-score")
    rows = queries.parts_with_gaps(spark, folder)
    assert rows.where(f"{X} IS NULL AND {Y} IS NULL").count() == 75
    # The rows as the job prepares them: filled, rescaled and undersampled.
    done = train(rows, config)
    known, asked = points(done.train, "__target__"), points(done.dev, "__target__")
    assert prepare(rows, config)[1].where(f"{X} IS NULL OR {Y} IS NULL").count() == 0
    assert len({y for _, y, _ in known}) > BINS
    report = done.sweep.report.where("row = 'macro avg'").collect()
    values = {r["model"]: round(r["f1_score"], 6) for r in report}
    for name, (depth, leaf) in shallow().items():
        tree = binned_tree(known, depth, leaf)
        assert values[name] == round(best_f1([c for *_, c in asked], [predict(tree, r) for r in asked]), 6)
    (best,) = queries.QUERIES["training_job_best_tree"](spark, folder).collect()
    assert best["value"] == max(values.values()) == values[best["name"]]
