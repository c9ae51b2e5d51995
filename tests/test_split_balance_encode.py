import hashlib
from collections import Counter

import pytest

import tamiz.functions.running as running
import tamiz.operators.encode as encode
import tamiz.operators.split as split_module
from tamiz.operators.balance import (
    balanced_weights,
    class_weight_table,
    undersample,
    undersample_splits,
    undersampling_quotas,
    with_class_weights,
)
from tamiz.operators.encode import fit_factorizer
from tamiz.operators.split import random_split, stratified_quotas, stratified_split
from tests.conftest import collected


def md5(seed, key):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def labelled(n=600):
    # Class 0 holds more than a third of all rows.
    return [(i, 0 if i % 2 else 1 + i % 3) for i in range(n)]


def test_quotas():
    assert stratified_quotas({0: 50, 1: 50, 2: 50}, 0.2) == {0: 10, 1: 10, 2: 10}
    # 11 rows give ceil(2.2) = 3; shares 1.36, 0.82, 0.82.
    assert stratified_quotas({"a": 5, "b": 3, "c": 3}, 0.2) == {"a": 1, "b": 1, "c": 1}
    assert stratified_quotas({0: 7, 1: 3}, 0.5) == {0: 4, 1: 1}


def test_classes_too_small_to_split(rows):
    with pytest.raises(ValueError, match="single row"):
        stratified_quotas({0: 10, 1: 1}, 0.2)
    with pytest.raises(ValueError, match="cannot hold"):
        stratified_quotas({0: 2, 1: 2, 2: 2}, 0.2)
    with pytest.raises(ValueError, match="no rows"):
        stratified_split(rows("k int, c int", []), "k", "c")


@pytest.mark.parametrize("ranked_rows", [200_000, 0, 3])
def test_bucketed_sample_equals_plain_ranking(rows, monkeypatch, ranked_rows):
    monkeypatch.setattr(split_module, "RANKED_ROWS", ranked_rows)
    data = labelled()
    expected = set()
    quotas = stratified_quotas(Counter(c for _, c in data), 0.2)
    for c, q in quotas.items():
        expected.update(sorted((k for k, x in data if x == c), key=lambda k: md5(42, k))[:q])
    for partitions in (1, 4, 17):
        out = stratified_split(rows("k int, c int", data, partitions), "k", "c")
        assert {r["k"] for r in out.where("split = 'dev'").collect()} == expected
        assert out.count() == len(data)


def test_prefixes_may_collide(rows, monkeypatch):
    # One hex digit per step: many rows share each prefix.
    monkeypatch.setattr(split_module, "PREFIX_STEP", 1)
    monkeypatch.setattr(split_module, "RANKED_ROWS", 2)
    data = labelled(200)
    out = undersample(rows("k int, c int", data), "k", "c")
    counts = Counter(c for _, c in data)
    least = min(counts.values())
    expected = set()
    for c in counts:
        expected.update(sorted((k for k, x in data if x == c), key=lambda k: md5(42, k))[:least])
    assert {r["k"] for r in out.collect()} == expected


def test_random_split_is_stable_and_near_its_share(rows):
    data = [(i,) for i in range(4000)]
    picks = [
        {r["k"] for r in random_split(rows("k int", data, p), "k").where("split = 'train'").collect()} for p in (1, 5)
    ]
    assert picks[0] == picks[1] and 3080 < len(picks[0]) < 3320
    assert random_split(rows("k int", data), "k", 1.0).where("split = 'dev'").count() == 0


def test_undersampling_quotas():
    assert undersampling_quotas({0: 10, 1: 4, 2: 4}, "not minority") == {0: 4}
    assert undersampling_quotas({0: 100, 1: 10}, 0.5) == {0: 20}
    with pytest.raises(ValueError, match="would need"):
        undersampling_quotas({0: 15, 1: 10}, 0.5)
    with pytest.raises(ValueError, match="two classes"):
        undersampling_quotas({0: 1, 1: 2, 2: 3}, 0.5)
    with pytest.raises(ValueError, match="strategy"):
        undersampling_quotas({0: 1, 1: 2}, "all")


def test_undersample_ratio_and_unknown_class(rows):
    data = [(i, 0 if i < 90 else 1) for i in range(100)] + [(100, None)]
    out = undersample(rows("k int, c int", data), "k", "c", 0.5)
    assert Counter(r["c"] for r in out.collect()) == {0: 20, 1: 10}
    assert undersample(rows("k int, c int", []), "k", "c").count() == 0


def test_balanced_classes_stay_whole(rows):
    out = undersample(rows("k int, c int", [(i, i % 3) for i in range(30)]), "k", "c")
    assert out.count() == 30


def test_undersample_parts_apart(rows):
    data = [(i, "train" if i % 4 else "dev", 0 if i % 5 else 1) for i in range(200)]
    df = rows("k int, split string, c int", data)
    only_train = Counter((r["split"], r["c"]) for r in undersample_splits(df, "k", "c").collect())
    assert only_train == {("train", 0): 30, ("train", 1): 30, ("dev", 0): 40, ("dev", 1): 10}
    both = undersample_splits(df, "k", "c", balanced=("train", "dev"))
    assert Counter((r["split"], r["c"]) for r in both.collect())["dev", 0] == 10
    assert both.columns == df.columns


def test_weights(rows):
    assert balanced_weights({0: 6, 1: 2}) == {0: 8 / 12, 1: 2.0}
    df = rows("c int", [(0,)] * 6 + [(1,)] * 2)
    assert collected(class_weight_table(df, "c"), "c") == [(0, 6, 8 / 12), (1, 2, 2.0)]
    assert {tuple(r) for r in with_class_weights(df, "c").collect()} == {(0, 8 / 12), (1, 2.0)}


@pytest.mark.parametrize("literals, broadcast, small", [(256, 500_000, 10**6), (0, 500_000, 10**6), (0, 0, 0)])
def test_codes_by_first_appearance(rows, monkeypatch, literals, broadcast, small):
    monkeypatch.setattr(encode, "LITERAL_MAP_LIMIT", literals)
    monkeypatch.setattr(encode, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(running, "SMALL_ROWS", small)
    data = [(10, "z", 5), (2, "b", 5), (3, None, 6), (4, "a", 7), (5, "b", 6), (1, "z", None)]
    coder = fit_factorizer(rows("k int, s string, n int", data, 3), ["s", "n"], "k")
    asked = rows("k int, s string, n int", [(7, "a", 9), (8, "new", 7), (9, None, 5), (11, "z", 6)])
    assert collected(coder.transform(asked), "k") == [(7, 2, -1), (8, -1, 2), (9, -1, 0), (11, 0, 1)]


def test_running_totals_in_both_forms(rows, monkeypatch):
    data = [("hot", i, i % 7) for i in range(300)] + [("b", 4, 1), ("b", 9, 2), ("c", 1, 5)]
    df = rows("g string, o int, s int", data, 6)
    out = []
    for small in (10**6, 0):
        monkeypatch.setattr(running, "SMALL_ROWS", small)
        out.append(collected(running.running_totals(df, ["g"], "o", ["s"]), "g", "o"))
    assert out[0] == out[1]
    assert out[0][0] == ("b", 4, 1, None, 0, 3) and out[0][1] == ("b", 9, 2, 4, 1, 3)
    assert out[0][-1][4] == sum(i % 7 for i in range(299))
