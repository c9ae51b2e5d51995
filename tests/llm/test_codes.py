import hashlib
import math
import random

import numpy as np
import pytest

from tamiz.llm import codes as module
from tamiz.llm.codes import Bounds, all_distances, next_b, reassigned, root_up, squares, train_codes, with_label_errors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    ints = []
    for i, v, lab in kept:
        w = [math.floor(float(np.float32(x)) * scale) for x in v] + [0] * (width * parts - len(v))
        ints.append((i, [w[p * width : (p + 1) * width] for p in range(parts)], lab))
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[list(w[p]) for _, w, _ in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, w, _ in ints:
                members.setdefault(nearest(p, w[p])[1], []).append(w[p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else b for e, b in enumerate(books[p])]
    out, by_label = [], {}
    for i, w, lab in ints:
        best = [nearest(p, w[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
        by_label[lab] = by_label.get(lab, 0) + out[-1][2]
    text = ",".join(str(x) for book in books for c in book for x in c)
    return sorted([(i, c, e, by_label[lab]) for i, c, e, lab in out], key=repr), hashlib.sha256(text.encode()).hexdigest()


def found(df, **options):
    codes, books = train_codes(df, **options)
    rows = with_label_errors(codes).select("id", "code", "error", "label_error").collect()
    return sorted([tuple(r) for r in rows], key=repr), books.sha256()


def vectors(n, seed, dims=16, close=True):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = []
    for i in range(n):
        base = rnd.choice(centres) if close else [0] * dims
        rows.append((i, [round(b + rnd.gauss(0, 0.3), 2) for b in base], rnd.choice([None, 0, 1, 2])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "seed", "dims"), [(300, 1, 16), (150, 2, 64), (10, 3, 8), (1, 4, 8), (17, 5, 24)])
def test_equals_brute_force(rows, n, seed, dims):
    data = vectors(n, seed, dims)
    assert found(rows(SCHEMA, data, 3)) == brute(data)


def test_ties_go_to_the_lower_entry(rows):
    rnd = random.Random(9)
    data = [(i, [rnd.choice([-1.0, 0.0, 1.0]) for _ in range(16)], i % 3) for i in range(200)]
    assert found(rows(SCHEMA, data, 4), scale=1) == brute(data, scale=1)


def test_odd_rows(rows):
    data = vectors(40, 6) + [
        (100, None, 1),
        (101, [1.0, None] * 8, 1),
        (102, [float("nan")] * 16, 1),
        (103, [float("inf")] * 16, 1),
        (None, [0.5] * 16, None),
        (104, [], 7),
        (105, [1.0] * 3, 7),
        (3, [0.25] * 16, 7),
        (3, [0.25] * 16, 7),
        (2, [-0.0] * 16, None),
    ]
    expected = brute(data)
    assert found(rows(SCHEMA, data, 3)) == expected
    assert found(rows(SCHEMA, data, 1)) == expected


def test_all_equal_rows_and_empty_tables(rows):
    same = [(i, [0.5] * 8, None) for i in range(30)]
    assert found(rows(SCHEMA, same)) == brute(same)
    assert found(rows(SCHEMA, [])) == ([], hashlib.sha256(b"").hexdigest())
    assert found(rows(SCHEMA, [(1, None, 1)])) == ([], hashlib.sha256(b"").hexdigest())
    assert found(rows(SCHEMA, [(1, [], 1), (2, [], 1)]))[0] == [(1, "00" * 8, 0, 0), (2, "00" * 8, 0, 0)]


def test_other_columns_do_not_matter(rows):
    data = vectors(30, 8)
    df = rows("id int, points string, label int, vec_id long, code int, embedding array<float>", [(7, "x", lab, i, 1, v) for i, v, lab in data])
    assert found(df) == brute(data)


def test_numbers_of_32_bits_and_beyond(rows):
    data = [(i, [x * 1000 for x in v], lab) for i, v, lab in vectors(60, 10)]
    assert found(rows(SCHEMA, data)) == brute(data)
    with pytest.raises(ValueError, match="below"):
        train_codes(rows(SCHEMA, [(1, [3e38], 1)]))


def test_many_labels_are_joined_without_broadcast(rows, monkeypatch):
    monkeypatch.setattr(module, "LABELS", 2)
    data = vectors(60, 11)
    assert found(rows(SCHEMA, data)) == brute(data)


def test_codes_decode_to_their_entries(rows):
    codes, books = train_codes(rows(SCHEMA, vectors(50, 12)))
    assert len(books.decode(codes.first()["code"])) == 16


def test_bounds_stay_below_true_distances_over_rounds():
    rnd = np.random.default_rng(0)
    x, part = rnd.integers(-500, 500, (4000, 4)), rnd.integers(0, 2, 4000)
    books, b = rnd.integers(-500, 500, (2, 16, 4)), 4
    bounds, _ = all_distances(x, part, books, b)
    saved = 0
    for step in range(12):
        after = books + rnd.integers(-20, 21, books.shape) // (1 + step // 3)
        bounds = bounds.moved(part, root_up(squares(after, books)))
        if step == 6:
            b = 2
            bounds = bounds.narrowed(b)
        books = after
        bounds, own, reached = reassigned(x, part, books, bounds)
        saved += int((reached <= b).sum())
        true = np.stack([squares(x, books[part, e]) for e in range(16)], axis=1)
        assert (bounds.assigned == true.argmin(axis=1)).all() and (own == true.min(axis=1)).all()
        for j in range(b):
            near = np.take_along_axis(true, bounds.near[:, j : j + 1].astype(int), axis=1)[:, 0]
            assert (bounds.low[:, j] <= np.sqrt(near)).all()
        rest = true.astype(float)
        np.put_along_axis(rest, bounds.near.astype(int), np.inf, axis=1)
        np.put_along_axis(rest, bounds.assigned[:, None].astype(int), np.inf, axis=1)
        assert (bounds.low[:, b] <= np.sqrt(rest.min(axis=1))).all()
    assert saved > 12 * 4000 / 2


def test_b_shrinks_while_few_points_reach_far():
    assert next_b([1000, 0, 0, 0, 0, 0], 16) == 2
    assert next_b([100, 100, 100, 500, 500, 0], 16) == 4
    assert next_b([0, 5], 2) == 0
    assert isinstance(Bounds(np.zeros(1), np.zeros((1, 2)), np.zeros((1, 3))).narrowed(1), Bounds)
