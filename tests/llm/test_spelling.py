import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tamiz.llm import spelling
from tamiz.llm.common import table
from tamiz.llm.spelling import KdTree, near_words, neighbours, one_edit, spelling_groups, with_roots, within

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def counts(docs, slip_every=0, min_letters=5, min_count=3):
    out = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(ASCII)
            if slip_every:
                h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
                if h % slip_every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            if len(word) >= min_letters:
                out[word] += 1
    return {w: n for w, n in out.items() if n >= min_count}


def brute(words):
    """Near words by deletions: two words are near if they share one in the right way."""
    shapes = defaultdict(set)
    for w in words:
        shapes[w].add(w)
        for i in range(len(w)):
            shapes[w[:i] + w[i + 1 :]].add(w)
    near = {w: set() for w in words}
    for group in shapes.values():
        for a in group:
            near[a] |= {b for b in group if edit(a, b)}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda u: (-words[u], u), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return sorted(out, key=repr)


def edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def found(df, **options):
    return sorted([tuple(r) for r in spelling_groups(df, **options).collect()], key=repr)


def vocabulary(n, seed, letters="abé", low=5, high=7):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in range(n)]


def documents(words, seed=0):
    rnd = random.Random(seed)
    often = [rnd.random() ** -0.7 for _ in words]  # a few words are frequent
    return [(i, " ".join(rnd.choices(words, often, k=300)) + ".") for i in range(40)]


@pytest.mark.parametrize("options", [{}, {"sample": 20, "cell": 8, "task": 5}, {"sample": 1, "cell": 1, "task": 1000}])
def test_equals_brute_force(rows, options):
    docs = documents(vocabulary(300, 1))
    expected = brute(counts(docs))
    assert any(r[1] for r in expected) and any(r[2] != (r[1] or r[0]) for r in expected)
    assert found(rows(SCHEMA, docs, 3), **options) == expected


def test_letters_slip(rows):
    docs = documents(vocabulary(200, 2))
    assert found(rows(SCHEMA, docs, 2), slip_every=7) == brute(counts(docs, 7))


def test_the_table_of_the_smallest_scale(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    assert found(table(spark, folder, "documents"), slip_every=97) == brute(counts(docs, 97))


def test_odd_rows(rows):
    long = "z" * 400 + "y" * 70_000
    docs = [
        (None, "Straße STRASSE straßé"),
        (None, "straße Straße"),
        (1, None),
        (2, ""),
        (3, "straße, strasse; strasse strasse"),
        (3, "don't 4ever ×÷×÷× ×÷×÷× ×÷×÷×"),
        (4, "Éclair éclair éclair éclair Éclair Éclair"),
        (5, f"{long} {long} {long} {long}x {long}x {long}x"),
        (5, f"{long[1:]} {long[1:]} {long[1:]} x{long[2:]} x{long[2:]} x{long[2:]}"),
        (6, "abcd abcd abcd abcde abcde"),
    ]
    expected = brute_long(counts(docs))
    assert found(rows(SCHEMA, docs, 3)) == expected
    assert found(rows(SCHEMA, [])) == []
    assert found(rows(SCHEMA, [(1, None)])) == []


def brute_long(words):
    """As ``brute``, by pairs."""
    near = {w: {u for u in words if edit_fast(w, u)} for w in words}
    forms = {w: min(near[w], key=lambda u: (-words[u], u), default=None) for w in words}
    forms = {w: f if f and words[f] >= 2 * words[w] else None for w, f in forms.items()}
    return sorted([(w, forms[w], forms[w] or w, n, len(near[w]), words.get(forms[w])) for w, n in words.items()], key=repr)


def edit_fast(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def test_other_columns_do_not_matter(rows):
    docs = documents(vocabulary(60, 3))
    df = rows("word int, n int, key int, doc_id long, form int, text string", [(1, 2, 3, i, 4, t) for i, t in docs])
    assert found(df) == brute(counts(docs))


def test_ties_go_to_the_first_word(rows):
    docs = [(1, "aaaab " * 6 + "aaaac " * 6 + "aaaad " * 3)]
    assert found(rows(SCHEMA, docs)) == brute(counts(docs))
    assert ("aaaad", "aaaab", "aaaab", 3, 2, 6) in found(rows(SCHEMA, docs))


def test_many_words_of_the_same_letters_are_looked_up_not_compared():
    rnd = random.Random(5)
    words = {"".join(rnd.sample("abcdefghij", 10)): i for i in range(4000)}
    changed = {w.replace("a", "k", 1): 1 for w in words}
    out = near_words(words, {0: list(changed)})
    assert {w: r[:1] for w, r in out.items()} == dict.fromkeys(changed, (1,))


@settings(max_examples=200, deadline=None)
@given(st.text("abé", min_size=1, max_size=7), st.text("abé", min_size=1, max_size=7))
def test_one_edit(a, b):
    assert one_edit(a, b) == edit(a, b)


def test_long_words_are_compared_directly(monkeypatch):
    words = {w: i for i, w in enumerate(set(vocabulary(200, 6)))}
    asked = sorted(words)

    def all_found():
        out = {}
        for n in {len(w) for w in words}:
            points = {w: i for w, i in words.items() if len(w) == n}
            asking = {s: [w for w in asked if len(w) == n - s] for s in (-1, 0, 1)}
            for w, (k, best, form) in near_words(points, asking).items():
                before, top = out.get(w, (0, (-1, "")))
                out[w] = before + k, max((best, form), top)
        return out

    short = all_found()
    monkeypatch.setattr(spelling, "LONG", 2)
    assert all_found() == short and short
    assert neighbours("abcab", {"abcac": 1, "caabc": 2}, "c", "b") == ["abcac"]


def test_search_finds_all_and_visits_few(rows):
    rnd = np.random.default_rng(1)
    points = np.unique(rnd.integers(0, 3, (3000, 20)).astype(np.int16), axis=0)
    tree = KdTree(points, 8)
    queries = points[:200].copy()
    queries[:, 3] += 1
    got = {(int(p), int(q)) for ps, qs, _, _ in within(tree, points, queries, 1, 1) for p, q in zip(ps, qs)}
    d = points[None].astype(int) - queries[:, None]
    q, p = np.nonzero((np.maximum(d, 0).sum(2) == 1) & (np.maximum(-d, 0).sum(2) == 1))
    assert got == set(zip(p.tolist(), q.tolist()))
    leaves = sum(m is not None for m in tree.members)
    assert sum(len(r) for _, r in tree.reach(queries, 1, 1)) < 0.25 * leaves * len(queries)


def test_a_point_has_one_region():
    points = np.random.default_rng(2).integers(0, 3, (500, 6)).astype(np.int16)
    tree = KdTree(points[:100], 4, regions=True)
    seen = np.concatenate([rows for _, rows in tree.reach(points, 0, 0)])
    assert sorted(seen.tolist()) == list(range(500))


def test_roots_of_long_chains(rows):
    links = rows("word string, form string", [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w3")])
    out = dict(tuple(r) for r in with_roots(links).collect())
    assert set(out.values()) == {"w37"} and len(out) == 38


def test_ratio_below_two_could_go_in_circles(rows):
    with pytest.raises(ValueError, match="ratio"):
        spelling_groups(rows(SCHEMA, []), ratio=1)
