"""SimHash groups against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from tamiz.llm.components import components
from tamiz.llm.simhash import build_tree, fingerprint, keep_one, near_duplicates, route, spanning_links

DOCS = "doc_id long, text string"


def print_of(text, n=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in lines]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, radius=2):
    prints = [print_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def collection(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcDEé") for _ in range(rng.randint(1, 6))) for _ in range(50)]
    rows = []
    for i in range(40):
        text = rng.choices(words, k=rng.randint(1, 120))
        rows.append((i, " ".join(text)))
        for _ in range(rng.choice([0, 0, 1, 4])):
            text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((1000 - len(rows), "\t".join(text)))
    rows += [(2000, ""), (2001, None), (2002, " \n"), (2003, "one"), (2004, "ONE"), (None, rows[0][1]), (None, "alone here now ok"), rows[3]]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_all_pairs(spark, seed):
    rows = collection(seed)
    found = near_duplicates(spark.createDataFrame(rows, DOCS).repartition(3))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(groups(rows), key=repr)


def test_fingerprint_of_long_text():
    text = " ".join(str(i % 977) for i in range(70_000))
    words = text.split()
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)], dtype=np.uint64)
    bits = [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
    assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * bits[b] > len(hashes))


def points_of(seed):
    """Random points, and a dense ball that no cut divides."""
    rng = random.Random(seed)
    out = set()
    for _ in range(150):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            out.add(x ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 3))}))
    ball = rng.getrandbits(64)
    out |= {ball ^ sum({1 << rng.randrange(14) for _ in range(rng.randint(0, 7))}) for _ in range(1500)}
    return np.array(sorted(out), dtype=np.uint64)


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_lose_no_pair(seed):
    points = points_of(seed)
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 2
    label = np.arange(len(points))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    a, b = spanning_links(points, 2)
    found = dict(zip(a.tolist(), b.tolist(), strict=True))
    assert {int(p): found.get(int(p), int(p)) for p in points} == {int(p): int(points[i]) for p, i in zip(points, label, strict=True)}
    tree = build_tree(points[::4], 60, 2)
    together = np.zeros_like(near)
    for _, rows in route(tree, points, 2):
        together[np.ix_(rows, rows)] = True
    assert (together | ~near).all()


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    root = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_one_row_of_each_group_stays(spark):
    rows = collection(3)
    df = spark.createDataFrame([(*r, i % 2, "x") for i, r in enumerate(rows)], DOCS + ", fp int, row_hash string")
    df = df.unionByName(df.limit(1))
    kept = keep_one(df.repartition(2))
    assert kept.columns == df.columns
    by_group = groups(rows)
    got = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    want = {c for _, _, c in by_group if c is not None}
    # A group without any id keeps one row too.
    lonely = {p for _, p, c in by_group if c is None}
    assert sorted((d for d in got if d is not None)) == sorted(want) and got.count(None) == len(lonely)


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert near_duplicates(none).collect() == [] and keep_one(none).collect() == []
