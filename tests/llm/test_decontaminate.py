"""Decontamination against a plain search of every window."""

import random
import re

import pytest

from tamiz.llm.decontaminate import decontaminate, drop_contaminated

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window):
    patterns = []
    for item, text in items:
        w = WORD.findall((text or "").translate(UPPER))
        n = min(window, len(w))
        patterns += [("" if item is None else str(item), w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        found = [m for m in WORD.finditer((text or "").translate(UPPER))]
        w, hit, ids = [m.group() for m in found], set(), set()
        for item, p in patterns:
            for i in range(len(w) - len(p) + 1):
                if w[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    ids.add(item)
        spans = []
        for i in sorted(hit):
            if i - 1 in hit:
                spans[-1] = (spans[-1][0], found[i].end())
            else:
                spans.append(found[i].span())
        out.append((doc, len(w), len(hit), tuple(sorted(ids)), tuple(spans)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(
        ((r[0], r[1], r[2], tuple(r[3]), tuple((s[0], s[1]) for s in r[4])) for r in df.collect()), key=repr
    )


def collection(seed):
    rng = random.Random(seed)
    words = ["Ab", "ä", "x9", "日本", "the", "of", "É", "zz"]

    def line(n):
        return "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", " -- ", "\x00"]) for _ in range(n))

    items = [(i, line(rng.choice([1, 3, 6, 9]))) for i in range(12)] + [(3, "the of"), (None, "zz zz zz zz"), (99, ""), (98, None)]
    docs = [(i, line(rng.randint(0, 40))) for i in range(60)]
    docs += [(7, "ab ab"), (7, "ab ab"), (None, items[4][1]), (200, None), (201, ""), (202, items[5][1] * 200)]
    return docs, items


@pytest.mark.parametrize(("seed", "slice_bytes"), [(1, 1 << 20), (2, 1 << 20), (3, 40)])
def test_equals_brute_force(spark, seed, slice_bytes):
    docs, items = collection(seed)
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    found = decontaminate(df, spark.createDataFrame(items, ITEMS), window=4, slice_bytes=slice_bytes)
    assert rows_of(found) == brute(docs, items, 4)


def test_empty_tables_and_clashing_columns(spark):
    none = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([(1, "one two three")], ITEMS)
    assert decontaminate(none, items).collect() == []
    docs = spark.createDataFrame([(1, "say one two three", 5, "x"), (2, "two", 6, "y")], "doc_id long, text string, hits int, n_hit string")
    assert [r["n_hit"] for r in decontaminate(docs, items).orderBy("doc_id").collect()] == [3, 0]
    assert rows_of(decontaminate(docs, spark.createDataFrame([], ITEMS)))[0][2] == 0
    kept = drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "two", 6, "y")]
