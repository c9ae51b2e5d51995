"""Restoring disguised words, and scores on held-out rows."""

import math
import os
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tamiz.llm.toxicity as module
from tamiz.llm.common import table
from tamiz.llm.toxicity import (
    DOUBLED,
    ORDER,
    REPEATED_MARK,
    CharacterModel,
    Restorer,
    asked_grams,
    count_grams,
    decode,
    features,
    fit_toxicity,
    held_out,
    lattice,
    read_tokens,
    survey,
    toxicity,
    with_toxicity,
)

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"
BAD = ["idiot", "moron", "trash", "stupid"]
GOOD = "the house stands near a river and many people walk there every morning with dogs or alone for hours".split()


def plain_grams(words):
    """Counts by definition: each word between two blanks, the first of which begins it."""
    out = Counter()
    for w, n in words.items():
        text = f" {w} "
        for order in range(1, ORDER + 1):
            for i in range(len(text) - order + 1):
                if order > 1 or i:
                    out[text[i : i + order]] += n
    return out


def model_of(texts):
    words = Counter()
    for t in texts:
        for piece, spaced in Restorer.pieces(t):
            if spaced is None:
                words.update(module.WORD.findall(piece))
    counts = plain_grams(words)
    return CharacterModel(counts, sum(n for g, n in counts.items() if len(g) == 1))


class Decoded:
    """Every token decoded when it is asked for."""

    def __init__(self, model):
        self.model = model

    def get(self, key, default=None):
        return module.WORD.findall(decode(key[0], self.model, key[1]))


MODEL = model_of([" ".join(BAD * 3 + GOOD * 5)])


def best_by_listing(token, model, spaced):
    """Every reading of the lattice, scored whole."""
    readings = [("", 0.0)]
    for slot in lattice(token, spaced):
        readings = [(text + s, cost + c) for text, cost in readings for s, c in slot]

    def total(reading):
        text, cost = reading
        context = " "
        for c in text + " ":
            cost += model.log(context, c)
            context = (context + c)[1 - ORDER :]
        return cost

    best = max(map(total, readings))
    return {text for text, cost in readings if abs(total((text, cost)) - best) < 1e-9}


@pytest.mark.parametrize("token", ["1d10t", "m0r0n", "tr@sh", "$tup1d", "stuuuupid", "7h3", "!d!0t", "a1b2c3"])
def test_viterbi_finds_the_best_reading(token):
    assert decode(token, MODEL) in best_by_listing(token, MODEL, False)


def test_restored_words():
    words = Restorer(Decoded(MODEL)).words
    assert words("You 1D10T, m0r0n! tr@sh") == ["you", "idiot", "moron", "trash"]
    assert words("s t u p i d house") == ["stupid", "house"] and words("t.r.a.s.h") == ["trash"]
    assert words("stuuuupid") == ["stupid"]
    assert words("House!!! near%%% river*** 2024 4.0") == ["house", "near", "river"]
    assert words("") == [] and words(None) == [] and words("😀 \U0001f600a") == ["a"]
    assert len(words("word " * 50_000)) == 50_000


def collection(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = rng.choices(GOOD, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            for w in rng.choices(BAD, k=3):
                text.insert(rng.randrange(len(text)), w.replace("o", "0") if i % 12 == 0 else w)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_rows_are_told_apart(spark):
    docs, labels = collection(900)
    rows = docs + [(5000, None), (5001, ""), (None, "m0r0n trash idiot"), (3, docs[3][1])]
    df = spark.createDataFrame([(*r, "z") for r in rows], DOCS + ", toxicity string").repartition(4)
    known = spark.createDataFrame([*labels, (None, 1, 1), (7, 1, None), (8, 0, 0)], LABELS)
    out, score = toxicity(df, known)
    assert score == "toxicity_" and out.columns == [*df.columns, score]
    truth = {d: t for d, _, t in labels}
    got = [(r["doc_id"], r[score], r["h"]) for r in out.withColumn("h", held_out(F.col("doc_id"))).collect()]
    assert sum(h for *_, h in got) > 100
    assert all((s >= 0.5) == truth[d] for d, s, _ in got if d in truth)
    by_id = {d: s for d, s, _ in got}
    assert by_id[5000] == by_id[5001] < 0.5 <= by_id[None]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a house"), (2, None)], DOCS)
    none = spark.createDataFrame([], LABELS)
    for labels in (none, spark.createDataFrame([(1, 1, 0)], LABELS)):
        out, score = toxicity(docs, labels)
        assert all(0 <= r[score] < 0.5 for r in out.collect())
    empty = docs.limit(0)
    out, score = toxicity(empty, none)
    assert out.collect() == []


def words_in(text):
    """(word, readable token or None) in order."""
    for piece, spaced in Restorer.pieces(text):
        if spaced is not None:
            yield (piece, spaced)
        else:
            yield from ((w, False) if DOUBLED.search(w) else w for w in module.WORD.findall(piece))


def plain_scores(docs, model):
    """Scores by definition, in one process: counts, a reading for each token, evidence."""
    words = Counter()
    for t in docs:
        for piece, spaced in Restorer.pieces(t):
            if spaced is None:
                words.update(module.WORD.findall(piece))
    counts = plain_grams(words)
    characters = CharacterModel(counts, sum(n for g, n in counts.items() if len(g) == 1))
    out = []
    for t in docs:
        read = []
        for w in words_in(t):
            read += [w] if isinstance(w, str) else module.WORD.findall(decode(w[0], characters, w[1]))
        often = Counter(f for w in read for f in features(w))
        evidence = 0.0
        for w in set(read):
            own = [model.lexicon.get(f, 0.0) for f in features(w)]
            own += [model.lexicon.get(f + REPEATED_MARK, 0.0) for f in features(w) if often[f] > 1]
            evidence += max(own)
        out.append(1 / (1 + math.exp(-(model.base + model.slope * evidence))))
    return out


@pytest.mark.parametrize("most", [500_000, 3])
def test_scores_equal_a_plain_version(spark, monkeypatch, most):
    monkeypatch.setattr(module._with_evidence, "__defaults__", (most,))
    docs, labels = collection(700, 3)
    docs += [(9000, "stuuupid m 0 r 0 n, tr@sh! idi0t"), (9001, "Ünïcode ünïcode 😀😀 \U00010428\U00010428bb"), (9002, None)]
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    readings = read_tokens(survey(df), block=5)
    model = fit_toxicity(df, spark.createDataFrame(labels, LABELS), readings)
    assert any(f.endswith(REPEATED_MARK) for f in model.lexicon)
    out, score = with_toxicity(df, model, readings)
    got = {r["doc_id"]: r[score] for r in out.collect()}
    want = plain_scores([t for _, t in docs], model)
    assert got == pytest.approx({d: w for (d, _), w in zip(docs, want)}, abs=1e-6)


def test_counts_cover_all_texts(spark):
    texts = ["abc Abc", "äa 12 öo h0use", None, "", "abba 漢字", "x" * 3]
    corpus = survey(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(2))
    want = plain_grams(Counter(["abc", "abc", "äa", "öo", "abba", "漢字", "xxx"]))
    assert {r["gram"]: r["n"] for r in corpus.grams.collect()} == want
    assert corpus.total == sum(n for g, n in want.items() if len(g) == 1)
    assert {tuple(r) for r in corpus.tokens.collect()} == {("h0use", False), ("abba", False), ("xxx", False)}


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abç漢\U00010428", min_size=1, max_size=7), st.integers(1, 9), max_size=9))
def test_grams_are_counted_exactly(words):
    assert count_grams(words) == count_grams(words, 2) == plain_grams(words)


@settings(max_examples=60, deadline=None)
@given(st.text("ab1@ *.", min_size=1, max_size=9), st.booleans())
def test_a_block_asks_for_every_count_that_decoding_looks_up(token, spaced):
    seen = set()

    class Spy(dict):
        def get(self, key, default=None):
            seen.add(key)
            return 3

    decode(token, CharacterModel(Spy(), 10), spaced)
    assert seen <= asked_grams(token, spaced)


LARGER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="test tables are not here")
def test_held_out_rows_of_every_language(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    scored, score = toxicity(docs.select("doc_id", "text", "lang"), labels)
    known = scored.join(labels, "doc_id").where(held_out(F.col("doc_id")))
    counts = known.groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.count_if(F.col(score) >= 0.5).alias("taken"))
    found = {(r["lang"], r["toxic"]): (r["taken"], r["n"]) for r in counts.collect()}
    caught, toxic = (sum(v[i] for (_, t), v in found.items() if t) for i in (0, 1))
    wrong, clean = (sum(v[i] for (_, t), v in found.items() if not t) for i in (0, 1))
    assert caught >= 0.9 * toxic and wrong <= 0.01 * clean, found
    assert all(a >= 0.8 * n for (_, t), (a, n) in found.items() if t), found


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("hell0 there", ["hello", "there"]),
        ("garbag3!", ["garbage"]),
        ("idi07", ["idiot"]),
        ("you a55", ["you", "ass"]),
        ("dumb@$$!!", ["dumbass"]),
        ("stuupid, iidioott", ["stupid", "idiot"]),
        ("t r @ s h", ["trash"]),
        ("$ t u p i d house", ["stupid", "house"]),
        ("s t u p i d! s t u p i d !", ["stupid", "stupid"]),
        ("hello all good dogs", ["hello", "all", "good", "dogs"]),
        ("2024 $5 100% no!!! *** a", ["no", "a"]),
    ],
)
def test_every_token_of_several_readings_is_decoded(text, want):
    model = model_of([" ".join([*BAD * 3, *["garbage", "ass", "dumbass", "hello", "all", "good", "dogs", "no"] * 3, *GOOD * 5])])
    assert Restorer(Decoded(model)).words(text) == want


def test_many_disguised_tokens_take_time_by_their_number():
    words = Restorer(Decoded(MODEL)).words("m0r0n t r @ s h, " * 20_000)
    assert words == ["moron", "trash"] * 20_000


def test_one_table_tells_the_kinds_of_all_characters():
    from tamiz.llm import toxicity as t

    for i in [*range(0x3000), 0xD800, 0x10FFFF]:
        c, kind = chr(i), int(t.KIND[i])
        alnum, sign = c.isalnum(), c in t.LOOKALIKES
        assert bool(kind & t.IS_LETTER) == (alnum and c.isalpha()) and bool(kind & t.IS_ALNUM) == alnum
        assert bool(kind & t.IS_SIGN) == sign and bool(kind & t.IS_OTHER) == ((alnum or c == "_") and not sign)
        assert bool(kind & t.IS_MEMBER) == (alnum or c in t.TOKEN_SIGNS)
        assert bool(kind & t.IS_LAST) == (alnum or c in t.LETTER_SIGNS)
    parts = list(Restorer.parts("so b4d! __ s.t.u.p.i.d 1984 a_1_b and x$"))
    assert parts == [(["so", "and"], [("b4d", False), ("s.t.u.p.i.d", True), ("a_1_b", True), ("x$", False)])]
