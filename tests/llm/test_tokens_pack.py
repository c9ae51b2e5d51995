"""Token counts against the library; packing against its rules."""

import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tamiz.llm.pack import best_fit, cut, fewest, improve, pack, pack_documents
from tamiz.llm.tokens import Library, chunk_counts, count_tokens, frequent_lengths, ids, lengths

DOCS = "doc_id long, text string"
FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
LIBRARY = {f: Library(public_tokenizers.path(f)) for f in FILES}
TEXTS = [
    "It's a test, isn't it?  Yes!!\n\nNo end \t x", "<|endoftext|> a <|startoftext|>", "日本語 ΣΑΣ İx", "a\x1cb \x85 c", "",
    " ", "   lead", "trail   ", "''s '' 'S I'LL", "½²³ ºª µß ÿ × ÷", "x" * 5000, "ab " * 3000, "é" + "é", "​", "😀 ok",
]


@pytest.mark.parametrize("file", FILES)
@given(st.text(alphabet="ab É'stmdrelv\n\t\r\x85\xa09½!?$\x1d日<|>", max_size=40) | st.text(max_size=30) | st.text("aé ́ΣσI İ日—’\u2003\u3000😀\n", max_size=30))
@settings(max_examples=700, deadline=None)
def test_any_text_equals_the_library(file, text):
    library = LIBRARY[file]
    want = library.ids(text)
    assert sum(lengths(library).values_of(text)) == len(want)
    assert b"".join(ids(library).values_of(text)) == pack(want)


def test_texts_of_any_script_are_looked_up():
    """The library encodes no text whole, and a chunk that comes again is not cut again."""
    library = Library(public_tokenizers.path(FILES[0]))
    text = "Съешь ещё этих мягких — “французских” булок, да 日本語 выпей же чаю’ " * 50
    want, calls = len(library.ids(text)), []
    library.ids, cut_wide = None, library.wide_words
    library.wide_words = lambda chunk: calls.append(chunk) or cut_wide(chunk)
    table = lengths(library)
    assert sum(table.values_of(text)) == want and sum(table.values_of(text)) == want
    assert len(calls) == len(set(calls)) <= 14


def test_frequent_chunks_are_counted_over_all_texts(spark):
    rows = [(i, "Alpha alpha beta " + ("日本 日本" if i % 2 else "")) for i in range(40)] + [(50, None), (51, "gamma \x1d beta")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    path = public_tokenizers.path(FILES[0])
    found = {r["chunk"]: r["n"] for r in chunk_counts(df, "text", path).collect()}
    assert found == {"alpha": 80, "beta": 40, "日本": 40}
    top = frequent_lengths(df, "text", path, 2)
    assert set(top) == {b"alpha", b"beta"} and top[b"beta"] == len(LIBRARY[FILES[0]].ids("beta"))


def test_counts(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (1, TEXTS[1]), (None, "a b")]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", n_tokens int").repartition(2)
    found = count_tokens(df, public_tokenizers.path(FILES[0]), frequent=5)
    plain = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    want = [(d, len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert count_tokens(df.limit(0), public_tokenizers.path(FILES[0])).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_everything_once(seed):
    rng = random.Random(seed)
    capacity = 100
    sizes = [rng.randint(1, 99) if seed % 2 else rng.randint(20, 55) for _ in range(400)]
    first = best_fit(sizes, capacity)
    bins = improve(first, sizes, capacity)
    assert sorted(i for b in bins for i in b) == list(range(400))
    assert all(sum(sizes[i] for i in b) <= capacity for b in bins)
    assert fewest(sizes, capacity) <= len(bins) <= len(first)


def test_search_empties_bins_that_best_fit_leaves():
    rng = random.Random(5)
    sizes = [rng.randint(500, 1100) for _ in range(800)]
    first = best_fit(sizes, 2048)
    bins = improve(first, sizes, 2048)
    assert fewest(sizes, 2048) <= len(bins) < len(first)
    assert sorted(i for b in bins for i in b) == list(range(800)) and all(sum(sizes[i] for i in b) <= 2048 for b in bins)


def test_cut():
    assert cut(5, 2) == [(0, 1), (1, 2), (3, 2)] and cut(4, 2) == [(0, 2), (2, 2)] and cut(1, 2) == [(0, 1)]


def test_packing(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["alpha", "beta,", "gamma", "x"], k=rng.randint(0, 90)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "long text " * 200), (5, rows[5][1]), (None, "no key")]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    path, capacity = public_tokenizers.path(FILES[1]), 64
    plain = Tokenizer.from_file(path)
    want = defaultdict(int)
    for doc, t in rows:
        own = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for i, (start, n) in enumerate(cut(len(own), capacity)):
            part = b"".join(x.to_bytes(4, "little") for x in own[start : start + n])
            want[doc, i, start, n, zlib.crc32(part)] += 1
    for shard_rows in (10**6, 20):
        found = pack_documents(df, path, capacity, shard_rows=shard_rows).collect()
        got, places = defaultdict(int), defaultdict(list)
        for r in found:
            got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
            places[r["sequence_id"]].append((r["offset"], r["length"]))
        assert got == want
        for own in places.values():
            at = 0
            for offset, n in sorted(own):
                assert offset == at
                at += n
            assert at <= capacity
        least = -(-sum(n for (_, _, _, n, _), c in want.items() for _ in range(c)) // capacity)
        assert len(places) <= least * 1.1 + 1
    assert pack_documents(df.limit(0), path, capacity).collect() == []


@pytest.mark.parametrize(
    ("kind", "keys"), [("long", [9007199254740993, (1 << 60) + 3, None, 5]), ("string", ["a", "ä", None, ""])]
)
def test_keys_come_back_as_they_are(spark, kind, keys):
    df = spark.createDataFrame([(k, "some words " * 40) for k in keys], f"doc_id {kind}, text string").repartition(2)
    for shard_rows in (10**6, 1):
        found = pack_documents(df, public_tokenizers.path(FILES[1]), 64, shard_rows=shard_rows)
        assert {r["doc_id"] for r in found.collect()} == set(keys)
        assert dict(found.dtypes)["doc_id"] == {"long": "bigint"}.get(kind, kind)
