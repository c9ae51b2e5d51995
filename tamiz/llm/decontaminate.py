"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

A letter of the automaton is a whole word: each distinct word of the benchmark has a code point, every
other word shares one that no pattern holds. A pattern is a window of consecutive words of an item. A text is
normalised once, read once by the automaton, and word positions of the matches are mapped back to
character offsets of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, total_bytes, unused, utf8
from tamiz.session import materialise

# One byte to one byte, so that offsets stay: A-Z to a-z; ASCII that is neither letter nor digit to a blank.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# Letters 2 to 0x10FFFF without the surrogates; 1 stands for a word of no item.
FOREIGN, FIRST_LETTER, SURROGATES, AFTER_SURROGATES = chr(1), 2, 0xD800, 0xE000
# Benchmark text of one automaton. Its distinct words are far fewer than there are letters.
SLICE_BYTES = 4 << 20

PARTIAL = "struct<item_ids:array<string>,runs:array<struct<start:int,end:int>>>"
RESULT = "struct<n_words:long,n_hit:long,item_ids:array<string>,spans:array<struct<start:int,end:int>>>"


def words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(NORMAL).split()


class Matcher:
    """The automaton of some items: (item id, text) pairs."""

    def __init__(self, items: Iterable[tuple[str, bytes | None]], window: int) -> None:
        letters: dict[bytes, str] = {}
        holders: dict[str, set[str]] = {}
        for item, text in items:
            codes = []
            for w in words(text):
                if w not in letters:
                    n = len(letters) + FIRST_LETTER
                    letters[w] = chr(n if n < SURROGATES else n - SURROGATES + AFTER_SURROGATES)
                codes.append(letters[w])
            line = "".join(codes)
            for i in range(max(1, len(line) - window + 1) if line else 0):
                holders.setdefault(line[i : i + window], set()).add(item)
        self.letters = letters
        self.automaton = ahocorasick.Automaton()
        for pattern, items_of in holders.items():
            self.automaton.add_word(pattern, (len(pattern), items_of))
        if holders:
            self.automaton.make_automaton()
        self.empty = not holders

    def find(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs [start, end) of hit words, and the items with an occurring window."""
        if self.empty or not text_words:
            return [], set()
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        line = "".join(map(self.letters.get, text_words, repeat(FOREIGN)))
        for last, (length, holders) in self.automaton.iter(line):
            items |= holders
            runs.append((last + 1 - length, last + 1))
        return union(runs), items


def union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching runs joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def offsets(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as runs of characters of the original text."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(NORMAL))]
    out, byte, char = [], 0, 0
    for start, end in runs:
        pair = []
        for b in (at[start][0], at[end - 1][1]):
            char += len(text[byte:b].decode())
            byte = b
            pair.append(char)
        out.append((pair[0], pair[1]))
    return out


def benchmark_slices(
    benchmark: DataFrame, item: str, text: str, slice_bytes: int
) -> Iterator[list[tuple[str, bytes | None]]]:
    """The items in slices of about ``slice_bytes`` each (one item at least); one slice is on the driver at a time."""
    n = max(1, -(-total_bytes(benchmark, text) // slice_bytes))
    rows = benchmark.select(
        F.coalesce(quoted(item).cast("string"), F.lit("")).alias("item"), quoted(text).cast("binary").alias("text")
    )
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield [(r["item"], None if r["text"] is None else bytes(r["text"])) for r in part.toLocalIterator()]


def _annotated(
    docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, window: int, slice_bytes: int
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, of type RESULT, and its name."""
    df, parts = docs, []
    slices = benchmark_slices(benchmark, item, item_text, slice_bytes)
    items = next(slices)
    for following in slices:
        parts.append(unused(df.columns, "hits"))
        df = materialise(append(df, [text], lambda items=items: _partial(Matcher(items, window)), PARTIAL, parts[-1]), "hits")
        items = following
    name = unused(df.columns, "hits")
    df = append(df, [text, *parts], lambda: _complete(Matcher(items, window)), RESULT, name)
    return df.drop(*parts), name


def _partial(matcher: Matcher):
    def step(texts: pa.Array) -> list:
        found = (matcher.find(words(t)) for t in utf8(texts))
        return [(sorted(items), runs) for runs, items in found]

    return step


def _complete(matcher: Matcher):
    def step(texts: pa.Array, *parts: pa.Array) -> list:
        out = []
        for t, *earlier in zip(utf8(texts), *[p.to_pylist() for p in parts], strict=True):
            text_words = words(t)
            runs, items = matcher.find(text_words)
            for part in earlier:
                items.update(part["item_ids"])
                runs = union(runs + [(r["start"], r["end"]) for r in part["runs"]])
            spans = offsets(t, runs) if runs else []
            out.append((len(text_words), sum(b - a for a, b in runs), sorted(items), spans))
        return out

    return step


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit (words inside an occurrence of a window), item_ids (sorted, items
    with occurring windows) and spans (character offsets [start, end) of the maximal hit runs).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    A NULL or empty text has no words and no hits; a NULL item id counts as the empty string. Repeated rows give
    repeated results, columns of other names are ignored, an empty benchmark hits nothing. A benchmark above
    ``slice_bytes`` is applied slice by slice, each pass stored, so that memory stays bounded; the runs of all
    slices are united.
    """
    df, hits = _annotated(docs.select(quoted(key), quoted(text)), benchmark, text, item, item_text, window, slice_bytes)
    return df.select(quoted(key), f"`{hits}`.*")


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark."""
    df, hits = _annotated(docs, benchmark, text, item, item_text, window, slice_bytes)
    return df.where(F.col(f"`{hits}`.n_hit") == 0).drop(hits)
