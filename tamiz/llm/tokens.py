"""Token counts and ids with a two-tier map-side lookup, equal to the tokenizers library.

A text is cut at blanks into chunks, and a chunk into pre-tokens: by a byte pattern where it has Latin-1 characters
only, else by the library's own rules. A chunk or pre-token is looked up, first in a compact table of frequent ones
that every task gets, counted over all texts, then in caches of the worker, which ask the library for what they miss.
No pre-token is shuffled but for the count, where equal ones of a task are one. Only a text with a control character or
a special string goes to the library whole. The vocabularies encode pre-tokens independently of each other, and no
pre-token reaches over a single blank, so sums and joins are exact.
"""

from __future__ import annotations

import os
import re
import struct
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, unused

# Pre-tokens of the first tier, entries of a worker's cache, and different chunks that a task counts at a time.
FREQUENT, CACHE, COUNTED = 1 << 15, 1 << 19, 1 << 18

# Latin-1 characters by kind, as the tokenizers' patterns see them.
LETTERS = rb"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBERS = rb"0-9\xb2\xb3\xb9\xbc-\xbe"
BLANKS = rb"\t-\r \x85\xa0"
CONTROL, WIDE_CONTROL = re.compile(rb"[\x1c-\x1f]"), re.compile("[\x1c-\x1f]")
LOWER = bytes(ord(chr(b).lower()) if len(chr(b).lower()) == 1 and ord(chr(b).lower()) < 256 else b for b in range(256))

# The pre-token patterns of the two public tokenizers. Alternatives of different first characters are
# reordered: the frequent ones come first.
LOWER_CASED = re.compile(
    rb"[" + LETTERS + rb"]+|'(?:[stmd]|re|ve|ll)|[" + NUMBERS + rb"]|[^" + BLANKS + LETTERS + NUMBERS + rb"]+"
)
WITH_BLANKS = re.compile(
    rb" ?[" + LETTERS + rb"]+|'(?:[stmd]|re|ve|ll)| ?[" + NUMBERS + rb"]+| ?[^" + BLANKS + LETTERS + NUMBERS
    + rb"]+|[" + BLANKS + rb"]+(?![^" + BLANKS + rb"])|[" + BLANKS + rb"]+"
)
BLANK_BYTES = b"\t\n\x0b\x0c\r \x85\xa0"


class Library:
    """A tokenizer file with what is needed to cut texts as it does."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        lower = self.tokenizer.normalizer is not None
        self.pattern = LOWER_CASED if lower else WITH_BLANKS
        self.lower = lower
        self.special = re.compile(
            b"|".join(re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()) or b"(?!)"
        )

    def plain(self, text: str) -> bytes | None:
        """The text as the pattern takes it; None if it is to be encoded whole."""
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if CONTROL.search(plain) or self.special.search(plain):
            return None
        return plain.translate(LOWER) if self.lower else plain

    def wide(self, text: str) -> str | None:
        """A text with other characters as the library normalises it; None if it is to be encoded whole."""
        if WIDE_CONTROL.search(text) or self.special.search(text.encode("utf-8", "surrogatepass")):
            return None
        return self.tokenizer.normalizer.normalize_str(text) if self.lower else text

    def wide_words(self, text: str) -> bytes:
        """Ids of a normalised text, cut by the library's own rules."""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return b"".join([pack([t.id for t in self.tokenizer.model.tokenize(p)]) for p, _ in pieces])

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def _byte_letters() -> list[str]:
    """The letter of each byte in a byte-level vocabulary: visible bytes stand for themselves, the others follow
    in order behind the 256th character."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
# The letters of each Latin-1 character.
LETTERS_OF = ["".join([BYTE_LETTERS[b] for b in chr(i).encode()]) for i in range(256)]


class _Blanks(Exception):
    """Blanks stand together, so that a pre-token may hold more than one."""


class PreTokens(dict):
    """A worker's cache: pre-token to its ids, little-endian unsigned 32-bit numbers."""

    def __init__(self, library: Library) -> None:
        super().__init__()
        self.library = library

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        letters = "".join(map(LETTERS_OF.__getitem__, word))
        self[word] = packed = pack([t.id for t in self.library.tokenizer.model.tokenize(letters)])
        return packed

    def encode(self, plain: bytes) -> bytes:
        words = self.library.pattern.findall(plain)
        return self[words[0]] if len(words) == 1 else b"".join(map(self.__getitem__, words))


class Chunks(dict):
    """Both tiers over chunks between single blanks: the frequent ones first, then what this worker has met."""

    def __init__(self, library: Library, frequent: dict[bytes, object], value) -> None:
        super().__init__(frequent)
        self.library, self.frequent, self.value = library, frequent, value
        self.words = PreTokens(library)

    def __missing__(self, chunk: bytes | str):
        """Chunks of texts of Latin-1 characters are bytes, others are text."""
        if isinstance(chunk, str):
            found = self._wide(chunk)
        elif not self.library.lower:
            if not chunk or chunk[0] in BLANK_BYTES or chunk[-1] in BLANK_BYTES:
                raise _Blanks
            found = self.value(self.words.encode(b" " + chunk))
            if b"\n" in chunk:  # two words around a line end hardly come again
                return found
        else:
            found = self.value(self.words.encode(chunk))
        if len(self) >= len(self.frequent) + CACHE:
            self.clear()
            self.update(self.frequent)
        self[chunk] = found
        return found

    def _wide(self, chunk: str):
        if not self.library.lower and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
            raise _Blanks
        try:
            plain = chunk.encode("latin-1")
        except UnicodeEncodeError:
            return self.value(self.library.wide_words(chunk if self.library.lower else " " + chunk))
        return self[plain]

    def wide_values(self, text: str) -> list:
        found = self.library.wide(text)
        if found is None:
            return [self.value(pack(self.library.ids(text)))]
        if self.library.lower:
            return list(map(self.__getitem__, filter(None, found.split(" "))))
        first, *rest = found.split(" ")
        try:
            if not first or first[-1].isspace():
                raise _Blanks
            return [self.value(self.library.wide_words(first)), *map(self.__getitem__, rest)]
        except _Blanks:
            return [self.value(self.library.wide_words(found))]

    def values_of(self, text: str | None) -> list:
        """What ``value`` makes of the ids of each part of the text, in order."""
        if not text:
            return []
        plain = self.library.plain(text)
        if plain is None:
            return self.wide_values(text)
        if self.library.lower:
            return list(map(self.__getitem__, plain.split()))
        first, *rest = plain.split(b" ")
        try:
            if not first or first[-1] in BLANK_BYTES:
                raise _Blanks
            return [self.value(self.words.encode(first)), *map(self.__getitem__, rest)]
        except _Blanks:
            return [self.value(self.words.encode(plain))]


def lengths(library: Library, frequent: dict[bytes, int] | None = None) -> Chunks:
    return Chunks(library, frequent or {}, lambda packed: len(packed) // 4)


def ids(library: Library) -> Chunks:
    return Chunks(library, {}, lambda packed: packed)


def pack(numbers: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(numbers)}I", *numbers)


def chunk_counts(docs: DataFrame, text: str, path: str) -> DataFrame:
    """(chunk, n) of all whole texts, as text in lower case if the tokenizer takes it so; chunks that stand once in what
    a task holds at a time are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, seen = Library(path), Counter()

        def rows() -> pa.RecordBatch:
            often = [(c.decode("latin-1") if isinstance(c, bytes) else c, n) for c, n in seen.items() if n > 1]
            seen.clear()
            chunks, counts = list(zip(*often, strict=True)) or ((), ())
            return pa.RecordBatch.from_arrays([pa.array(chunks, pa.string()), pa.array(counts, pa.int64())], names=["chunk", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                plain = library.plain(t or "")
                if plain is not None:
                    seen.update(plain.split())
                elif (wide := library.wide(t)) is not None:
                    seen.update(wide.split())
                if len(seen) > COUNTED:
                    yield rows()
        yield rows()

    parts = docs.select(quoted(text)).mapInArrow(run, "chunk string, n long")
    return parts.groupBy("chunk").agg(F.sum("n").alias("n"))


def frequent_lengths(docs: DataFrame, text: str, path: str, most: int) -> dict[bytes | str, int]:
    """Lengths of the ``most`` most frequent chunks of all texts. Only speed depends on the choice."""
    table, out = lengths(Library(path)), {}
    for r in chunk_counts(docs, text, path).orderBy(F.desc("n"), "chunk").limit(most).collect():
        try:
            chunk = r["chunk"].encode("latin-1")
        except UnicodeEncodeError:
            chunk = r["chunk"]
        out[chunk] = table[chunk]
    return out


def count_tokens(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: key, n_bytes (UTF-8) and n_tokens of the whole text, as the tokenizer file at ``path`` (reachable by
    every executor) gives them, without added special tokens; special strings inside a text count as the library
    takes them. A NULL text is empty and has no tokens. Repeated rows give repeated results.

    The first tier holds at most ``frequent`` chunks; it changes speed only.
    """
    hint = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, text, path, frequent))

    def make():
        table = lengths(Library(path), hint.value)

        def step(texts: pa.Array) -> list[int]:
            return [sum(table.values_of(t)) for t in texts.to_pylist()]

        return step

    df = docs.select(quoted(key), quoted(text))
    n = unused(df.columns, "n_tokens")
    size = F.coalesce(F.octet_length(quoted(text)), F.lit(0)).cast("long")
    return append(df, [text], make, "long", n).select(
        quoted(key), size.alias("n_bytes"), quoted(n).alias("n_tokens")
    )
