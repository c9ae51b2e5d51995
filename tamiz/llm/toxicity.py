"""Toxicity of texts after noisy-channel deobfuscation.

A writer's word passes a channel that swaps letters for look-alikes, spaces letters out and repeats them. Disguised
tokens become lattices of what each sign may stand for; a Viterbi search picks the reading that a character
language model, counted over all texts, finds likeliest. Words of the restored text are scored with a lexicon of
words and word beginnings, once or repeated in a text, learned from labelled documents.

One pass over the texts counts the character n-grams of their words, exactly and in a table that grows with them, and
gathers the distinct tokens of more than one reading. These are decoded once, in blocks; a block is joined with the
counts that its lattices can ask for. Texts are then scored by lookups: in the lexicon, and in a table of those tokens
whose reading holds a word of it.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, unused
from tamiz.session import materialise

# Labelled rows of the fit (the bound of the sample), features kept, entries of a task's tables.
FIT_ROWS, LEXICON, TABLE = 12_000, 4096, 300_000
# Order of the character model, and tokens that are decoded together.
ORDER, BLOCK = 4, 50_000
# Tokens with a word of the lexicon that one pass of scoring takes along.
HITS = 500_000
PREFIXES = (4, 5, 6, 7, 8)
REPEATED_MARK = "#2"
# What a feature needs: documents, words before it, and the lower end of its weight.
DOCUMENTS, CONTEXTS, WEIGHT = 5, 4, 1.0

# Log-odds of a text without evidence, where labels give none.
NO_EVIDENCE = -2.0

# What a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "+": "t", "|": "li", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
}
# Log-probabilities of the channel: another sign for a letter, a sign that stands for nothing, a letter repeated, a
# blank between spaced letters that is none, and one that is.
SWAPPED, STRAY, REPEATED, SPACED, BLANK = -1.0, -7.0, -0.7, -0.1, -4.0

SEPARATORS = " .-_*"
LETTER_SIGNS = "$@€£"
# Members of a spaced run are letters, digits and signs that may stand for a letter, but for those that separate; the
# last is no punctuation.
_SIGNS = re.escape("".join(c for c in LOOKALIKES if not c.isalnum() and c not in SEPARATORS))
_MEMBER, _LAST = rf"(?:[^\W_]|[{_SIGNS}])(?![^\W_])", rf"(?:[^\W_]|[{LETTER_SIGNS}])(?![^\W_])"
SPACED_RUN = re.compile(rf"(?<![^\W_]){_MEMBER}(?:[ .*_-]{{1,2}}{_MEMBER})+[ .*_-]{{1,2}}{_LAST}")
TOKEN_SIGNS = "".join(LOOKALIKES) + "_"
WORD = re.compile(r"[^\W\d_]+")
DOUBLED = re.compile(r"(.)\1")
PLAIN, SPACED_OUT, GRAM = 0, 1, 2


def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tables over all code points: letters, letters and digits, look-alike signs."""
    letter, alnum, sign = (np.zeros(0x110000, dtype=bool) for _ in range(3))
    for i in range(0x40000):  # no letter stands beyond the fourth plane
        c = chr(i)
        if c.isalnum():
            alnum[i], letter[i] = True, c.isalpha()
    sign[[ord(c) for c in LOOKALIKES]] = True
    return letter, alnum, sign


LETTER, ALNUM, SIGN = _kinds()
# The same as bits of one table, which is looked up once a character: letters, letters and digits, look-alike signs,
# members of a token that are no look-alikes, all members, and those that may end one.
IS_LETTER, IS_ALNUM, IS_SIGN, IS_OTHER, IS_MEMBER, IS_LAST = 1, 2, 4, 8, 16, 32
KIND = (LETTER * IS_LETTER + ALNUM * IS_ALNUM + SIGN * IS_SIGN).astype(np.uint8)
KIND[(ALNUM | (np.arange(len(KIND)) == ord("_"))) & ~SIGN] |= IS_OTHER
KIND[ALNUM] |= IS_MEMBER | IS_LAST
KIND[[ord(c) for c in TOKEN_SIGNS]] |= IS_MEMBER
KIND[[ord(c) for c in LETTER_SIGNS]] |= IS_LAST
# Characters that are looked at together. Longer texts are cut at line ends, which no token reaches over, or where
# there is none so far, at any place.
SLICE = 1 << 20


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > 2 * SLICE:
        end = text.find("\n", at + SLICE, at + 2 * SLICE)
        end = at + 2 * SLICE if end < 0 else end
        yield text[at:end]
        at = end
    yield text[at:]


def words_of(points: np.ndarray, letter: np.ndarray) -> list[str]:
    """Runs of letters."""
    return np.where(letter, points, 32).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split()


class CharacterModel:
    """Interpolated character n-grams from exact counts; a gram that is not there was never seen."""

    WEIGHTS = (0.04, 0.16, 0.3, 0.5)

    def __init__(self, counts: Mapping[str, int], total: int) -> None:
        self.counts, self.total = counts, max(1, total)
        self.log = lru_cache(maxsize=1 << 16)(self._log)

    def _log(self, context: str, c: str) -> float:
        count = self.counts.get
        p = self.WEIGHTS[0] * (count(c, 0) / self.total + 1e-6)
        for n in range(1, min(len(context), ORDER - 1) + 1):
            if before := count(context[-n:], 0):
                p += self.WEIGHTS[n] * count(context[-n:] + c, 0) / before
        return math.log(p)


def count_grams(words: Mapping[str, int], part: int = 1 << 15) -> dict[str, int]:
    """Counts of the n-grams up to ORDER of words that stand between blanks, from the words and how often they come;
    ``part`` words at a time."""
    out: Counter[str] = Counter()
    names = iter(words)
    while some := list(islice(names, part)):
        for gram, n in _grams_of({w: words[w] for w in some}):
            out[gram] += n
    return out


def _grams_of(words: Mapping[str, int]) -> list[tuple[str, int]]:
    joined = "".join([f" {w} \0" for w in words])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    alphabet, ids = np.unique(points, return_inverse=True)
    if len(alphabet) > 1 << 16:  # sixteen bits a letter below
        names = list(words)
        half = len(names) // 2
        return _grams_of({w: words[w] for w in names[:half]}) + _grams_of({w: words[w] for w in names[half:]})
    weights = np.repeat(np.array(list(words.values()), dtype=np.int64), [len(w) + 3 for w in words])
    # What begins at each place, four letters long; behind the end of a word there are only separators.
    inside = ids.astype(np.uint64)
    ends = np.append(ids, np.zeros(ORDER, ids.dtype)) == 0
    key, closed = np.zeros(len(ids), dtype=np.uint64), np.zeros(len(ids), dtype=bool)
    for n in range(ORDER):
        closed |= ends[n : n + len(ids)]
        shifted = np.append(inside[n:], np.zeros(n, np.uint64))
        key = (key << np.uint64(16)) | np.where(closed, np.uint64(0), shifted)
    at = key > 0
    grams, of = np.unique(key[at], return_inverse=True)
    n_of = np.bincount(of, weights[at]).astype(np.int64)
    out: list[tuple[str, int]] = []
    for order in range(1, ORDER + 1):
        head = grams >> np.uint64(16 * (ORDER - order))
        whole = (head & np.uint64(0xFFFF)) > 0
        found, of = np.unique(head[whole], return_inverse=True)
        counts = np.bincount(of, n_of[whole], minlength=len(found)).astype(np.int64)
        letters = np.stack([(found >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in reversed(range(order))], axis=1)
        text = alphabet[letters.astype(np.int64)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        out += [(text[i : i + order], n) for i, n in zip(range(0, len(text), order), counts.tolist(), strict=True)]
    # The blank before a word is where it begins, not a letter of it.
    return [(g, n // 2 if g == " " else n) for g, n in out]


def lattice(token: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """For each run of one sign, the strings that it may stand for and their log-probabilities."""
    slots = []
    for m in re.finditer(r"(.)\1*", token, re.S):
        c, n = m[1], len(m[0])
        if spaced and c in SEPARATORS:
            slots.append([("", SPACED), (" ", BLANK)])
        elif c.isalpha():
            # Twice may be meant; three times is not.
            slots.append([(c, 0.0)] if n == 1 else [(c, REPEATED), (c * 2, 0.0 if n == 2 else REPEATED)])
        elif c in LOOKALIKES:
            options = [(letter * k, SWAPPED) for letter in LOOKALIKES[c] for k in {1, min(n, 2)}]
            slots.append([*options, ("", STRAY)])
        else:
            slots.append([(" ", 0.0)])
    return slots


def decode(token: str, model: CharacterModel, spaced: bool = False) -> str:
    """The likeliest reading of a token: Viterbi over its lattice, a state is the last characters read."""
    states = {" ": (0.0, "")}
    for slot in lattice(token, spaced):
        following: dict[str, tuple[float, str]] = {}
        for context, (score, read) in states.items():
            for string, cost in slot:
                total, at = score + cost, context
                for c in string:
                    total += model.log(at, c)
                    at = (at + c)[1 - ORDER :]
                if at not in following or total > following[at][0]:
                    following[at] = (total, read + string)
        states = following
    return max((score + model.log(at, " "), read) for at, (score, read) in states.items())[1]


def asked_grams(token: str, spaced: bool) -> set[str]:
    """Every n-gram whose count ``decode`` may look up for a token."""
    contexts, out = {" "}, {" "}
    for slot in [*lattice(token, spaced), [(" ", 0.0)]]:
        following = set()
        for at in contexts:
            for string, _ in slot:
                end = at
                for c in string:
                    for n in range(len(end) + 1):
                        out.add(end[len(end) - n :] + c)
                        out.add(end[len(end) - n :])
                    end = (end + c)[1 - ORDER :]
                following.add(end)
        contexts = following
    out.discard("")
    return out


class Restorer:
    """Words of a text after deobfuscation. ``readings``: words by (token, spaced); a token that is not there has its
    letters for words."""

    def __init__(self, readings: Mapping[tuple[str, bool], Sequence[str]]) -> None:
        self.readings = readings

    def words(self, text: str | None) -> list[str]:
        out: list[str] = []
        for piece, spaced in self.pieces(text):
            if spaced is not None:
                read = self.readings.get((piece, spaced))
                out += WORD.findall(piece) if read is None else read
                continue
            points = code_points(piece)
            for word in words_of(points, LETTER[points]):
                read = self.readings.get((word, False)) if DOUBLED.search(word) else None
                if read is None:
                    out.append(word)
                else:
                    out += read
        return out

    @classmethod
    def pieces(cls, text: str | None) -> Iterator[tuple[str, bool | None]]:
        """The text in lower case: disguised tokens with whether they are spaced, and what lies between (None)."""
        for part in slices(text.lower() if text else ""):
            at = 0
            for start, end, spaced in cls.disguised(part, KIND.take(code_points(part))):
                yield part[at:start], None
                yield part[start:end], spaced
                at = end
            yield part[at:], None

    @classmethod
    def parts(cls, text: str | None) -> Iterator[tuple[list[str], list[tuple[str, bool]]]]:
        """The words between the disguised tokens, and these tokens with whether they are spaced; by slices."""
        for part in slices(text.lower() if text else ""):
            points = code_points(part)
            kind = KIND.take(points)
            spans, letter = cls.disguised(part, kind), (kind & IS_LETTER).view(bool)
            for start, end, _ in spans:
                letter[start:end] = False
            yield words_of(points, letter), [(part[start:end], spaced) for start, end, spaced in spans]

    @staticmethod
    def disguised(text: str, kind: np.ndarray) -> list[tuple[int, int, bool]]:
        """(start, end, spaced) of tokens with a letter and a look-alike, wherever it stands, and of at least three
        letters or look-alikes spaced out. Repeated letters alone are left to the readings of words. ``kind``: those of
        the characters."""
        spans: list[tuple[int, int, bool]] = []
        beside = np.zeros(len(kind), dtype=np.uint8)
        beside[1:] = kind[:-1]
        beside[:-1] |= kind[1:]
        alone = ((kind & (IS_ALNUM | IS_SIGN)) != 0) & ((beside & IS_ALNUM) == 0)
        near = np.flatnonzero(alone)
        if len(near) > 2 and (near[2:] - near[:-2] <= 6).any():
            spans = [(*m.span(), True) for m in SPACED_RUN.finditer(text)]
        # A token with a letter and a look-alike has a place where a look-alike meets what is none.
        meet = ((kind & IS_SIGN) != 0) & ((beside & IS_OTHER) != 0)
        taken, run = spans.copy(), 0
        last, of = 0, kind.tobytes()
        for at in np.flatnonzero(meet).tolist():
            while run < len(taken) and taken[run][1] <= at:
                run += 1
            if at < last or (run < len(taken) and taken[run][0] <= at):
                continue
            start, end = at, at + 1
            while start > last and of[start - 1] & IS_MEMBER:
                start -= 1
            while end < len(text) and of[end] & IS_MEMBER:
                end += 1
            last = end
            # Punctuation behind a token stands for nothing, but for signs that are letters only.
            while end > start and not of[end - 1] & IS_LAST:
                end -= 1
            token = np.bitwise_or.reduce(kind[start:end]) if end > start else 0
            if not token & IS_LETTER or not token & IS_SIGN:
                continue
            if not (run < len(taken) and taken[run][0] < end) and not (run and taken[run - 1][1] > start):
                spans.append((start, end, False))
        return sorted(spans)


@lru_cache(maxsize=1 << 16)
def features(word: str) -> tuple[str, ...]:
    """A word and its beginnings."""
    return (word, *[word[:n] + "*" for n in PREFIXES if len(word) > n])


# ---------------------------------------------------------------- what all texts tell


@dataclass(frozen=True)
class Corpus:
    """``grams`` (gram, n) of the words of all texts, ``total``: the letters and blanks they were counted over, and
    ``tokens`` (token, spaced), the distinct tokens of more than one reading."""

    grams: DataFrame
    tokens: DataFrame
    total: int


def survey(docs: DataFrame, text: str = "text") -> Corpus:
    """One pass over all whole texts; words and tokens are combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        tokens: set[tuple[str, bool]] = set()

        def rows() -> pa.RecordBatch:
            tokens.update((w, False) for w in words if DOUBLED.search(w))
            made = [(SPACED_OUT if s else PLAIN, t, 1) for t, s in tokens] + [(GRAM, g, n) for g, n in count_grams(words).items()]
            words.clear()
            tokens.clear()
            kinds = zip((pa.int32(), pa.string(), pa.int64()), list(zip(*made, strict=True)) or [[]] * 3, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for k, c in kinds], names=["kind", "token", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                for plain, disguised in Restorer.parts(t):
                    words.update(plain)
                    tokens.update(disguised)
                if len(words) + len(tokens) > TABLE:
                    yield rows()
        yield rows()

    found = docs.select(quoted(text)).mapInArrow(run, "kind int, token string, n long")
    found = materialise(found.groupBy("kind", "token").agg(F.sum("n").alias("n")), "survey", partition_by="kind")
    grams = found.where(F.col("kind") == GRAM).select(F.col("token").alias("gram"), "n")
    total = grams.where(F.length("gram") == 1).agg(F.sum("n")).first()[0] or 0
    tokens = found.where(F.col("kind") != GRAM).select("token", (F.col("kind") == SPACED_OUT).alias("spaced"))
    return Corpus(grams, tokens, total)


def read_tokens(corpus: Corpus, block: int = BLOCK) -> DataFrame:
    """(token, spaced, words): each token decoded once, with the counts that its block asks for."""
    blocks, total = max(1, -(-corpus.tokens.count() // block)), corpus.total
    tokens = corpus.tokens.withColumn("block", F.pmod(F.xxhash64("token"), F.lit(blocks)).cast("int"))

    def ask(rows: pa.Table) -> pa.Table:
        out: set[str] = set()
        for token, spaced in zip(rows["token"].to_pylist(), rows["spaced"].to_pylist(), strict=True):
            out |= asked_grams(token, spaced)
        number = rows["block"][0].as_py() if rows.num_rows else 0
        return pa.table({"block": pa.array([number] * len(out), pa.int32()), "gram": pa.array(list(out), pa.string())})

    def read(rows: pa.Table, counts: pa.Table) -> pa.Table:
        model = CharacterModel(dict(zip(counts["gram"].to_pylist(), counts["n"].to_pylist(), strict=True)), total)
        token, spaced = rows["token"].to_pylist(), rows["spaced"].to_pylist()
        words = [WORD.findall(decode(t, model, s)) for t, s in zip(token, spaced, strict=True)]
        return pa.table({"token": rows["token"], "spaced": rows["spaced"], "words": pa.array(words, pa.list_(pa.string()))})

    asked = tokens.groupBy("block").applyInArrow(ask, "block int, gram string").join(corpus.grams, "gram")
    both = tokens.groupBy("block").cogroup(asked.groupBy("block"))
    return materialise(both.applyInArrow(read, "token string, spaced boolean, words array<string>"), "readings")


# ---------------------------------------------------------------- fit


@dataclass(frozen=True)
class ToxicityModel:
    """``lexicon``: weights of features, those with REPEATED_MARK of features that a text has twice or more."""

    lexicon: Mapping[str, float]
    slope: float
    base: float

    def score(self, evidence: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.base) + F.lit(self.slope) * evidence)))


def _statistics(sample: DataFrame, shared) -> DataFrame:
    """(feature, positive, negative, contexts): documents of each class that hold a feature, and 64 bits of the words
    that stand before it in toxic documents, so that copies of one document do not look like many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        table: dict[str, list[int]] = {}

        def emit() -> pa.RecordBatch:
            columns = list(zip(*[(f, *v) for f, v in table.items()], strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.uint64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            table.clear()
            return pa.RecordBatch.from_arrays(
                [*arrays[:3], arrays[3].view(pa.int64())], names=["feature", "positive", "negative", "contexts"]
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                bits: dict[str, int] = {}
                often: Counter[str] = Counter()
                previous = ""
                for word in restorer.words(text):
                    bit = 1 << (sum(previous.encode()) * 7 + len(previous)) % 64 if toxic else 0
                    bits[word] = bits.get(word, 0) | bit
                    often[word] += 1
                    previous = word
                seen: dict[str, list[int]] = {}
                for word, own in bits.items():
                    for f in features(word):
                        entry = seen.setdefault(f, [0, 0])
                        entry[0] |= own
                        entry[1] += often[word]
                for f, (own, n) in seen.items():
                    for name in (f, f + REPEATED_MARK)[: min(n, 2)]:
                        entry = table.setdefault(name, [0, 0, 0])
                        entry[1 - toxic] += 1
                        entry[2] |= own
                if len(table) > TABLE:
                    yield emit()
        yield emit()

    parts = sample.mapInArrow(run, "feature string, positive long, negative long, contexts long")
    return parts.groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("negative").alias("negative"), F.bit_or("contexts").alias("contexts")
    )


def held_out(key: Column) -> Column:
    """Every fifth row by the CRC-32 of its key as text; a NULL key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    readings: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
    lexicon_size: int = LEXICON,
) -> ToxicityModel:
    """Learns from about ``fit_rows`` labelled keys at most, chosen by hash among those not held out; of repeated labels
    the highest counts. Three quarters of them give the lexicon, the others its scale. ``readings`` are those of the
    tokens of all texts. Without labels of both classes, or words that tell them apart, no text is taken for toxic."""
    marks = labels.select(quoted(key).cast("long").alias("k"), quoted(label).cast("int").alias("toxic"))
    marks = marks.where(F.col("k").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("k")))
    marks = materialise(marks.groupBy("k").agg(F.max("toxic").alias("toxic")), "labels")
    every = max(1, -(-marks.count() // fit_rows))
    order = F.xxhash64(F.lit("fit"), F.col("k"))
    chosen = marks.where(F.pmod(order, F.lit(every)) == 0).withColumn("scale", F.pmod(F.shiftright(order, 32), F.lit(4)) == 0)
    texts = docs.select(quoted(key).cast("long").alias("k"), quoted(text).alias("t"))
    # The sample is bounded by fit_rows, so it is small enough to be sent to the texts.
    sample = materialise(texts.join(F.broadcast(chosen), "k").select("t", "toxic", "scale").repartition(24), "sample")
    learn = sample.where(~F.col("scale")).select("t", "toxic")
    per_class = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    lexicon = {}
    if len(per_class) == 2:
        found = _statistics(learn, _readings_of(sample, readings))
        pos, neg = F.col("positive") + 0.5, F.col("negative") + 0.5
        odds = F.log(pos / (per_class[1] + 1)) - F.log(neg / (per_class[0] + 1))
        # The lower end of an interval of two standard errors.
        low = F.round(odds - 2 * F.sqrt(1 / pos + 1 / neg), 4)
        strong = found.where((F.col("positive") >= DOCUMENTS) & (F.bit_count("contexts") >= CONTEXTS)).withColumn("weight", low)
        strong = strong.where(F.col("weight") >= WEIGHT).orderBy(F.desc("weight"), "feature").limit(lexicon_size)
        lexicon = {r["feature"]: r["weight"] for r in strong.select("feature", "weight").collect()}
    if not lexicon:
        return ToxicityModel({}, 0.0, NO_EVIDENCE)
    scaled, evidence = _with_evidence(sample.where("scale").select("t", "toxic"), "t", lexicon, readings)
    scaled = scaled.groupBy(F.col(evidence).alias("e"), "toxic").agg(F.count("*").alias("n"))
    # One row per value of the evidence, of at most fit_rows.
    points = scaled.toPandas()
    slope, base = _logistic(points["e"].to_numpy(float), points["toxic"].to_numpy(float), points["n"].to_numpy(float))
    return ToxicityModel(lexicon, slope, base)


def _readings_of(sample: DataFrame, readings: DataFrame):
    """The readings of the tokens of the sample, sent to all executors: no more than the bounded sample has."""
    own = survey(sample, "t").tokens
    rows = readings.join(own, ["token", "spaced"], "left_semi").collect()
    return sample.sparkSession.sparkContext.broadcast({(r["token"], r["spaced"]): r["words"] for r in rows})


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Weighted logistic regression of one variable by Newton steps, with a small ridge."""
    if not len(x):
        return 1.0, NO_EVIDENCE
    design, w = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        gradient = design.T @ (n * (y - p)) - ridge * w
        hessian = (design * (n * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + step * min(1.0, 5.0 / max(1e-12, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return max(0.0, float(w[0])), float(w[1])


# ---------------------------------------------------------------- scores


def head(word: str) -> str:
    """Words that share a feature begin alike."""
    return word[: min(PREFIXES)]


class Scorer:
    """Evidence of a text: the sum over its distinct words of the weight of the strongest feature. ``hits``: the words
    of the lexicon in the reading of a token."""

    def __init__(self, lexicon: Mapping[str, float], hits: Mapping[tuple[str, bool], Sequence[str]]) -> None:
        self.lexicon, self.hits = lexicon, hits
        self.idle: set[str] = set()  # words met that say nothing

    def features(self, word: str) -> list[str]:
        """Those of the word that the lexicon has."""
        return [f for f in features(word) if f in self.lexicon or f + REPEATED_MARK in self.lexicon]

    def read(self, word: str) -> Sequence[str]:
        """The words of the lexicon that a word of letters stands for."""
        if DOUBLED.search(word):
            return self.hits.get((word, False), ())
        return [word] if self.features(word) else ()

    def evidence(self, text: str | None) -> float:
        often: Counter[str] = Counter()
        for words, tokens in Restorer.parts(text):
            for word in set(words).difference(self.idle):
                found = self.read(word)
                if not found:
                    if len(self.idle) >= TABLE:
                        self.idle.clear()
                    self.idle.add(word)
                    continue
                n = words.count(word)
                for w in found:
                    often[w] += n
            for token in tokens:
                for w in self.hits.get(token, ()):
                    often[w] += 1
        if not often:
            return 0.0
        own = {w: self.features(w) for w in often}
        total: Counter[str] = Counter()
        for w, n in often.items():
            for f in own[w]:
                total[f] += n
        weight = self.lexicon.get
        return sum(
            max([max(weight(f, 0.0), weight(f + REPEATED_MARK, 0.0) if total[f] > 1 else 0.0) for f in own[w]]) for w in sorted(often)
        )


def token_hits(readings: DataFrame, lexicon: Mapping[str, float]) -> DataFrame:
    """(token, spaced, word): the words of the lexicon, as often as a reading has them."""
    names = sorted({f.removesuffix(REPEATED_MARK) for f in lexicon})
    words = readings.select("token", "spaced", F.explode("words").alias("word"))
    beginnings = [F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in PREFIXES]
    # As many rows as the lexicon has features.
    known = readings.sparkSession.createDataFrame([(n,) for n in names], "feature string")
    pairs = words.withColumn("feature", F.explode(F.array_compact(F.array("word", *beginnings))))
    relevant = pairs.join(F.broadcast(known), "feature", "left_semi").select("word").distinct()
    return words.join(relevant, "word", "left_semi")


def _with_evidence(
    df: DataFrame, text: str, lexicon: Mapping[str, float], readings: DataFrame, most: int = HITS
) -> tuple[DataFrame, str]:
    """``df`` with the evidence of each text, and the column's name. Evidence adds up over the beginnings of words, so
    tokens beyond ``most`` take further passes, each with the words of some beginnings."""
    context, name = df.sparkSession.sparkContext, unused(df.columns, "evidence")
    hits = materialise(token_hits(readings, lexicon), "hits")
    slices = max(1, -(-hits.count() // most))

    def share(word: str) -> int:
        return int(zlib.crc32(head(word).encode())) % slices

    at = F.pmod(F.crc32(F.substring("word", 1, min(PREFIXES)).cast("binary")), F.lit(slices))
    total = F.lit(0.0)
    for i in range(slices):
        own: dict[tuple[str, bool], list[str]] = {}
        for r in hits.where(at == i).toLocalIterator():
            own.setdefault((r["token"], r["spaced"]), []).append(r["word"])
        weights = {f: w for f, w in lexicon.items() if share(f.removesuffix(REPEATED_MARK).removesuffix("*")) == i}
        shared = context.broadcast((weights, own))

        def make(shared=shared):
            scorer = Scorer(*shared.value)
            return lambda texts: [scorer.evidence(t) for t in texts.to_pylist()]

        part = unused(df.columns, f"evidence_{i}")
        df = append(df, [text], make, "double", part)
        total = total + quoted(part)
    return df.select(*[quoted(c) for c in df.columns[:-slices]], F.round(total, 6).alias(name)), name


def with_toxicity(
    docs: DataFrame, model: ToxicityModel, readings: DataFrame, text: str = "text", name: str = "toxicity"
) -> tuple[DataFrame, str]:
    """``docs`` with the score (0 to 1) of each text as one more column, and that column's name (``name`` or one like
    it). ``readings`` are those of the tokens of these texts. NULL and empty texts have the score of no evidence;
    repeated rows score alike."""
    column = unused(docs.columns, name)
    scored, evidence = _with_evidence(docs, text, model.lexicon, readings)
    score = model.score(quoted(evidence)).alias(column)
    return scored.select(*[quoted(c) for c in docs.columns], score), column


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", name: str = "toxicity"
) -> tuple[DataFrame, str]:
    """``docs`` scored by a model learned from them and ``labels``: survey, readings, fit and scores."""
    readings = read_tokens(survey(docs, text))
    return with_toxicity(docs, fit_toxicity(docs, labels, readings, key, text, label), readings, text, name)
