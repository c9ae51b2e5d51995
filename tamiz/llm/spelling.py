"""Spelling variants by k-d trees over letter counts.

One edit changes the counts of a word by little: an inserted letter adds one, a deleted one takes one, a replaced one
does both, so that the L1 distance is at most two. Words of one length are the points of a k-d tree over their counts;
a word asks the trees of its own length and of the next shorter and longer one, and a box is left out as soon as it is
out of reach. What remains differs by one known letter, and the order of letters decides: the word, changed by that
letter at each place where it can be, is looked up among the words of those counts.

The trees are cut into cells by a sample that shapes them and changes no result. A word is a point of one cell and
asks each cell that it can reach; a cell of many words is dealt into pairs of blocks. A task returns one row per
asking word, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import ScratchTables
from tamiz.session import materialise

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of the sample, aimed at in a cell, taken at most by a task on either side, in a leaf.
SAMPLE, CELL, TASK, LEAF = 1 << 16, 1 << 14, 1 << 16, 12
# Longer words are compared with each other instead of being changed at every place.
LONG = 64
# Cells of an array that one step of a search works on.
STEP = 1 << 22


# ---------------------------------------------------------------- words


def slipped(word: Column, key: Column, every: int) -> Column:
    """``word`` without one letter for one in ``every`` of all (key, word), chosen by the crc32 of ``key:word``."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = F.pmod(h, F.length(word)).cast("int")
    return F.when(F.pmod(h, F.lit(every)) == 0, F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length(word)))).otherwise(word)


def word_counts(docs: DataFrame, key: str, text: str, min_letters: int, min_count: int, slip_every: int) -> DataFrame:
    """(word, n). ``slip_every`` = 0 leaves all words as they are."""
    runs = F.regexp_extract_all(quoted(text), F.lit(RUN), F.lit(0))
    words = docs.select(quoted(key).alias("key"), F.explode(runs).alias("run"))
    word = F.translate("run", UPPER, LOWER)
    words = words.select("key", word.alias("word"))
    if slip_every:
        words = words.select(slipped(F.col("word"), F.col("key"), slip_every).alias("word"))
    counts = words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


# ---------------------------------------------------------------- trees


def letter_counts(words: Sequence[str], letters: np.ndarray) -> np.ndarray:
    """[word, letter]: how often a word has each of ``letters`` (code points below 256)."""
    place = np.full(256, len(letters))
    place[letters] = np.arange(len(letters))
    kind = np.int16 if max(map(len, words), default=0) < 1 << 15 else np.int32
    out, width = np.zeros((len(words), len(letters)), dtype=kind), len(letters) + 1
    for low in range(0, len(words), 1 << 12):
        part = words[low : low + (1 << 12)]
        rows = np.repeat(np.arange(len(part)), [len(w) for w in part])
        at = rows * width + place[np.frombuffer("".join(part).encode("latin-1"), np.uint8)]
        out[low : low + len(part)] = np.bincount(at, minlength=len(part) * width).reshape(len(part), width)[:, :-1]
    return out


def letters_of(words: Sequence[str]) -> np.ndarray:
    return np.array(sorted(map(ord, set().union(*words))) if words else [], dtype=np.int64)


class KdTree:
    """Over the rows of ``points``. Boxes are as tight as the points of a node; with ``regions`` they divide the whole
    space instead, so that any other point has its place too."""

    def __init__(self, points: np.ndarray, leaf: int, regions: bool = False) -> None:
        self.low, self.high, self.kids, self.members = [], [], [], []
        most = np.iinfo(points.dtype).max
        dims = points.shape[1]
        stack = [(np.arange(len(points)), np.zeros(dims, points.dtype), np.full(dims, most, points.dtype), -1, 0)]
        while stack:
            rows, low, high, parent, side = stack.pop()
            me = len(self.kids)
            if parent >= 0:
                self.kids[parent][side] = me
            own = points[rows]
            least, largest = (own.min(axis=0), own.max(axis=0)) if len(rows) else (low, high)
            self.low.append(low if regions else least)
            self.high.append(high if regions else largest)
            self.kids.append([-1, -1])
            self.members.append(rows)
            if len(rows) <= leaf or (least == largest).all():
                continue
            dim = int(np.where(largest > least, own.var(axis=0), -1).argmax())
            cut = min(int(np.median(own[:, dim])), int(largest[dim]) - 1)
            inner = own[:, dim] <= cut
            left, right = high.copy(), low.copy()
            left[dim], right[dim] = cut, cut + 1
            self.members[me] = None
            stack += [(rows[inner], low, left, me, 0), (rows[~inner], right, high, me, 1)]

    def reach(self, queries: np.ndarray, gained: int, lost: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``queries``) for each leaf whose box holds a point that a query becomes by gaining at most
        ``gained`` letters and losing at most ``lost``."""
        stack = [(0, np.arange(len(queries)))]
        while stack:
            node, rows = stack.pop()
            own = queries[rows]
            near = (np.maximum(self.low[node] - own, 0).sum(axis=1) <= gained) & (
                np.maximum(own - self.high[node], 0).sum(axis=1) <= lost
            )
            rows = rows[near]
            if not len(rows):
                continue
            if self.members[node] is not None:
                yield node, rows
            else:
                stack += [(kid, rows) for kid in self.kids[node]]


def within(tree: KdTree, points: np.ndarray, queries: np.ndarray, gained: int, lost: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(points, queries, letter gained, letter lost): all that differ by exactly ``gained`` and ``lost`` letters, which
    are 0 or 1; a letter not gained or lost is any."""
    for leaf, rows in tree.reach(queries, gained, lost):
        members = tree.members[leaf]
        height = max(1, STEP // max(1, len(members) * points.shape[1]))
        for low in range(0, len(rows), height):
            part = rows[low : low + height]
            d = points[members][None] - queries[part][:, None]
            up, down = np.maximum(d, 0).sum(axis=2), np.maximum(-d, 0).sum(axis=2)
            q, p = np.nonzero((up == gained) & (down == lost))
            if len(q):
                yield members[p], part[q], d[q, p].argmax(axis=1), d[q, p].argmin(axis=1)


# ---------------------------------------------------------------- one edit


def neighbours(word: str, known: dict[str, int], gained: str, lost: str) -> list[str]:
    """The words of ``known`` that ``word`` becomes by one edit that gains and loses these letters ("" for none). The
    words of ``known`` have the letters that are left then, in any order."""
    if len(word) > LONG:
        return [u for u in known if one_edit(word, u)]
    out = []
    if not lost:
        at = [i for i in range(len(word) + 1) if not i or word[i - 1] != gained]
        out = [word[:i] + gained + word[i:] for i in at]
    else:
        at = [i for i, c in enumerate(word) if c == lost and (gained or not i or word[i - 1] != lost)]
        out = [word[:i] + gained + word[i + 1 :] for i in at]
    return [u for u in out if u in known]


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    x, y = (np.frombuffer(w.encode("latin-1"), np.uint8) for w in (a, b))
    differ = np.flatnonzero(x != y[: len(x)])
    first = int(differ[0]) if len(differ) else len(x)
    return a[first + (len(a) == len(b)) :] == b[first + 1 :]


def grouped(words: Sequence[str], numbers: Sequence[int]) -> dict[str, dict[str, int]]:
    """{letters in order: {word: number}}."""
    out: dict[str, dict[str, int]] = {}
    for w, n in zip(words, numbers, strict=True):
        out.setdefault("".join(sorted(w)), {})[w] = n
    return out


def near_words(
    points: dict[str, int], asking: dict[int, Sequence[str]], leaf: int = LEAF
) -> dict[str, tuple[int, int, str]]:
    """{asking word: (near words, the largest number among them, the first word of that number)}, for those that have
    any. ``points``: {word: number}, all of one length; ``asking``: words by how much shorter than the points they are
    (-1, 0 or 1)."""
    out: dict[str, tuple[int, int, str]] = {}
    if not points:
        return out
    groups = grouped(list(points), list(points.values()))
    names = list(groups)
    letters = letters_of(names + [w for words in asking.values() for w in words])
    tree_points = letter_counts(names, letters)
    tree = KdTree(tree_points, leaf)
    members = list(groups.values())
    signs = [chr(c) for c in letters.tolist()]
    for shorter, words in asking.items():
        own = grouped(words, [0] * len(words))
        gained, lost = int(shorter >= 0), int(shorter <= 0)
        asked = list(own.values())
        counts = letter_counts(list(own), letters)
        for p, q, up, down in within(tree, tree_points, counts, gained, lost):
            for i, j, g, x in zip(p.tolist(), q.tolist(), up.tolist(), down.tolist(), strict=True):
                known = members[i]
                for word in asked[j]:
                    for u in neighbours(word, known, signs[g] if gained else "", signs[x] if lost else ""):
                        n, best, form = out.get(word, (0, 0, ""))
                        k = known[u]
                        if not n or k > best or (k == best and u < form):
                            best, form = k, u
                        out[word] = n + 1, best, form
    return out


# ---------------------------------------------------------------- cells

Trees = dict[int, KdTree]
ALL_LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])


def cell_trees(sample: Sequence[str], every: int, cell: int) -> Trees:
    """By length, the tree that cuts its words into cells; a length without sample is one cell."""
    by_length: dict[int, list[str]] = {}
    for w in sample:
        by_length.setdefault(len(w), []).append(w)
    return {n: KdTree(letter_counts(words, ALL_LETTERS), max(1, cell // every), regions=True) for n, words in by_length.items()}


def routes(trees: Trees, words: Sequence[str]) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(length of the points, cell, how much shorter the word is or None for a point, rows of ``words``)."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        counts = letter_counts([words[i] for i in rows.tolist()], ALL_LETTERS)
        for length, shorter, gained, lost in ((n, None, 0, 0), (n, 0, 1, 1), (n + 1, 1, 1, 0), (n - 1, -1, 0, 1)):
            if (tree := trees.get(length)) is None:
                yield length, 0, shorter, rows
                continue
            kind = np.promote_types(counts.dtype, tree.low[0].dtype)
            for cell, part in tree.reach(counts.astype(kind), gained, lost):
                yield length, cell, shorter, rows[part]


def dealt(words: DataFrame, sample: int, cell: int, task: int, tables: ScratchTables) -> DataFrame:
    """(length, cell, i, j, shorter, word, n): every word as a point (shorter NULL) and wherever it asks."""
    every = max(1, -(-words.count() // sample))
    chosen = words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word")
    trees = cell_trees([r["word"] for r in chosen.collect()], every, cell)
    names = ["length", "cell", "shorter", "word", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, numbers = batch.column("word"), batch.column("n")
            for length, at, shorter, rows in routes(trees, column.to_pylist()):
                same = [pa.array([v] * len(rows), pa.int32()) for v in (length, at, shorter)]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays([*same, column.take(take), numbers.take(take)], names=names)

    rows = tables.store(words.mapInArrow(run, "length int, cell int, shorter int, word string, n long"))
    # Blocks on either side, for cells that need more than one: at most rows / task of them.
    asks = F.col("shorter").isNotNull()
    sizes = rows.groupBy("length", "cell").agg(F.count_if(~asks).alias("p"), F.count_if(asks).alias("q"))
    large = sizes.where((F.col("p") > task) | (F.col("q") > task)).select(
        "length", "cell", *[F.ceil(F.greatest(F.col(c), F.lit(1)) / task).cast("int").alias(c) for c in ("p", "q")]
    )
    placed = rows.join(F.broadcast(large), ["length", "cell"], "left").fillna(1, ["p", "q"])
    block = F.xxhash64("word")

    def blocks(mine: Column, count: str) -> Column:
        every_one = F.sequence(F.lit(0), F.col(count) - 1)
        return F.when(mine, F.array(F.pmod(block, F.col(count)).cast("int"))).otherwise(every_one)

    placed = placed.withColumn("i", F.explode(blocks(~asks, "p"))).withColumn("j", F.explode(blocks(asks, "q")))
    return placed.drop("p", "q")


def variants(words: DataFrame, sample: int = SAMPLE, cell: int = CELL, task: int = TASK) -> DataFrame:
    """(word, n, n_near, best: struct<neg long, form string>) for each of the distinct ``words`` (word, n)."""
    tables = ScratchTables(words.sparkSession)
    schema = "word string, n long, n_near long, best struct<neg: bigint, form: string>"

    def search(table: pa.Table) -> pa.Table:
        shorter, all_words, numbers = (table.column(c).to_pylist() for c in ("shorter", "word", "n"))
        rows = list(zip(shorter, all_words, numbers, strict=True))
        asking: dict[int, list[str]] = {}
        for s, w, _ in rows:
            if s is not None:
                asking.setdefault(s, []).append(w)
        found = near_words({w: n for s, w, n in rows if s is None}, asking)
        # Every word comes back at least once: as a point.
        out = [(w, n, 0, None) for s, w, n in rows if s is None]
        of = {w: n for s, w, n in rows if s is not None}
        out += [(w, of[w], n, {"neg": -best, "form": form}) for w, (n, best, form) in found.items()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.struct([("neg", pa.int64()), ("form", pa.string())]))
        columns = zip(*out, strict=True) if out else [[]] * 4
        return pa.Table.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["word", "n", "n_near", "best"]
        )

    placed = dealt(words, sample, cell, task, tables)
    found = placed.groupBy("length", "cell", "i", "j").applyInArrow(search, schema)
    whole = found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    whole = materialise(whole, "variants")
    tables.drop()
    return whole


def with_roots(links: DataFrame) -> DataFrame:
    """(word, root) for each row (word, form) of ``links``, which have no cycles: the end of the forms that follow each
    other. A round doubles how far each word sees."""
    tables = ScratchTables(links.sparkSession)
    seen = tables.store(links.select("word", F.col("form").alias("root"), F.lit(True).alias("more")))
    while seen.where("more").limit(1).count():
        further = seen.select(F.col("word").alias("via"), F.col("root").alias("next"))
        step = seen.join(further, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")
        )
        seen = tables.replace(seen, step)
    out = materialise(seen.select("word", "root"), "roots")
    tables.drop()
    return out


def spelling_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_letters: int = 5,
    min_count: int = 3,
    ratio: int = 2,
    slip_every: int = 0,
    sample: int = SAMPLE,
    cell: int = CELL,
    task: int = TASK,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of at least ``min_letters`` letters that stands in the texts
    ``min_count`` times or more.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. Two are near if one inserted,
    deleted or replaced letter parts them. The form of a word is its near word of the largest n (of equal ones the first
    in code-point order) if that is at least ``ratio`` times its own, else NULL; the root is where forms lead to, the
    word itself if it has none. ``ratio`` is 2 or more, so that forms have no cycle. With ``slip_every`` one in so many
    (document, word) loses a letter (see ``slipped``); the id of a document counts for nothing else, and NULL ids as
    empty. NULL and empty texts have no words; repeated rows count as often as they stand.
    """
    if ratio < 2:
        raise ValueError(f"ratio is 2 or more, not {ratio}")
    words = materialise(word_counts(docs, key, text, min_letters, min_count, slip_every), "words")
    found = variants(words, sample, cell, task)
    chosen = -F.col("best.neg") >= ratio * F.col("n")
    forms = found.select(
        "word",
        F.when(chosen, F.col("best.form")).alias("form"),
        "n",
        "n_near",
        F.when(chosen, -F.col("best.neg")).alias("form_n"),
    )
    roots = with_roots(forms.where("form IS NOT NULL").select("word", "form"))
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
