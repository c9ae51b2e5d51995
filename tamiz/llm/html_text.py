"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of words and tags. Words score by where they stand, tags score below zero, with weights learned
from pages whose markup names the article; one linear scan finds the contiguous region of the highest score. Inside
the region, blocks that stand in boilerplate (menus, adverts, forms, comments) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator, Set
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamiz.functions.columns import quoted
from tamiz.llm.common import append, unused

# Labelled pages read for the weights, names whose weights are kept, and the range of a weight.
FIT_PAGES, FIT_NAMES = 2000, 4096
WORD_RANGE, TAG_RANGE, BOILERPLATE_WORD = (-0.2, 2.0), (-1.0, -0.01), -0.02
# Weights of tags that mark text, that only group, and that no labelled page has shown.
TEXT_TAG, GENERIC_TAG, UNKNOWN_TAG = -0.01, -0.1, -0.5

# Elements that end a block, that hold no text of the page, that never have content.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
TEXT_TAGS = frozenset("b blockquote br cite code em h1 h2 h3 h4 h5 h6 i mark p pre q s small strong sub sup time u".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(("article", "main"))
GENERIC = frozenset("html body div section span article main".split())
# Elements, classes, ids and roles that name boilerplate.
BOILERPLATE_TAGS = frozenset("nav footer aside form head title button select menu dialog label fieldset search".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr newsletter subscribe subscription share sharing social breadcrumb breadcrumbs pagination pager related "
    "recommended widget popup modal overlay notice notices alert toolbar menu nav navbar navigation footer masthead "
    "sidebar complementary contentinfo comment comments reply replies respond discussion disqus login signup search "
    "toc skip copyright legal disclaimer paywall trending".split()
)
# Of these, the names of what is in an article only by accident, whatever it holds; the others also name
# sections of articles, and need evidence there. Words that beside them only tell of the layout.
STRONG_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "newsletter subscribe subscription breadcrumb breadcrumbs pagination pager popup modal overlay toolbar navbar "
    "sidebar contentinfo comment comments reply replies respond disqus login signup paywall".split()
)
LAYOUT = frozenset(
    "area bar block box btn button buttons card container content entry footer form group header inner item items links "
    "list main module outer panel post posts row section site title unit widget wrap wrapper".split()
)
# Text whose own class or id says nothing of what it is, without evidence.
PASSAGES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table tr td th dl dt dd".split())
# Words up to which an element with such a name is too short for a section; names kept of an element, and elements
# around a text whose names count.
SHORT, NAMES, AROUND = 12, 32, 32
# Elements that hold a page or its text: no class, id or role makes them boilerplate.
WHOLE = frozenset("html body main article".split())
# Words beside a name that tell of a state of the page ("no-sidebar", "comments-open"), not of what an element is.
STATES = frozenset("no not non has have with without is hide show open opened closed enabled disabled on off active".split())
# A header names boilerplate only outside an article.
HEADERS = frozenset(("header", "topbar"))

# Elements whose content is no text of the page, if they end: raw text goes on to the end of the page otherwise.
RAW = frozenset("script style textarea".split())
UNSEEN = frozenset("noscript template iframe svg object canvas video audio annotation annotation-xml".split())
ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW | UNSEEN}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^<>\"']+|\"[^\"]*\"|'[^']*')*+[^>]*)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)


@dataclass
class Block:
    """Text between two block ends, with the names that it stands under."""

    names: frozenset[str]
    boilerplate: bool
    container: int  # number of the outermost article or main element; 0 outside
    named: tuple[int, ...] = ()  # numbers of elements around it that a class, id or role made boilerplate
    parts: list[str] = field(default_factory=list)
    link_words: int = 0

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


@dataclass(frozen=True)
class Element:
    tag: str
    names: frozenset[str]
    boilerplate: bool
    container: int
    named: tuple[int, ...] = ()
    around: tuple[frozenset[str], ...] = ()  # names of the nearest elements


class Page:
    """Tag names ("/name" for ends) and blocks of text in page order. Elements are numbered by their start tags; names
    do not make those ``spared`` boilerplate. Time and memory go with the length of the page."""

    def __init__(self, page: str, spared: Set[int] = frozenset()) -> None:
        self.page, self.spared = page, spared
        self.stack, self.open = [Element("", frozenset(), False, 0)], Counter()
        self.containers = self.number = 0
        self.block: Block | None = None
        self.weak: set[int] = set()  # elements of an article that need evidence
        self.passages: set[int] = set()  # those of them that are no more than a passage
        self.endless: set[str] = set()

    def tokens(self) -> Iterator[str | Block]:
        page, at = self.page, 0
        while (m := TOKEN.search(page, at)) is not None:
            if m.start() > at:
                self.add(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                yield from self.end(tag)
                continue
            if tag in ENDS and not m[0].endswith("/>"):
                if tag in self.endless:
                    end = None
                elif (end := ENDS[tag].search(page, at)) is None:
                    self.endless.add(tag)
                if end is not None or tag in RAW:
                    at = len(page) if end is None else end.end()
                    continue
            elif tag in ENDS and tag not in RAW:
                continue
            yield from self.start(tag, m[3] or "")
        if at < len(page):
            self.add(page[at:])
        yield from self.flush()

    def flush(self) -> Iterator[Block]:
        if self.block is not None and self.block.parts:
            yield self.block
        self.block = None

    def add(self, raw: str) -> None:
        top, block = self.stack[-1], self.block
        words = len(raw.split())
        if block is None:
            if not words:
                return
            block = self.block = Block(top.names, top.boilerplate, top.container, top.named)
        elif words:
            # A block is as good as the best place of its text.
            block.names = block.names & top.names if block.boilerplate == top.boilerplate else block.names
            block.boilerplate &= top.boilerplate
        block.parts.append(raw)
        block.link_words += words if self.open["a"] else 0

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.open[tag] -= 1
        return tag

    def end(self, tag: str) -> Iterator[str | Block]:
        if tag == "br":
            yield from self.line_break()
            return
        if tag in BLOCKS:
            yield from self.flush()
        if self.open[tag]:
            while self.pop() != tag:
                pass
        yield "/" + tag

    def line_break(self) -> Iterator[str]:
        if self.block is not None:
            self.block.parts.append(" ")
        yield "br"

    def start(self, tag: str, attributes: str) -> Iterator[str | Block]:
        if tag == "br":
            yield from self.line_break()
            return
        if tag in BLOCKS:
            yield from self.flush()
        yield tag
        if tag in VOID:
            return
        if tag in BLOCKS and self.open["p"]:
            # An open paragraph ends here, and inline elements left open in it with it.
            while self.stack[-1].tag not in BLOCKS and len(self.stack) > 1:
                self.pop()
            if self.stack[-1].tag == "p":
                self.pop()
        if tag == "li" and self.stack[-1].tag == "li":
            self.pop()
        own, tokens, hidden = _names(tag, attributes)
        top = self.stack[-1]
        self.number += 1
        bad = hidden or tag in BOILERPLATE_TAGS or (tag in HEADERS and not top.container)
        named = top.named
        if not bad and self.number not in self.spared and (strength := condemned(tag, tokens, top.container > 0)):
            bad, named = True, (*named, self.number)[-AROUND:]
            if strength == "weak":
                self.weak.add(self.number)
                if tag in PASSAGES:
                    self.passages.add(self.number)
        container = top.container
        if tag in CONTAINERS and not container and not top.boilerplate and not bad:
            self.containers += 1
            container = self.containers
        around = (*top.around, frozenset(own))[-AROUND:] if own else top.around
        names = frozenset().union(*around) if own else top.names
        if top.boilerplate and not top.named:
            named = ()  # it is boilerplate whatever names say
        self.stack.append(Element(tag, names, top.boilerplate or bad, container, named, around))
        self.open[tag] += 1


def _names(tag: str, attributes: str) -> tuple[set[str], list[list[str]], bool]:
    """Names that an element brings, its classes, ids and roles as lists of words, and whether it is hidden."""
    names, tokens, hidden = set() if tag in GENERIC else {tag}, [], False
    for m in NAMED.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or (kind == "aria-hidden" and value == "true"):
            hidden = True
        elif kind == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif kind in ("class", "id", "role"):
            for token in value.split():
                words = re.findall(r"[^\W\d_]+", token)
                if not STATES.isdisjoint(words):
                    words = ["-".join(words)]
                if tag in WHOLE:
                    words = [w for w in words if w not in BOILERPLATE_NAMES and w not in HEADERS]
                if len(names) + len(words) <= NAMES:
                    names.update("." + w for w in words)
                    tokens.append(words)
    return names, tokens, hidden


def condemned(tag: str, tokens: list[list[str]], inside: bool) -> str:
    """Whether names take an element for boilerplate: "" (no), "weak" (if its content bears that out) or "strong".
    Outside an article each word of a name counts; inside, a name counts as a whole."""
    if not inside:
        words = {w for t in tokens for w in t}
        return "strong" if words & BOILERPLATE_NAMES or words & HEADERS else ""
    found = ""
    for t in tokens:
        named = [w for w in t if w in BOILERPLATE_NAMES]
        if named and all(w in BOILERPLATE_NAMES or w in LAYOUT for w in t):
            strong = any(w in STRONG_NAMES for w in named) and not (tag in PASSAGES and tag != "p")
            found = "strong" if strong else found or "weak"
    return found


def read_page(page: str, spared: Set[int] = frozenset()) -> list[str | Block]:
    return list(Page(page, spared).tokens())


def read_whole(page: str) -> list[str | Block]:
    """Tags and blocks of a page. Names do not make an element boilerplate that holds most of the words, unless an
    article or main element elsewhere has text; nor, inside an article, one that only shares its name with boilerplate:
    a passage, or a section of more than a few words, less than half of them links."""
    spared: set[int] = set()
    while True:
        reader = Page(page, spared)
        tokens = list(reader.tokens())
        blocks = [t for t in tokens if isinstance(t, Block)]
        words: Counter[int] = Counter()
        links: Counter[int] = Counter()
        total = 0
        for b in blocks:
            n = sum(len(x.split()) for x in b.parts)
            total += n
            for number in b.named if b.boilerplate else ():
                words[number] += n
                links[number] += b.link_words
        more = {i for i in reader.weak if words[i] and 2 * links[i] < words[i] and (words[i] > SHORT or i in reader.passages)}
        if not any(b.container for b in blocks):
            more |= {i for i, n in words.items() if 2 * n > total}
        if not more - spared:
            return tokens
        spared |= more


@dataclass(frozen=True)
class Weights:
    """Log-odds of the main text: a word's from the names it stands under, a tag's from its own name."""

    word: float
    names: dict[str, float]
    tags: dict[str, float]

    def of_block(self, block: Block) -> float:
        if block.boilerplate:
            # Left out in any case, so it hardly parts what stands around it.
            return BOILERPLATE_WORD
        score = self.word + sum(self.names.get(n, 0.0) for n in block.names)
        return min(max(score, WORD_RANGE[0]), WORD_RANGE[1])

    def of_tag(self, tag: str) -> float:
        name = tag.lstrip("/")
        if name in GENERIC:
            return GENERIC_TAG
        return self.tags.get(tag, TEXT_TAG if name in TEXT_TAGS else UNKNOWN_TAG)


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the highest sum, by one scan; (0, 0) if none is above zero."""
    best, best_run, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, best_run = total, (start, i + 1)
    return best_run


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the best region, and the others of the article element that most of it lies in."""
    if not page:
        return ""
    tokens = read_whole(page)
    texts = [t.text() if isinstance(t, Block) else "" for t in tokens]
    each = [weights.of_block(t) if isinstance(t, Block) else 0.0 for t in tokens]
    scores = [
        w * len(x.split()) if isinstance(t, Block) else weights.of_tag(t)
        for t, w, x in zip(tokens, each, texts, strict=True)
    ]
    start, end = best_region(scores)
    good = [i for i in range(start, end) if isinstance(tokens[i], Block) and each[i] > 0 and texts[i]]
    held: Counter[int] = Counter()
    for i in good:
        held[tokens[i].container] += scores[i]
    if held:
        container, most = held.most_common(1)[0]
        if container and 2 * most > sum(held.values()):
            whole = {
                i
                for i, t in enumerate(tokens)
                if isinstance(t, Block) and t.container == container and not t.boilerplate and texts[i]
            }
            good = sorted(whole.union(good))
    return "\n".join(texts[i] for i in good)


def page_counts(page: str | None) -> Counter:
    """(kind, name, 1 inside the named article or 0 outside) with counts; empty for pages without such an element."""
    counts: Counter = Counter()
    inside, found = 0, False
    for token in read_whole(page or ""):
        if isinstance(token, Block):
            good = int(bool(token.container) and not token.boilerplate)
            n = len(token.text().split())
            counts["word", "", good] += n
            for name in token.names:
                counts["name", name, good] += n
        else:
            bare = token.lstrip("/")
            if bare in CONTAINERS:
                found = True
                inside = max(0, inside + (1 if token == bare else -1))
            else:
                counts["tag", token, int(inside > 0)] += 1
    return counts if found else Counter()


def fit_weights(pages: DataFrame, column: str = "html", most: int = FIT_PAGES) -> Weights:
    """Weights from a sample of about ``most`` pages by hash (the bound of the fit), of which those with an article or
    main element count; the names and tags with the most counts are kept (4,096 of them)."""

    def count(batches):
        for batch in batches:
            total: Counter = Counter()
            for page in batch.column(0).to_pylist():
                total.update(page_counts(page))
            rows = [(k, n, g, c) for (k, n, g), c in total.items()]
            columns = list(zip(*rows, strict=True)) or [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["kind", "name", "good", "n"]
            )

    every = max(1, -(-pages.count() // most))
    sample = pages.select(quoted(column).alias("html")).where(F.pmod(F.xxhash64("html"), F.lit(every)) == 0)
    labelled = sample.where(F.lower("html").rlike("<(article|main)[\\s>]"))
    counts = labelled.mapInArrow(count, "kind string, name string, good int, n long")
    table = counts.groupBy("kind", "name").agg(
        F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("good") == 0, F.col("n")).otherwise(0)).alias("outside"),
    )
    rows = table.orderBy(F.desc(F.col("inside") + F.col("outside")), "kind", "name").limit(FIT_NAMES).collect()
    totals = next(((r["inside"], r["outside"]) for r in rows if r["kind"] == "word"), (0, 0))

    def odds(inside: int, outside: int, base: float, low: float, high: float) -> float:
        return min(max(math.log((inside + 1) / (outside + 1)) - base, low), high)

    base = math.log((totals[0] + 1) / (totals[1] + 1))
    names = {r["name"]: odds(r["inside"], r["outside"], base, -1.0, 1.0) for r in rows if r["kind"] == "name"}
    tags = {r["name"]: odds(r["inside"], r["outside"], 0.0, *TAG_RANGE) for r in rows if r["kind"] == "tag"}
    return Weights(min(max(base, 0.5), 1.0), names, tags)


def extract_text(pages: DataFrame, text: str = "html", weights: Weights | None = None, name: str = "text") -> tuple[DataFrame, str]:
    """``pages`` with the main text as one more column, and that column's name (``name``, or a free one like it).

    Character references are decoded, white space inside a block becomes one blank, blocks are joined by line ends. A
    NULL or empty page, and one without a word above zero, has the empty text. Without ``weights`` they are fitted
    on these pages.
    """
    weights = weights or fit_weights(pages, text)
    column = unused(pages.columns, name)

    def make():
        def step(column: pa.Array) -> list[str]:
            return [main_text(page, weights) for page in column.to_pylist()]

        return step

    return append(pages, [text], make, "string", column), column
