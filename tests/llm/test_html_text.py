"""Main text of pages."""

import random
import time

import pytest

from tamiz.llm.html_text import Weights, best_region, extract_text, fit_weights, main_text

PAGES = "page_id long, url string, html string"
PLAIN = Weights(1.0, {}, {})
SHELL = (
    '<!DOCTYPE html><html><head><title>{t}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/a">menu one</a></li><li><a href="/b">two</a></li></ul></nav><!-- ad <p>no</p> -->'
    '<div class="ad">buy this now and that too</div>{body}<footer>&copy; site words here</footer></body></html>'
)


def page(title, paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return SHELL.format(t=title, body=f"<article><h1>{title}</h1>{body}</article>")


@pytest.mark.parametrize("seed", range(5))
def test_best_region_is_the_best(seed):
    rng = random.Random(seed)
    for _ in range(200):
        scores = [rng.randint(-5, 5) for _ in range(rng.randint(0, 15))]
        start, end = best_region(scores)
        best = max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[start:end]) == best


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (page("A title", ["one two &amp; three", "  four\n\tfive<br>six  ", ""]), "A title\none two & three\nfour five six"),
        (
            '<div class="sidebar"><p>a b c d</p></div><div class="content"><h1>T</h1><p>one two three four</p>'
            '<div class="ad">buy now now now</div><p>five</p><section id="comments"><p>great post great post</p></section></div>',
            "T\none two three four\nfive",
        ),
        (
            "<main><header><h1>T</h1></header><p>x y</p><form>name <input> send</form><aside>side words</aside>"
            "<p hidden>gone</p><div class='cookie-notice'>we use cookies</div>tail<div class=comments><p>nice</p></div></main>",
            "T\nx y\ntail",
        ),
        ("<article><p><b>open one<br><p>two</article><footer>f</footer>", "open one\ntwo"),
        ("<article><p>cut off in <a href='x", "cut off in"),
        ("a &lt;b&gt; c < d <p>e", "a <b> c < d\ne"),
        ("<p>x<style>p{color:red}", "x"),
        ("", ""),
        (None, ""),
        ("<nav>only menu</nav>", ""),
        ("<article>" + "<div>" * 3000 + "deep", "deep"),
    ],
)
def test_pages(html, want):
    assert main_text(html, PLAIN) == want


def test_long_and_broken_pages_end():
    assert main_text("<" * 50_000, PLAIN) == "<" * 50_000
    assert main_text("<a " + "'" * 50_000, PLAIN) == ""
    assert main_text("<!--" * 20_000, PLAIN) == ""
    assert len(main_text("<p>word " * 50_000, PLAIN).split("\n")) == 50_000


def test_table(spark):
    pages = [page(f"title {i}", [f"text number {i}", "more of it"]) for i in range(30)]
    rows = [(i, "u", p) for i, p in enumerate(pages)] + [(90, "u", None), (91, None, ""), (None, "u", pages[0]), (1, "u", pages[1])]
    df = spark.createDataFrame([(*r, "t") for r in rows], PAGES + ", text string").repartition(3)
    weights = fit_weights(df)
    assert weights.names["p"] > 0 > weights.names["a"] and weights.tags["li"] < weights.tags["p"] < 0
    out, column = extract_text(df)
    assert column == "text_" and out.columns == [*df.columns, "text_"]
    got = {(r["page_id"], r["url"]): r["text_"] for r in out.collect()}
    assert got[7, "u"] == "title 7\ntext number 7\nmore of it" and got[90, "u"] == "" and got[91, None] == ""
    empty, column = extract_text(df.limit(0))
    assert empty.collect() == []


STORY = "<h1>T</h1><p>one two three four five</p><p>six seven</p>"


@pytest.mark.parametrize(
    "html",
    [
        f'<html class="no-sidebar"><body class="search no-sidebar">{STORY}</body></html>',
        f'<body><article class="post comments-open related">{STORY}</article></body>',
        f'<body><div id="page" class="has-related">{STORY}</div></body>',
        f'<body><div class="widget"><div class="share">{STORY}</div><div class="ad">buy now</div></div></body>',
        f'<body><main id="search">{STORY}</main><div class="comments"><p>{"nice post " * 50}</p></div></body>',
    ],
)
def test_names_do_not_condemn_the_whole_page(html):
    assert main_text(html, PLAIN) == "T\none two three four five\nsix seven"


@pytest.mark.parametrize(
    "html",
    [
        "<body><article><p>one two three four five six</p></article><article><p>seven eight nine</p></article></body>",
        "<body><p>one two three four</p><article><p>five six seven eight nine ten</p></article></body>",
    ],
)
def test_region_beyond_one_article(html):
    """The article element with most of the region does not cut off the rest of it."""
    words = "one two three four five six seven eight nine ten".split()
    assert main_text(html, PLAIN).split() == [w for w in words if w in html]


def test_article_extends_the_region():
    """A short block of the article behind a gap of many tags."""
    gap = "<div><hr></div>" * 30
    assert main_text(f"<article><p>one two three four five</p>{gap}<p>end</p></article>", PLAIN).split()[-1] == "end"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<article><p>one <svg class="i"/> two</p><p>three</p></article>', "one two\nthree"),
        ('<article><p>one <svg class="i"><title>icon</title><path d="M0"/></svg> two</p><p>three</p></article>', "one two\nthree"),
        ('<article><p>one <svg class="i"> two</p><p>three</p></article>', "one two\nthree"),
        ("<article><p>for <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> holds</p></article>", "for x=2 holds"),
        ("<article><p>one</p><iframe src='a'></iframe><p>two</p><video><p>no video</p></video><object data='b'></article>", "one\ntwo"),
        ("<article><p>one</p><noscript><p>turn it on</p></noscript><p>two</p><template>t</template></article>", "one\ntwo"),
        ("<article><p>one</p><script>if (a < b) '</p>'</script><p>two</p><SCRIPT>never ends", "one\ntwo"),
    ],
)
def test_foreign_and_unseen_elements(html, want):
    assert main_text(html, PLAIN) == want


SECTION = "<p>" + "words of a section that goes on for some time and says what it has to say " * 2 + "</p>"


@pytest.mark.parametrize(
    "part",
    [
        f'<section id="discussion">{SECTION}</section>',
        f'<h2 id="related-work">{SECTION[3:-4]}</h2>',
        f'<div class="legal-history">{SECTION}</div>',
        '<p class="search-notes">a few words</p>',
        '<p class="share">she had her share</p>',
        f'<div class="notice">{SECTION}</div>',
        f'<section id="copyright" class="section">{SECTION}</section>',
    ],
)
def test_sections_whose_names_are_like_those_of_boilerplate_stay(part):
    text = main_text(f"<article><h1>T</h1><p>one two three</p>{part}<p>end</p></article>", PLAIN)
    words = [w for w in " ".join(x.split(">")[-1] for x in part.split("<")).split()]
    assert text.split() == ["T", "one", "two", "three", *words, "end"]


@pytest.mark.parametrize(
    "part",
    [
        '<div class="share"><a href="a">this page</a> <a href="b">that page</a></div>',
        '<div class="social-links">tell friends</div>',
        f'<div class="related"><a href="a">{SECTION[3:-4]}</a></div>',
        f'<section id="comments">{SECTION}</section>',
        f'<div class="comments-area">{SECTION}</div>',
        f'<div class="cookie-notice">{SECTION}</div>',
        f'<div class="ad">{SECTION}</div>',
        '<p class="advert">buy now</p>',
        '<ul class="breadcrumbs"><li>home<li>news</ul>',
    ],
)
def test_boilerplate_in_an_article_goes(part):
    assert main_text(f"<article><h1>T</h1><p>one two three</p>{part}<p>end</p></article>", PLAIN) == "T\none two three\nend"


def seconds(html):
    start = time.perf_counter()
    main_text(html, PLAIN)
    return time.perf_counter() - start


@pytest.mark.parametrize(
    "made",
    [
        lambda n: "<article>" + "<div>" * n + "deep",
        lambda n: "<article>" + "".join(f'<div class="c{i}"><b>word' for i in range(n)),
        lambda n: "<article>" + "<p>a<i>" * n + "</i>" * n,
        lambda n: "<article>" + "<svg>a" * n,
        lambda n: "<article>" + '<div class="share">x' * (n // 10),
    ],
)
def test_deep_and_odd_pages_take_time_by_their_length(made):
    seconds(made(2000))
    small, large = min(seconds(made(20_000)) for _ in range(2)), seconds(made(200_000))
    assert large < 25 * small + 0.5
