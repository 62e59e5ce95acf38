import math
import re
import time

import pyarrow.parquet as pq
import pytest

from feira.llm import html_text
from feira.llm.html_text import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p><p>no";</script>
</head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, please agree to them all.</div>
<div id="wrap"><{tag}><h1>Title &amp; more</h1>
<p><b>First   paragraph,&nbsp;long enough to be the text<br><p>Second one with <a href=x>a link</a> inside it
<div class="ad">Buy this now, it is a very long advert with many many words in it</div>
<ul><li>one<li>two</ul><blockquote>said</blockquote><table><tr><td>c1<td>c2</table>
<form><label>Name</label><input name=a></form></{tag}>
<aside><p>Side text which is also rather long and wordy, indeed it is.</p></aside></div>
<section id="comments"><p>A reader writes a very long comment about all this, longer than the text.</p></section>
<footer>&copy; Site</footer></body></html>"""
TEXT = """Title & more
First paragraph, long enough to be the text
Second one with a link inside it
one
two
said
c1
c2"""


@pytest.mark.parametrize("tag", ["article", "main", "div", "section"])
def test_article_of_a_page(tag):
    assert main_text(PAGE.format(tag=tag)) == TEXT


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("  \n ", ""),
        ("plain  text\n x &lt;b&gt;", "plain text x <b>"),
        ("<p>a<p>b", "a\nb"),
        ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"),
        ("</p></div><p>a</span></b>b", "ab"),
        ("<!-- <p>no</p> --><p>yes</p><!-- open", "yes"),
        ("<script>alert('x')", ""),
        ("<p hidden>no</p><p>yes &#233; &eacute;</p>", "yes é é"),
        ("<article><header><h1>Head</h1><p>by me</p></header><p>Body text</p></article>", "Head\nBody text"),
        ("<body><nav><a href=a>only menu</a></nav></body>", ""),
        ("<h1>a<h2>b</h2>c", "a\nb\nc"),
    ],
)
def test_cases(html, text):
    assert main_text(html) == text


def test_links_inside_the_article_are_left_out():
    related = "<ul>" + "".join(f"<li><a href=/{k}>Read number {k}</a>" for k in range(9)) + "</ul>"
    page = f"<article><p>{'long text ' * 40}</p>{related}<p>{'more text ' * 40}</p></article>"
    assert "Read number" not in main_text(page)
    assert main_text(page).count("\n") == 1


def test_content_split_over_containers():
    part = "<div><p>{}</p><p>{}</p></div>"
    body = "".join(part.format(f"text {k} " * 30, f"and {k} " * 30) for k in range(3))
    found = main_text(f"<body><div><div>{body}</div></div></body>")
    assert found.count("\n") == 5


def part(name, words, count=6, tag="section"):
    return f"<{tag}>" + "".join(f"<p>{name}{k} {'word ' * words}</p>" for k in range(count)) + f"</{tag}>"


@pytest.mark.parametrize("wrap", ["<body>{}</body>", "<body><div><div>{}</div></div></body>"])
@pytest.mark.parametrize("tag", ["section", "div"])
def test_parts_of_unequal_density(wrap, tag):
    links = "<div>" + "".join(f"<a href=/{k}>Read number {k}</a> " for k in range(9)) + "</div>"
    parts = [
        part("a", 125, tag=tag),
        "<div>By A. Writer</div>",
        part("b", 100, tag=tag),
        links,
        part("c", 30, count=2, tag=tag),
        part("d", 100, count=1, tag=tag),
        "<p>In short</p>",
    ]
    found = main_text(wrap.format("".join(parts)))
    names = [line.split()[0] for line in found.split("\n")]
    wanted = [f"{n}{k}" for n, count in (("a", 6), ("b", 6), ("c", 2), ("d", 1)) for k in range(count)]
    assert names == [*wanted, "In"]


WRAPPERS = [
    "<div class='has-sidebar'>{}</div>",
    "<div class='layout no-sidebar'><div id=x>{}</div></div>",
    "<div class='header-fixed page'>{}</div>",
    "<div class='post share-enabled'>{}</div>",
    "<form id=aspnetForm action=/>{}</form>",
    "<div role=form><table class=header><tr><td class='search nav'>{}</table></div>",
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_wrappers_of_the_article_stay(wrapper, tag):
    inner = f"<h1>Title</h1>{part('a', 30)}<div class='related-work'>{part('b', 30)}</div>"
    menu = "<div class='main-nav'>Some words <a href=a>Menu</a></div>"
    page = "<body>" + menu + wrapper.format(f"<{tag}>{inner}</{tag}>") + "<div class=sidebar>Side</div></body>"
    names = [line.split()[0] for line in main_text(page).split("\n")]
    assert names == ["Title", *[f"{n}{k}" for n in "ab" for k in range(6)]]


@pytest.mark.parametrize(
    "page",
    [
        "<article><p>A teaser</p></article><div class=header><article>{}</article></div>",
        "<main><div class=header><article>{}</article></div></main>",
        "<main><div class=search>{}</div><div id=comments><p>I say</p></div></main>",
        "<article><section class=widget>{}</section></article><p>Side</p>",
        "<div class='page comments'>{}</div><div class=nav>Menu</div>",
    ],
)
def test_marked_elements_that_hold_the_text_stay(page):
    found = main_text(f"<body>{page.format(part('a', 30))}</body>")
    assert [line.split()[0] for line in found.split("\n")] == [f"a{k}" for k in range(6)]


def test_marked_elements_beside_the_article_go():
    comment = "<article class=comment-body>" + "<p>I say a lot about this</p>" * 99 + "</article>"
    readers = f"<div id=comments>{comment}</div>"
    aside = f"<form><p>{'Fill in this. ' * 200}</p></form><div class='cookie-bar'>{'We use. ' * 200}</div>"
    for page in (readers + "<article><p>Short text</p></article>" + aside,
                 f"<div class=header><main><p>Short text</p></main></div>{readers}{aside}"):
        assert main_text(f"<body>{page}</body>") == "Short text"


def test_many_rows_and_long_pages(spark):
    long = "<p>" + "word " * 100_000 + "</p>"
    rows = [(1, "u", PAGE.format(tag="article"), "x")] * 2
    rows += [(2, None, None, "y"), (None, "v", "", "z"), (3, "w", f"<article>{long}</article>", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract(pages).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in found] == [
        (1, "u", len(TEXT)), (1, "u", len(TEXT)), (2, None, 0), (None, "v", 0), (3, "w", 499_999)
    ]
    assert extract(pages.where("false")).collect() == []


def test_unclosed_tags_take_linear_time():
    start = time.perf_counter()
    main_text("<p><b>x<i>" * 20_000 + "</u></em>" * 20_000)
    assert time.perf_counter() - start < 10


@pytest.mark.parametrize("piece", ["<p ", "</p ", "<!-- ", "<?", "<a href='", "<b a=\"x' ", "&#", "<script ", "<title><", "<", "<![CDATA["])
@pytest.mark.parametrize("end", ["", ">"])
def test_a_megabyte_of_unclosed_tags(piece, end):
    start = time.perf_counter()
    main_text(piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - start < 5


def test_text_before_a_tag_that_never_ends():
    assert main_text("<p>one</p>two < three <p fo") == "one\ntwo < three"
    assert main_text("<p>one</p><script>x <p") == "one"


PARAGRAPHS = [f"<p>text{k} {'some words of it ' * 20}</p>" for k in range(5)]
NOISE = {
    "copyright": "<div>\u00a9 2024 The Site. All rights reserved.</div>",
    "teasers": "<div>" + "<div><h3>Other</h3><p>Read this one.</p></div>" * 4 + "</div>",
    "cookies": "<div><p>We use cookies to make this site better. Do you accept?</p></div>",
    "menu": "<table><tr><td>Home<br>News<br>Sport</td></tr></table>",
    "thread": "<div>" + "<div><p>So true!</p></div>" * 8 + "</div>",
}


@pytest.mark.parametrize("short", ["", "<p>In short</p>", "<p>He said</p>"])
@pytest.mark.parametrize("noise", sorted(NOISE))
@pytest.mark.parametrize("before", [True, False])
def test_unmarked_noise_goes_short_paragraphs_stay(noise, before, short):
    """No class, id or tag tells what is noise; a short paragraph doesn't let it in."""
    article = f"<div><h1>Title</h1>{''.join(PARAGRAPHS[:3])}{short}{''.join(PARAGRAPHS[3:])}</div>"
    parts = [NOISE[noise], article] if before else [article, NOISE[noise]]
    lines = main_text(f"<body>{''.join(parts)}</body>").split("\n")
    words = ["Title", *[f"text{k}" for k in range(3)], *([short[3:5]] if short else []), "text3", "text4"]
    assert [line.split()[0] for line in lines] == words


def bare(html):
    """The page without article elements, classes and ids."""
    return re.sub(r"\s(?:class|id)=\"[^\"]*\"", "", re.sub(r"<(/?)article", r"<\1div", html))


@pytest.fixture(scope="module")
def pages():
    return pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()


def test_density_finds_the_article_without_marks(pages):
    """On 0.93 of the given pages; the rest have hardly more text than their advert."""
    same = sum(main_text(bare(html)) == main_text(html) for html in pages)
    assert same >= 0.9 * len(pages)


def test_sums_of_densities_choose_the_article(pages, monkeypatch):
    plain = html_text._densities

    def without_sums(tree):
        density, sums, chars, link_chars = plain(tree)
        return density, [0.0] * len(sums), chars, link_chars

    monkeypatch.setattr(html_text, "_densities", without_sums)
    same = sum(main_text(bare(html)) == main_text(html) for html in pages)
    assert same < 0.2 * len(pages)


def test_densities_against_the_formula(pages):
    """Counted from the nodes' own texts and ancestors, for every node."""
    for html in [PAGE.format(tag="div"), *pages[:10]]:
        tree = html_text._Tree()
        tree.feed(html)
        tree.close()
        tree.drop_doubted()
        density, sums, *_ = html_text._densities(tree)
        n = len(tree.tags)

        def above(k):
            while k >= 0:
                yield k
                k = tree.parents[k]

        live = [k for k in range(n) if not any(tree.dropped[a] for a in above(k))]
        own = {k: sum(len("".join(t.split())) for _, t in tree.texts[k]) for k in live}
        below = {k: [x for x in live if k in above(x)] for k in live}
        links = {k for k in live if any(tree.tags[a] == "a" for a in above(k))}

        def counts(k):
            c = sum(own[x] for x in below[k])
            t = len(below[k]) - 1
            lc = sum(own[x] for x in below[k] if x in links)
            lt = sum(tree.tags[x] == "a" for x in below[k] if x != k)
            return c, t, lc, lt

        body_c, _, body_lc, _ = counts(0)
        for k in live:
            c, t, lc, lt = counts(k)
            if not c:
                assert density[k] == 0
                continue
            base = math.log(c * lc / max(c - lc, 1) + c * body_lc / max(body_c, 1) + math.e)
            value = max(c / (lc or 1) * (t or 1) / (lt or 1), 1.0)
            assert density[k] == pytest.approx(c / (t or 1) * math.log(value) / max(math.log(base), 1.0))
        for k in live:
            assert sums[k] == pytest.approx(sum(density[x] for x in live if tree.parents[x] == k))
