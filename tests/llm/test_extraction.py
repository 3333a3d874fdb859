import math
import os
import random
import re
import time

import pytest

from gridsight.llm.extraction import Page, _densities, extracted, main_text

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ARTICLE = "<p>First paragraph of the story, long enough to count as text.</p><p>Second  &amp;\n last <b>para</b>graph, also long.</p>"
TEXT = "First paragraph of the story, long enough to count as text.\nSecond & last paragraph, also long."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain &lt;b&gt; text", "plain <b> text"),
    (f"<nav>menu</nav><article>{ARTICLE}</article><footer>foot</footer>", TEXT),
    (f"<body><header>Site</header><main><h1>Title</h1>{ARTICLE}</main><aside>more</aside></body>", f"Title\n{TEXT}"),
    (f"<article><header><h1>Title</h1></header>{ARTICLE}<div class='share-buttons'>Share</div></article>", f"Title\n{TEXT}"),
    (f"<div id=top class='nav-bar'><a href=/>Home</a></div><div class=post><h2>Title</h2><div>{ARTICLE}</div></div>"
     "<ol class=commentlist><li>Great post, I liked it a lot, thank you for writing it</li></ol>", f"Title\n{TEXT}"),
    (f"<div class='cookie-notice'>We use cookies</div><div>{ARTICLE}</div><form>Subscribe <input></form>", TEXT),
    (f"<div>{ARTICLE}</div><script>var a = '<p>no</p>';</script><style>p {{}}</style><!-- <p>no</p> -->", TEXT),
    (f"<div>{ARTICLE}<!-- open comment <p>x</p>", TEXT),
    (f"<div>{ARTICLE}<script>open", TEXT),
    (f"<article><h1>T</h1><p><b>bold start<br>{ARTICLE}</article>", f"T\nbold start\n{TEXT}"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>caf&eacute;&nbsp;x &am &amp</article>", "one\ntwo\na\nb\ncafé x &am &"),
    (f"<form><article>{ARTICLE}</article></form>", TEXT),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    (f"<body class='has-sidebar'><article class='post'>{ARTICLE}</article></body>", TEXT),
])
def test_pages(page, text):
    assert main_text(page or "") == text


def test_every_section_of_an_article_without_landmark():
    section = "<section><p>" + "Some sentence of this section that is long. " * 3 + "</p><p>" + "Another one follows here now. " * 3 + "</p></section>"
    links = "<ul>" + "<li><a href=/x>Link text of a menu</a></li>" * 8 + "</ul>"
    got = main_text(f"<body><div>{links}</div><div>{section * 3}</div></body>")
    assert got.count("Another one follows here now. Another") == 3 and "Link" not in got


LONG = "Some sentence of this part that is long enough to count. " * 3


@pytest.mark.parametrize("page, lines", [
    ("<article><p>{0}a</p><p>{0}b</p><p>{0}c</p><p>{0}d</p></article><article><p>{0}e</p></article><article><p>{0}f</p></article>", "abcdef"),
    ("<div><article><p>{0}a</p><p>{0}b</p></article></div><div><ul><li><a href=/x>Link</a></ul><article><p>{0}c</p></article></div>", "abc"),
    ("<h1>{0}a</h1><article><p>{0}b</p><p>{0}c</p><p>{0}d</p><p>{0}e</p></article><p>{0}f</p>", "abcdef"),
    ("<div><p>{0}a</p><p>{0}b</p></div><div><ul><li><a href=/x>Link</a><li><a href=/y>Next</a></ul><main><p>{0}c</p></main></div>", "abc"),
])
def test_parts_outside_the_landmark_of_the_densest_element(page, lines):
    links = "<nav>" + "<a href=/x>Link text of a menu</a> " * 8 + "</nav>"
    got = main_text(f"<body>{links}{page.format(LONG)}{links}</body>")
    assert [x.removeprefix(LONG) for x in got.split("\n") if x.startswith(LONG)] == list(lines) and "menu" not in got


@pytest.mark.parametrize("opening, closing", [
    (LONG, LONG), (f"{LONG}<b>bold</b> and <i>more</i> {LONG}", f"In the end {LONG}"),
    (f"{LONG}<br>second {LONG}", f"and <a href=/x>one link</a> in {LONG * 5}"),
])
def test_text_directly_around_the_densest_element(opening, closing):
    paragraphs = f"<p>{LONG}</p>" * 4
    got = main_text(f"<body><nav>menu</nav><div>{opening}<br><br><div>{paragraphs}</div>{closing}</div></body>")
    plain = lambda x: " ".join(re.sub("<br>", " ", re.sub("</?[abi]\\b[^>]*>", "", x)).split())
    assert got.split("\n") == [plain(opening), *[LONG.strip()] * 4, plain(closing)]


def test_links_directly_around_the_densest_element_go():
    links = "<a href=/x>Link text</a> | " * 8
    got = main_text(f"<body>{links}<div><p>{LONG}</p><p>{LONG}</p></div>{links}</body>")
    assert got.split("\n") == [LONG.strip()] * 2


def test_headline_before_the_landmark():
    page = f"<nav>menu</nav><h1>Head</h1><article><p>{LONG}</p><p>{LONG}</p></article>"
    assert main_text(page).split("\n") == ["Head", LONG.strip(), LONG.strip()]


def test_weak_parts_of_a_landmark_stay():
    got = main_text(f"<body><article><h1>T</h1><p>{LONG}</p><p>ab</p><p><a href=/x>see</a></p></article></body>")
    assert got == f"T\n{LONG.strip()}\nab\nsee"


def test_long_page():
    body = "".join(f"<p>Paragraph {i} of a long page.</p>" for i in range(20_000))
    lines = main_text(f"<nav>x</nav><article>{body}</article>").split("\n")
    assert len(lines) == 20_000 and lines[-1] == "Paragraph 19999 of a long page."


def test_column(spark):
    df = spark.createDataFrame([(1, f"<article>{ARTICLE}</article>", "x"), (1, None, None)], "page_id int, html string, text string")
    assert sorted(r[0] for r in df.select(extracted("html")).collect()) == sorted([TEXT, ""])
    assert df.limit(0).select(extracted("html")).count() == 0


WRAPPERS = ["content-sidebar-wrap", "layout-2-sidebar", "share-price-report", "post overlay", "article-body promo",
            "content rail-left", "widget-content", "copyright-law"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_an_article_does_not_vanish_because_of_its_class(name):
    paragraphs = "".join(f"<p>{LONG}{i}</p>" for i in range(4))
    page = f"<body><nav>menu</nav><div class='ad'>Buy this thing now.</div><div class='{name}'>{paragraphs}</div><footer>foot</footer></body>"
    assert main_text(page).split("\n") == [f"{LONG}{i}" for i in range(4)]
    short = f"<body><div class='ad'>Buy this long and dense thing now, or never again.</div><div class='{name}'><h1>Head</h1><p>Few words<br></p></div></body>"
    assert main_text(short) == "Head\nFew words"


@pytest.mark.parametrize("name", WRAPPERS)
def test_supplied_pages_with_another_element_for_the_article(spark, name):
    for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("html").toLocalIterator():
        page = row.html or ""
        assert main_text(page.replace("<article>", f"<div class='{name}'>").replace("</article>", "</div>")) == main_text(page)


def test_named_parts_go_and_long_ones_beside_an_article_may_stay():
    paragraphs = f"<p>{LONG}</p>" * 4
    for name in ("sidebar-left", "cookie-notice-wrapper", "related-posts", "comment-list", "newsletter_box", "ad-container-2"):
        page = f"<div>{paragraphs}</div><div class='{name}'><p>{LONG}x</p><p>More.</p></div>"
        assert main_text(page).split("\n") == [LONG.strip()] * 4, name
    comments = f"<div class=comments>{'<p>I say: ' + LONG + '</p>'}</div>" * 9
    for name in ("post overlay", "sidebar-wrap"):
        assert main_text(f"<div class='{name}'>{paragraphs}</div>{comments}").split("\n") == [LONG.strip()] * 4
    assert main_text(f"<div>{paragraphs}<p class='alert-level-report'>{LONG}</p></div>").count("\n") == 4


def test_a_form_around_the_page():
    paragraphs = f"<p>{LONG}</p>" * 8
    assert main_text(f"<form><nav>menu</nav><div>{paragraphs}</div></form>").split("\n") == [LONG.strip()] * 8
    assert main_text(f"<div>{paragraphs}</div><form><p>Your name</p><p>Your mail</p></form>").split("\n") == [LONG.strip()] * 8


def test_weak_blocks_between_kept_ones_stay():
    page = f"<body><div><h1>T</h1><p><b>{LONG}<br></p><p>ab</p><p>{LONG}</p><p>cd</p></div><p><a href=/x>link</a></p></body>"
    assert main_text(page).split("\n") == ["T", LONG.strip(), "ab", LONG.strip(), "cd"]


@pytest.mark.parametrize("page", [
    "<a " * 350_000, '<a "' * 250_000, '<a ">" "' * 120_000, "<div>" * 100_000, "<p><table><td>" + "<div>" * 100_000,
    "<b>" * 50_000 + "</i>" * 100_000, "<div class=ad>z</div>" + "<b>x" * 50_000, "<!-- " * 200_000,
    "&#" + "1" * 9000 + ";x &#" + "0" * 6000 + "65;",
])
def test_broken_pages_take_time_in_proportion(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 10


def test_markup_that_never_ends_is_no_text():
    assert main_text(f"<p>{LONG}</p><a href='x") == LONG.strip()


class Plain:
    """The method by a tree and recursion, for well-formed pages without any part to be taken out."""

    def __init__(self, tag):
        self.tag, self.children = tag, []

    def text(self, linked=None):
        def of(node, link):
            link = link or node.tag == "a"
            for child in node.children:
                if isinstance(child, str):
                    yield len(" ".join(child.split())) if linked is None or link else 0
                else:
                    yield from of(child, link)
        return sum(of(self, False))

    def all(self):
        return [x for c in self.children if not isinstance(c, str) for x in [c, *c.all()]]

    def density(self, whole):
        chars, links = self.text(), self.text(True)
        if not chars:
            return 0.0
        tags, link_tags = max(len(self.all()), 1), max(sum(x.tag == "a" for x in self.all()), 1)
        base = math.log(chars / max(chars - links, 1) * max(links, 1) + whole * chars + math.e)
        return chars / tags * max(math.log(chars / max(links, 1) * tags / link_tags), 0) / math.log(base)


@pytest.mark.parametrize("seed", range(40))
def test_density_sums_equal_a_recursive_version(seed):
    chance = random.Random(seed)

    def grow(tag, depth):
        node = Plain(tag)
        for _ in range(chance.randint(1, 4)):
            if depth < 4 and tag in ("div", "section", "html") and chance.random() < 0.7:
                node.children.append(grow(chance.choice(["div", "section", "p"]), depth + 1))
            elif tag != "a" and chance.random() < 0.2:
                node.children.append(grow("a", depth + 1))
            elif not node.children or not isinstance(node.children[-1], str):
                node.children.append("word " * chance.randint(1, 30))
        return node

    def write(node):
        return "".join(c if isinstance(c, str) else f"<{c.tag}>{write(c)}</{c.tag}>" for c in node.children)

    root = grow("html", 0)
    page = Page(write(root))
    counts, density, sums = _densities(page, [False] * len(page.tags))
    nodes = [root, *root.all()]
    whole = root.text(True) / max(root.text(), 1)
    assert page.tags == [n.tag for n in nodes] and counts.chars == [n.text() for n in nodes]
    for node, d, s in zip(nodes, density, sums):
        assert d == pytest.approx(node.density(whole))
        assert s == pytest.approx(sum(c.density(whole) for c in node.children if not isinstance(c, str)))
