"""Operator 1 on hand-made pages, and against the known structure of the given ones."""

import html
import math
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from tallyhouse.llm.main_text import content_paths, extract_main_text, main_text
from tallyhouse.llm.queries import QUERIES
from tallyhouse.llm.workers import find_package

PAGES = {
    "": "",
    "just words": "just words",
    "<p>a &amp b&#x41;&nbsp; c": "a & bA c",
    "<nav>Home</nav><!-- x --><style>p{}</style>": "",
    "<div id=main><h2>T</h2><p>A long paragraph, with words. And more, words.</p><p>x</p></div><div class='sidebar'>links, here.</div>": (
        "T\nA long paragraph, with words. And more, words.\nx"
    ),
    "<body><header>Site</header><main><h1>T</h1><p>Body, <b>te</b>xt.<br>More\n text</p><div class='comments'><article><p>Nice!</p></article>"
    "</div><form><label>n</label></form></main><footer>c</footer></body>": "T\nBody, text. More text",
    "<article><p>a<script>\"</p>\"</script>b<p>c<ul><li>one<li>two</ul></article><scr": "a\nb\nc\none\ntwo",
    "<article><p title='a > b'>one</p><p hidden>no</p><aside>no</aside><div class='cookie-notice'>no</div></article>": "one",
    "<p>" + "word " * 50_000 + "</p>": ("word " * 50_000).strip(),
}


@pytest.mark.parametrize("page", list(PAGES), ids=range(len(PAGES)))
def test_page(page):
    assert main_text(page) == PAGES[page]


LONG = "A long paragraph, with words. And more, words of the article.", "Second paragraph, as long as the first one, or nearly so."
BODY = "<h1>T</h1>" + "".join(f"<p>{p}</p>" for p in LONG)
LAYOUTS = [
    f"<html class='has-header'><body class='single has-sidebar'><div>{BODY}</div><div class='sidebar'>Links, here.</div></body></html>",
    f"<body><div id='page' class='no-sidebar'><div class='ad'>Buy, now!</div><div>{BODY}</div></div><div class='footer'>c</div></body>",
    f"<body><article class='post comments-open'>{BODY}<div class='share'>Tell</div></article><div class='comments'><p>Nice, read!</p></div></body>",
    f"<body><div class='menu'>Home</div><main class='search-page'>{BODY}</main></body>",
    f"<body><div class='overflow-hidden'><div class='page-with-menu'>{BODY}<div class='newsletter'>Sign up.</div></div></div></body>",
]


@pytest.mark.parametrize("page", LAYOUTS, ids=range(len(LAYOUTS)))
def test_class_words_of_layouts(page):
    """Words like those of menus and notices on elements around the article leave it; on small elements they drop these."""
    assert main_text(page) == "\n".join(["T", *LONG])


LONGER = "".join(f"<p>I think that this is so, number {k}. And I have more to say, much more, as you see.</p>" for k in range(8))
BESIDE = [
    f"<body><div class='post'>{BODY}</div><div class='comments'>{LONGER}</div></body>",
    f"<body><article>{BODY}<section class='comments'>{LONGER}</section></article></body>",
    f"<body><article>{BODY}</article><section id='comments'><article>{LONGER}</article></section></body>",
    f"<body><div>{BODY}</div><div class='sidebar'>{LONGER}</div></body>",
    f"<body><div class='sidebar'><article>{LONGER}</article></div><article>{BODY}</article></body>",
    f"<body><main>{BODY}<div class='cookie-notice'>{LONGER}</div></main></body>",
    f"<body><article>{BODY}</article><div class='comments-wrapper'>{LONGER}</div></body>",
    f"<body><div class='elementor-widget'><article>{BODY}</article></div><div class='widget'>{LONGER}</div></body>",
    f"<body><article>{BODY}<ul class='tags'><li><a href='/t1'>t1</a><li><a href='/t2'>t2</a></ul></article></body>",
    f"<body><div class='content-sidebar-wrap'><article>{BODY}</article><div class='sidebar'>{LONGER}</div></div></body>",
]


@pytest.mark.parametrize("page", BESIDE, ids=range(len(BESIDE)))
def test_longer_parts_beside_the_article(page):
    """Comments, sidebars and notices go, however long they are; so do lists of links in the article."""
    assert main_text(page) == "\n".join(["T", *LONG])


def test_sibling_articles():
    page = f"<body><div class='menu'>Home</div><article>{BODY}</article><article><h2>U</h2><p>{LONG[1]}</p></article><footer>c</footer></body>"
    assert main_text(page) == "\n".join(["T", *LONG, "U", LONG[1]])


@pytest.mark.parametrize("part", ["<div><p>word, ", "<div class='no-sidebar'>", "<b><div>x. ", "<li><span>y</p>", "<div><td>z, "])
def test_deep_pages(part):
    started = time.perf_counter()
    main_text(part * 10_000 + "end.")
    assert time.perf_counter() - started < 4


def test_ratios_by_hand():
    """Three paths: paragraphs, a heading and links; only the paragraphs reach half of the spread."""
    paths, lengths = np.array([1, 2, 2, 2, 3, 3]), np.array([4.0, 300, 280, 310, 6, 5])
    marks, linked = np.array([0.0, 9, 8, 9, 0, 0]), np.array([0.0, 0, 0, 0, 6, 5])
    chosen, links = content_paths(paths, lengths, marks, linked)
    per_path = {1: 4.0, 2: 890 / 3, 3: 5.5}
    per_mark = {1: 0.0, 2: 26 / 3, 3: 0.0}
    kernel = [math.exp(-0.5 * d * d) for d in range(4)]

    def smooth(values, k):
        near = [(kernel[abs(i - k)], v) for i, v in enumerate(values) if abs(i - k) <= 3]
        return sum(w * v for w, v in near) / sum(w for w, _ in near)

    fused = [smooth([per_path[p] for p in paths], k) * (1 + smooth([per_mark[p] for p in paths], k)) for k in range(6)]
    mean = {p: np.mean([f for f, q in zip(fused, paths, strict=True) if q == p]) for p in (1, 2, 3)}
    assert chosen.tolist() == [bool(mean[p] >= 0.5 * np.std(fused)) and p != 3 for p in paths] and chosen[1:4].all()
    assert links.tolist() == [False] * 4 + [True] * 2


def test_frame(spark, table):
    find_package(spark)
    pages = table([(1, None, "clash"), (2, "<p>x</p>", "clash"), (2, "<p>x</p>", "clash"), (None, "", None)], "page_id long, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in extract_main_text(pages).collect()) == [(0, ""), (1, ""), (2, "x"), (2, "x")]
    assert extract_main_text(pages.limit(0)).count() == 0


def test_query(spark, sf_dir):
    """The given pages hold one article element of paragraphs, bold text and line breaks."""
    wanted = {}
    for r in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist():
        article = (r["html"] or "").partition("<article>")[2]
        article = article.partition("</article>")[0] if "</article>" in article else re.sub(r"<[^>]*$", "", article)
        article = re.sub(r"</?b>", "", article.replace("<br>", " "))
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"<[^>]+>", article)]
        wanted[r["page_id"]] = "\n".join(filter(None, parts))
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op1_main_text"](spark, sf_dir).collect()}
    assert got == {k: (t, len(t)) for k, t in wanted.items()}
