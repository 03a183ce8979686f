"""Operator 1: main text of web pages by tag-path ratios.

Every text node has a tag path, from the root down to its element.  Per path of a page the text length and the punctuation
are summed over its nodes and divided by their number.  The two ratios are laid out in page order, smoothed with a Gaussian,
fused by their product, averaged per path again and compared with a threshold taken from their spread: paths above it are
content.  A third sum, of the text in links, leaves out paths of which most is links.

The content paths then name the elements that hold the article: article and main elements with content, or else the
innermost element with most of the content.  Of their blocks those on link paths go; headings and short paragraphs stay.

Elements that are menus, notices, forms and the like by tag or role never count.  Classes and ids are read word by word.  One
that only tells a layout (``no-sidebar``, ``comments-open``) says nothing.  One that names such a part (``comments``,
``cookie-notice``) leaves its element out, however long that is, unless the page's main element lies within.  One that mixes
both (``comments-wrapper``, ``search-page``) leaves its element out unless an article or first heading lies within, or next to
no content lies outside.  Nothing of this speaks against html, body, main and article.

Every step goes once over the elements, so deep pages cost as much as flat ones.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp template svg math object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 pre li dt dd blockquote td th figcaption address summary".split())
CLOSED_BY_BLOCK = frozenset({"p"})
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
ASIDE = frozenset("nav aside footer form button menu dialog head datalist fieldset audio video canvas map".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form status".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs footer sidebar aside widget widgets related recommended recommendations comment comments reply "
    "replies respond disqus discussion cookie cookies consent notice notices gdpr popup modal overlay alert newsletter subscribe "
    "subscription signup signin login share sharing social toolbar pagination pager copyright legal disclaimer skip search hidden".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？¿¡]")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Standard deviation, in nodes, of the smoothing; and the share of the ratios' spread that a content path reaches.
SMOOTHING, SPREAD = 1.0, 0.5
#: Share of the content that an element must hold to be looked into further.
MOST = 0.75
#: Content outside an element of doubtful class, as a share of that inside, up to which it surrounds the content.
OUTSIDE = 0.25
#: Share of a path's text that links may be.
LINKED = 0.5
FRAMES = frozenset("html body main article".split())
# Words that turn a class or id into a layout's: those that deny or state a part, and those that name a frame.
STATES = frozenset("no not has have with without open closed enabled disabled overflow".split())
LAYOUT = frozenset("page wrap wrapper content container main primary layout site body inner outer row col column columns grid results single".split())
#: Words that hold a page's article often enough that one within, or a first heading, speaks for the element.
GENERIC = frozenset("widget widgets overlay modal popup hidden search banner promo promotion".split())


class Node:
    """An element.  ``standing``: 0 says nothing, 1 is doubtful, 2 names a part beside the article by a generic word, 3 by another."""

    __slots__ = ("tag", "parent", "number", "path", "aside", "main", "in_main", "in_link", "block", "depth", "standing", "mass", "holds")

    def __init__(self, tag: str, parent: Node | None, number: int, path: int):
        self.tag, self.parent, self.number, self.path = tag, parent, number, path
        self.aside = bool(parent and parent.aside)
        self.main, self.standing, self.mass, self.holds = False, 0, 0.0, 0
        self.in_main = bool(parent and parent.in_main)
        self.in_link = tag == "a" or bool(parent and parent.in_link)
        self.depth = parent.depth + 1 if parent else 0
        self.block = parent.block if parent and tag in INLINE else self


def _standing(tag: str, names: str, in_main: bool) -> int:
    """What an element's class and id say."""
    out = 0
    for name in names.split():
        words = set(re.split(r"[_-]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()))
        parts = words & ASIDE_WORDS
        if "header" in words and tag not in ("h1", "h2") and not in_main:
            parts = parts | {"header"}
        if parts and not words & STATES:
            out = max(out, 1 if words & LAYOUT else 2 if parts <= GENERIC else 3)
    return out


def _judge(node: Node, attributes: str) -> None:
    """Sets whether an element is beside the article, whether it is one, and what its class or id says."""
    tag = node.tag
    main = tag in ("article", "main")
    aside = tag in ASIDE or tag == "header" and not node.in_main
    if attributes:
        found = {m[0].lower(): m[1] or m[2] or m[3] for m in ATTRIBUTE.findall(attributes)}
        role = found.get("role", "").lower()
        off = re.search(r"(?:^|\s)hidden(?:\s|=|$)", attributes) or "display:none" in found.get("style", "").replace(" ", "").lower()
        aside = bool(aside or role in ASIDE_ROLES or off or found.get("aria-hidden") == "true")
        if tag not in FRAMES:
            node.standing = _standing(tag, found.get("class", "") + " " + found.get("id", ""), node.in_main)
        main = main or role == "main" or found.get("itemprop") == "articleBody"
        if main and tag != "article":
            node.holds = 2
    node.aside = node.aside or aside
    node.main = main and not aside
    node.in_main = node.in_main or node.main
    if tag == "main":
        node.holds = 2
    elif tag in ("h1", "article"):
        node.holds = max(node.holds, 1)


def blocks(page: str) -> tuple[list[Node], list[tuple[Node, list[str], int]]]:
    """Elements in page order, and blocks of text: the innermost block element, its pieces of raw text, characters in links."""
    root = top = Node("", None, 0, 0)
    nodes, out, paths = [root], [], {}
    open_nodes: dict[str, list[Node]] = {}
    holder, pieces, linked = None, [], 0

    def text(raw: str) -> None:
        nonlocal holder, linked
        if raw and not top.aside:
            holder = holder or top
            pieces.append(raw)
            if top.in_link:
                linked += len(raw)

    def end_block() -> None:
        nonlocal holder, pieces, linked
        if pieces:
            out.append((holder, pieces, linked))
        holder, pieces, linked = None, [], 0

    def close(upto: Node) -> None:
        nonlocal top
        while top is not upto:
            open_nodes[top.tag].pop()
            top = top.parent
        open_nodes[top.tag].pop()
        top = top.parent

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name not in INLINE and name != "br":
            end_block()
        elif name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if m[1]:
            same = open_nodes.get(name)
            if same and (name not in INLINE or same[-1].depth > top.block.depth):
                close(same[-1])
            continue
        if name in RAW and not m[3].rstrip().endswith("/"):
            ending = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = ending.end() if ending else len(page)
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            while top.tag in INLINE and open_nodes.get("p") or top.tag in CLOSED_BY_BLOCK:
                close(top)
            if name in SIBLINGS:
                n = top
                while n.parent and n.tag not in SCOPES.get(name, ()):
                    if n.tag in SIBLINGS[name]:
                        close(n)
                        break
                    n = n.parent
        top = Node(name, top, len(nodes), paths.setdefault((top.path, name), len(paths) + 1))
        _judge(top, m[3])
        nodes.append(top)
        open_nodes.setdefault(name, []).append(top)
    end_block()
    return nodes, out


def _smooth(values: np.ndarray) -> np.ndarray:
    radius = int(3 * SMOOTHING)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SMOOTHING) ** 2)
    weights = np.convolve(np.ones(len(values)), kernel)[radius : radius + len(values)]
    return np.convolve(values, kernel)[radius : radius + len(values)] / weights


def content_paths(paths: np.ndarray, lengths: np.ndarray, marks: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of blocks: whether the smoothed, fused ratios of the path reach the threshold, and whether most of the path is links."""
    _, index = np.unique(paths, return_inverse=True)
    nodes = np.bincount(index)
    length_ratio = np.bincount(index, lengths) / nodes
    mark_ratio = np.bincount(index, marks) / nodes
    fused = _smooth(length_ratio[index]) * (1 + _smooth(mark_ratio[index]))
    per_path = np.bincount(index, fused) / nodes
    links = np.bincount(index, linked) > LINKED * np.bincount(index, lengths)
    threshold = min(SPREAD * fused.std(), fused.max())
    return (per_path >= threshold)[index] & ~links[index], links[index]


def _weigh(nodes: list[Node], found: list[tuple[Node, str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Chosen and link blocks; gives every element the length of its chosen blocks."""
    lengths = np.array([len(t) for _, t, _ in found], float)
    marks = np.array([len(PUNCTUATION.findall(t)) for _, t, _ in found], float)
    chosen, links = content_paths(np.array([n.path for n, _, _ in found]), lengths, marks, np.array([x for _, _, x in found], float))
    for node in nodes:
        node.mass = 0.0
    for (node, _, _), length, is_content in zip(found, lengths, chosen, strict=True):
        node.mass += length * is_content
    for node in reversed(nodes[1:]):  # children come behind their parents
        node.parent.mass += node.mass
    return chosen, links


def _inside(nodes: list[Node], tops: list[bool]) -> list[bool]:
    """Whether elements are, or lie in, one of the given ones."""
    for node in nodes[1:]:
        tops[node.number] = tops[node.number] or tops[node.parent.number]
    return tops


def _beside(nodes: list[Node], found: list[tuple[Node, str, int]]) -> list[bool]:
    """Whether elements lie in one that its class or id puts beside the article."""
    for node in reversed(nodes[1:]):
        node.parent.holds = max(node.parent.holds, node.holds)
    named = _inside(nodes, [n.standing == 3 and n.holds < 2 or n.standing == 2 and not n.holds for n in nodes])
    rest = [f for f in found if not named[f[0].number]]
    if rest and any(n.standing == 1 for n in nodes):
        _weigh(nodes, rest)
        total = nodes[0].mass
        named = _inside(nodes, [x or n.standing == 1 and not n.holds and total - n.mass > OUTSIDE * n.mass for x, n in zip(named, nodes, strict=True)])
    return named


def main_text(page: str | None) -> str:
    """The article's blocks joined by line breaks; empty for a null page or one without text."""
    nodes, raw = blocks(page or "")
    found = []
    for node, pieces, linked in raw:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            found.append((node, text, min(linked, len(text))))
    beside = _beside(nodes, found)
    found = [f for f in found if not beside[f[0].number]]
    if not found:
        return ""
    chosen, links = _weigh(nodes, found)
    mains = [n.main and n.mass > 0 for n in nodes]
    if any(mains):
        held = _inside(nodes, mains)
        return "\n".join(t for (node, t, _), is_link in zip(found, links, strict=True) if held[node.number] and not is_link)
    heavy: dict[int, Node] = {}
    for node in nodes[1:]:
        best = heavy.get(node.parent.number)
        if best is None or node.mass > best.mass:
            heavy[node.parent.number] = node
    top = nodes[0]
    while (below := heavy.get(top.number)) is not None and below.tag not in LEAF and below.tag not in INLINE and 0 < below.mass >= MOST * top.mass:
        top = below
    held = _inside(nodes, [n is top for n in nodes])
    kept = [k for k, (node, _, _) in enumerate(found) if held[node.number]]
    content = [k for k in kept if chosen[k]]
    first, last = (content[0], content[-1]) if content else (0, -1)
    heading = re.compile("h[1-6]").fullmatch
    while first > kept[0] and heading(found[first - 1][0].tag):
        first -= 1
    return "\n".join(found[k][1] for k in kept if first <= k <= last and not links[k])


def extract_main_text(pages: DataFrame, page: str = "html", text: str = "text") -> DataFrame:
    """Adds the main text of every whole page, replacing a column of that name.

    A null or empty page, or one without article text, has an empty text.  Unclosed elements end where HTML ends them; a
    page cut off inside a tag loses that tag.  A page all of which lies beside an article has an empty text.  Repeated rows stay; an empty table gives an empty one.
    """
    out = pages.drop(text) if text != page else pages
    schema = T.StructType([*out.schema.fields, T.StructField(text, T.StringType())]) if text != page else out.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                column = part.column(part.schema.get_field_index(page))
                texts = pa.array([main_text(v.as_py()) for v in column], pa.string())
                if text == page:
                    yield part.set_column(part.schema.get_field_index(page), page, texts)
                else:
                    yield part.append_column(text, texts)

    return out.mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """Per page its main text and the number of code points."""
    rows = extract_main_text(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
