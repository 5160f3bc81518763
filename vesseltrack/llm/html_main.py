"""Main text of web pages by tree scoring.

A page becomes a small tree of elements. Page furniture goes first: scripts,
styles, forms, navigation, asides, footers, page headers, and blocks *named* as
advert, menu, comment, notice and the like: a class, id or role whose words are
all such words or neutral ones (``related-posts``, ``userComments``,
``site-header``; not ``no-sidebar``, ``elementor-widget`` or ``social-science``). A
name never removes what holds an article or main element, nor, where most of the
text would go with named blocks, the way up from the best container. Every
paragraph then passes points (one per comma, one per hundred characters) to
its parent, half to its grandparent, a third to the next, and so on; a
container's sum is discounted by its link density (share of its text inside
links). The article or main element that the best container lies in is the
article; without one, everything on the page is, but for furniture and for
blocks and stretches of text beside the way up from the best container that
are mostly links. Its text is cut into blocks at block-level elements.

One map over pages, no shuffle; a page is handled on its own.

Edge cases: null and empty pages, and pages without text, give an empty text;
unclosed elements end where a block they cannot hold begins, else with their
parent; a comment, script or tag that the end of the page cuts off is left out;
repeated rows are handled row by row; columns other than the named ones pass.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow

# Classes of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noframes".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
                  "tfoot thead tr ul caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset("head nav footer aside form button select option input object svg canvas audio video dialog menu "
                      "map datalist meter progress link meta base".split())
JUNK = frozenset("ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promos promotion "
                 "banner banners sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer comment comments "
                 "commentlist disqus replies respond cookie cookies consent gdpr notice notices popup popups modal overlay "
                 "newsletter subscribe subscription signup share sharing social related recommended recommendations widget "
                 "widgets toolbar pagination pager login masthead outbrain taboola contentinfo complementary "
                 "alert alertdialog search skip".split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
# words that change nothing about what a name says
NEUTRAL = frozenset("site page main top bottom left right primary secondary global sticky mobile user list box block bar container "
                    "wrapper wrap section area slot unit link links button buttons form post posts articles story stories item items "
                    "inner outer header title bar row column group reader readers visitor discussion thread tree".split())
CONTAINERS = frozenset("# body main article section div".split())  # their direct text is scored as their own paragraph
KEEP = frozenset("html body article main".split())
CLOSES_P = BLOCK - {"html", "body", "tbody", "thead", "tfoot", "tr", "caption", "legend"}
# an open element of the first kind ends where one of the second begins, within the third
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
        "thead": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"})}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
REST = 0.25  # share of the text that must be left without named blocks


class Element:
    __slots__ = ("tag", "parent", "children", "junk", "named", "points", "chars", "linked")

    def __init__(self, tag: str, parent=None, junk: bool = False, named: str = ""):
        self.tag, self.parent, self.children, self.junk, self.named = tag, parent, [], junk, named
        self.points, self.chars, self.linked = 0.0, 0, 0

    def inside(self, tags) -> "Element | None":
        e = self
        while e is not None and e.tag not in tags:
            e = e.parent
        return e


def says(name: str, words: frozenset) -> bool:
    """Whether a class name consists of some of ``words``, and neutral words and numbers."""
    found = [w.lower() for w in _WORD.findall(name)]
    return any(w in words for w in found) and all(w in words or w in NEUTRAL or w.isdigit() for w in found)


def is_junk(tag: str, attributes: str, parent: Element) -> tuple[bool, str]:
    """Whether an element is furniture or hidden, and what beside the article it is named as: comments, other or nothing."""
    if tag in FURNITURE:
        return True, ""
    in_article = parent.inside(("article", "main")) is not None
    if tag == "header" and not in_article:
        return True, ""
    words = COMMENTS if tag in KEEP else JUNK if in_article else JUNK | {"header"}
    named = ""
    for name, a, b, c in _ATTR.findall(attributes) if attributes.strip() else ():
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            for n in unescape(value).split() if tag not in ("html", "body", "main") else ():
                if says(n, words):
                    named = "comments" if named == "comments" or says(n, COMMENTS) else "other"
        elif tag in KEEP:
            continue
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, ""
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            return True, ""
    return False, named


def _in_comments(e: Element) -> bool:
    while e is not None and e.named != "comments":
        e = e.parent
    return e is not None


def inner(e: Element):
    """The elements below, parents first."""
    stack = [c for c in e.children if not isinstance(c, str)]
    while stack:
        c = stack.pop()
        yield c
        stack.extend(d for d in c.children if not isinstance(d, str))


def settle(root: Element) -> None:
    """Decides which names count, and marks all that lies in junk."""
    elements = list(inner(root))
    for e in elements:  # furniture covers what it holds
        e.junk = e.junk or e.parent.junk
    for e in elements:
        if e.tag in ("article", "main") and not e.junk and not e.named and not _in_comments(e):
            up = e.parent
            while up is not None:
                up.named, up = "", up.parent
    if any(e.named for e in elements):
        best = score(root)
        total, left, stack = best.chars and root.chars if best is not None else 0, 0, [root]
        while stack:
            e = stack.pop()
            left += len(" ".join("".join(c for c in e.children if isinstance(c, str)).split()))
            stack.extend(c for c in e.children if not isinstance(c, str) and not c.junk and not c.named)
        if total and left < REST * total:
            while best is not None:
                best.named, best = "", best.parent
    for e in elements:
        e.junk = e.junk or e.named != "" or e.parent.junk
    for e in (root, *elements):
        e.points = 0.0


def parse(page: str) -> Element:
    """The tree of a page; text nodes are strings."""
    root = node = Element("#")
    at = 0
    lowered = None
    while True:
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            node.children.append(unescape(text) if "&" in text else text)
        if m is None:
            return root
        at = m.end()
        tag = m[2]
        if tag is None or not m[4]:
            continue
        tag = tag.lower()
        if m[1]:
            target = node.inside((tag,))
            # an inline end tag does not close the block around it
            if target is not None and (tag in BLOCK or not _block_between(node, target)):
                node = target.parent
            elif tag == "br":
                node.children.append(" ")
            continue
        if tag in CLOSES_P:
            p = node.inside(("p", "table", "td", "button"))
            if p is not None and p.tag == "p":
                node = p.parent
        if tag in ENDS:
            same, within = ENDS[tag]
            while (e := node.inside(same | within)) is not None and e.tag in same:
                node = e.parent
        if tag in HEADINGS and node.tag in HEADINGS:
            node = node.parent
        if tag == "br":
            node.children.append(" ")
            continue
        if tag in VOID:
            if tag in BLOCK:
                node.children.append(Element(tag, node))
            continue
        if tag in RAW:
            lowered = page.lower() if lowered is None and len(page.lower()) == len(page) else lowered
            end = (re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at) if lowered is None
                   else _find_end(lowered, tag, at))
            at = len(page) if end is None else end if isinstance(end, int) else end.start()
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
            continue
        e = Element(tag, node, *is_junk(tag, m[3], node))
        node.children.append(e)
        if not m[3].endswith("/") or tag in BLOCK:
            node = e


def _find_end(lowered: str, tag: str, at: int) -> int | None:
    while (at := lowered.find(f"</{tag}", at)) >= 0:
        after = lowered[at + 2 + len(tag):at + 3 + len(tag)]
        if after in ("", ">", "/") or after.isspace():
            return at
        at += 2
    return None


def _block_between(node: Element, target: Element) -> bool:
    while node is not target:
        if node.tag in BLOCK:
            return True
        node = node.parent
    return False


def score(root: Element) -> Element | None:
    """Sum points up the tree; the best container, None where no text is left."""
    order, stack = [], [root]
    while stack:
        e = stack.pop()
        if not e.junk:
            order.append(e)
            stack.extend(c for c in e.children if not isinstance(c, str))
    own = {}
    for e in reversed(order):
        text = "".join(c for c in e.children if isinstance(c, str))
        kept = [c for c in e.children if not isinstance(c, str) and not c.junk]
        n, commas = len(text) if text.strip() else 0, text.count(",")
        for c in kept:
            if c.tag not in BLOCK:  # inline text belongs to the paragraph around it
                n, commas = n + own[c][0], commas + own[c][1]
        own[e] = n, commas
        e.chars = len(" ".join(text.split())) + sum(c.chars for c in kept)
        e.linked = e.chars if e.tag == "a" else sum(c.linked for c in kept)
        if (e.tag in BLOCK or e.tag in ("td", "th", "#")) and n > 0:
            points, up, share = commas + n / 100, e if e.tag in CONTAINERS else e.parent, 1
            while up is not None:
                up.points += points / share
                up, share = up.parent, share + 1
    best = None
    for e in order:
        if e.points and (e.tag in BLOCK or e.tag == "#") and (best is None or weighed(e) > weighed(best)):
            best = e
    return best


def weighed(e: Element) -> float:
    return e.points * (1 - e.linked / e.chars) if e.chars else 0.0


def kept_parts(best: Element) -> list[Element]:
    """The article around the best container, or the page less what is mostly links beside the way up to its root."""
    around = best.inside(("article",))
    if around is not None:
        while (outer := around.parent.inside(("article",))) is not None:
            around = outer
        scope = around.inside(("main",)) or around.parent
        found = [e for e in inner(scope) if e.tag == "article" and not e.junk and e.parent.inside(("article",)) is None
                 and (e is around or e.parent is around.parent or scope.tag == "main") and (e is around or e.linked <= 0.5 * e.chars)]
        place = {id(e): i for i, e in enumerate(_in_page_order(scope))}
        return sorted(found, key=lambda e: place[id(e)])
    around = best.inside(("main",))
    if around is not None:
        return [around]
    e = best
    while e.parent is not None:
        e.parent.children = beside(e)
        e = e.parent
    return [e]


def _in_page_order(e: Element):
    stack = [e]
    while stack:
        c = stack.pop()
        yield c
        stack.extend(d for d in reversed(c.children) if not isinstance(d, str))


def beside(way: Element) -> list:
    """The children of the parent of ``way``: blocks of links are emptied, stretches of inline links left out."""
    out, run = [], []

    def flush():
        linked = sum(c.linked for c in run if not isinstance(c, str))
        if linked <= 0.3 * sum(len(" ".join(c.split())) if isinstance(c, str) else c.chars for c in run):
            out.extend(run)
        run.clear()

    for c in way.parent.children:
        if c is not way and (isinstance(c, str) or c.tag not in BLOCK and c.tag not in ("td", "th")):
            run.append(c)
            continue
        flush()
        if c is not way and c.tag not in HEADINGS and c.linked > 0.3 * c.chars:
            c.children = []
        out.append(c)
    flush()
    return out


def blocks(parts: list[Element]) -> list[str]:
    """Texts of the blocks in page order, white space within one turned into one blank."""
    out, run = [], []

    def flush():
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append(text)
            run.clear()

    stack = list(reversed(parts))
    while stack:
        e = stack.pop()
        if e is None:
            flush()
        elif isinstance(e, str):
            run.append(e)
        elif not e.junk:
            block = e.tag in BLOCK
            if block:
                flush()
                stack.append(None)
            elif e.tag in ("td", "th"):
                run.append(" ")
            stack.extend(reversed(e.children))
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    settle(root)
    best = score(root)
    return "\n\n".join(blocks(kept_parts(best))) if best is not None else ""


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars."""
    def run(batches):
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html")
    kind = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return map_arrow(rows, run, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars bigint")
