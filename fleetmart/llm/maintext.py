"""The main text of web pages by composite text density.

Method: boilerplate that its element or name gives away is taken out of the tree. For every remaining node the characters per tag, adjusted for link characters and link tags, are its density; the subtree whose children's densities have the
largest sum holds the article. The smallest density on the way from that subtree up to the body is the threshold from which
other parts of that way, and text right in it, count as well; an enclosing article or main element is taken as a whole, with its like beside it from
that threshold on. Articles below the subtree stand for it if they hold at least half of its text outside links.

Every page is handled on its own, in one pass without a shuffle.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id long, url string, text string, n_chars long"
#: Elements by their role in HTML; fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template svg math canvas iframe object embed audio video map nav footer aside form button "
    "select textarea input dialog menu title noembed noframes xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split())
#: An element ends an open one of these in the same list or table; fixed values.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
SCOPES = frozenset("html body table ul ol dl select article section div main td th".split())
WHOLE = frozenset(("article", "main"))
#: Within a form only these may stand around an article for it to count.
FRAMES = frozenset("form div section span p".split())
#: Parts of class and id names and roles of what is never part of an article: reader comments, notices, adverts; fixed values.
NEVER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promotions outbrain taboola "
    "comment comments commentlist disqus reply replies respond discussion cookie cookies consent gdpr notice notices "
    "notification alert popup newsletter subscribe subscription signup login".split())
#: Parts of names of what is around an article; those in OUTSIDE count only outside one. Such an element goes if the page has
#: running text without it.
NAMES = frozenset(
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs footer sidebar aside widget widgets related recommended "
    "recommendations share sharing social modal overlay search pagination pager toolbar skip copyright legal contentinfo "
    "complementary dialog teaser".split())
OUTSIDE = frozenset("header masthead topbar".split())
ARTICLE_NAMES = frozenset("related teaser".split())
#: Parts of names that tell a state: what stands behind the first, and what stands before the last, is no name of the element.
STATES = frozenset("has no with without hide show is not".split())
SET = frozenset("enabled disabled free open closed on off loaded visible hidden".split())
#: What an element's names say: it goes if there is running text without it, or it goes.
NAMED, GONE = 1, 2
#: Characters other than white space of a block, outside links, from which on it is running text: a sentence.
RUNNING = 40
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'\">]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^>]*+\Z|</[^>]*+>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_PARTS = re.compile(r"[^0-9a-z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "parent", "children", "items", "inside", "named", "chars", "link_chars", "tags", "link_tags", "density", "sum")

    def __init__(self, tag: str, parent: Node | None, inside: bool, named: int = 0):
        self.tag, self.parent, self.inside, self.named = tag, parent, inside, named
        self.children: list[Node] = []
        self.items: list[str | Node] = []


def boilerplate(tag: str, attributes: str, inside: bool) -> int:
    """GONE if an element is never part of an article, NAMED if its names say that it stands around one, else 0. inside: within an
    article or main element."""
    if tag in DROPPED or tag == "header" and not inside:
        return GONE
    if not attributes or tag in ("html", "body", "main"):
        return 0
    found = 0
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return GONE
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return GONE
        if key in ("class", "id", "role"):
            for word in value.split():
                parts = [x for x in _PARTS.split(_CAMEL.sub("-", word).lower()) if x]
                if parts and parts[-1] in SET:  # ads-enabled
                    continue
                state = next((k for k, x in enumerate(parts) if x in STATES), len(parts))  # has-sidebar, post-with-comments
                for x in parts[:state]:
                    if x in NEVER:
                        return GONE
                    if x in ARTICLE_NAMES if tag == "article" else x in NAMES or not inside and x in OUTSIDE:
                        found = NAMED
    return found


def parsed(page: str) -> Node:
    """The tree of a page without elements that go whatever their names; unclosed and misnested elements end as browsers end
    them, roughly."""
    root = node = Node("html", None, False)
    skipped: list[str] = []  # open elements within boilerplate
    at = 0

    def add(text: str) -> None:
        if text and not skipped:
            node.items.append(entities.unescape(text) if "&" in text else text)

    position = 0
    while True:
        match = _TOKEN.search(page, position)
        add(page[at:match.start() if match else len(page)])
        if not match:
            break
        at = position = match.end()
        closing, name, attributes = (match[1], match[2], match[3]) if match[2] else (match[4], match[5], match[6])
        if not name:
            continue
        tag = name.lower()
        if closing:
            if skipped:
                if tag in skipped:
                    while skipped.pop() != tag:
                        pass
                    continue
                if tag in INLINE or not _is_open(node, tag):
                    if tag in ("body", "html"):
                        skipped.clear()
                    continue
                skipped.clear()  # the end of an element around unclosed boilerplate ends that, too
            up = node
            while up is not root and up.tag != tag and (tag not in INLINE or up.tag in INLINE) and up.tag not in ("td", "th"):
                up = up.parent
            if up is not root and up.tag == tag:
                node = up.parent
            continue
        void = tag in VOID or attributes.endswith("/") and tag not in INLINE and tag in ("path", "circle", "rect", "use")
        if skipped:
            if tag in RAW:
                position = at = _raw_end(page, at, tag)
            elif tag in WHOLE and set(skipped) <= FRAMES:  # a form around the whole page
                skipped.clear()
            elif not void:
                _skip_ends(skipped, tag)
                skipped.append(tag)
            if skipped:
                continue
        if tag in ("html", "body"):
            if tag == "body" and node is root:
                node = _child(root, "body")
            continue
        if tag in CLOSES_P:
            node = _ended(node, ("p",))
        if tag in ENDS:
            node = _ended(node, ENDS[tag])
        named = boilerplate(tag, attributes, node.inside)
        if named == GONE or named and void:
            node.items.append(" ")
            if tag in RAW:
                position = at = _raw_end(page, at, tag)
            elif not void:
                skipped.append(tag)
            continue
        if void:
            if tag not in INLINE:
                node.items.append(" ")
            continue
        node = _child(node, tag, named)
    return root


def prune(root: Node) -> None:
    """Take out the elements that their names give away. If the rest of the page has neither running text nor an article, those
    stay that hold running text outside others of them, with what is around them; if none does, all stay. Then density decides."""
    nodes = _ordered(root)
    if not any(n.named for n in nodes):
        return
    # characters outside links by the nearest block, and the nearest named element around that
    running: dict[int, int] = {}
    holder: dict[int, tuple[Node, Node, bool]] = {id(root): (root, root, False)}
    article = False
    for node in nodes:
        if node is not root:
            around, block, linked = holder[id(node.parent)]
            holder[id(node)] = (node if node.named else around, block if node.tag in INLINE else node, linked or node.tag == "a")
        around, block, linked = holder[id(node)]
        if not linked:
            running[id(block)] = running.get(id(block), 0) + sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
            article = article or around is root and node.inside and running[id(block)] > 0
    runs = {id(holder[id(n)][0]) for n in nodes if running.get(id(n), 0) >= RUNNING}
    stay: set[int] = set()
    if not article and id(root) not in runs:
        if not runs:
            return
        for node in nodes:
            if node.named and id(node) in runs:
                while node is not None and id(node) not in stay:
                    stay.add(id(node))
                    node = node.parent
    for node in nodes:
        if any(c.named and id(c) not in stay for c in node.children):
            node.items = [" " if isinstance(x, Node) and x.named and id(x) not in stay else x for x in node.items]
            node.children = [c for c in node.children if not c.named or id(c) in stay]


def _is_open(node: Node, tag: str) -> bool:
    while node.parent is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def _skip_ends(skipped: list[str], tag: str) -> None:
    """Inside boilerplate paragraphs and list items end as outside."""
    if skipped and (tag in CLOSES_P and skipped[-1] == "p" or skipped[-1] in ENDS.get(tag, ())) and len(skipped) > 1:
        skipped.pop()


def _child(parent: Node, tag: str, named: int = 0) -> Node:
    child = Node(tag, parent, parent.inside or tag in WHOLE, named)
    parent.children.append(child)
    parent.items.append(child)
    return child


def _raw_end(page: str, at: int, tag: str) -> int:
    end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def _ended(node: Node, tags: tuple[str, ...]) -> Node:
    """The place after ending an open element of these tags, if one is open in the same scope."""
    up = node
    while up.parent is not None:
        if up.tag in tags:
            return up.parent
        if up.tag in SCOPES:
            break
        up = up.parent
    return node


def _ordered(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        found.append(node)
        stack.extend(reversed(node.children))
    return found


def _count(node: Node) -> None:
    own = sum(len("".join(x.split())) for x in node.items if isinstance(x, str))
    node.chars = own + sum(c.chars for c in node.children)
    node.tags = len(node.children) + sum(c.tags for c in node.children)
    linked = node.tag == "a"
    node.link_chars = node.chars if linked else sum(c.link_chars for c in node.children)
    node.link_tags = sum(c.link_tags + (c.tag == "a") for c in node.children)


def _dense(node: Node, root: Node) -> None:
    share = root.link_chars / max(1, root.chars)
    c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    if not c:
        node.density = 0.0
        return
    base = math.log(c / max(1, c - node.link_chars) * node.link_chars + share * c + math.e)
    node.density = c / t * math.log(max(1.0, c / lc * t / lt) + 1e-9) / math.log(max(base, 1.0) + 1e-9 + 1)


def measure(root: Node) -> list[Node]:
    """Set every node's density and sum of its children's densities."""
    nodes = _ordered(root)
    for node in reversed(nodes):
        _count(node)
    for node in nodes:
        _dense(node, root)
    for node in nodes:
        node.sum = sum(c.density for c in node.children) or node.density * 1e-3
    return nodes


def _own_text(node: Node, way: set[int]) -> list[Node | list]:
    """The children of a node, with its own text and the inline elements amid it as lists."""
    found: list[Node | list] = []
    run: list[str | Node] = []
    for item in [*node.items, None]:
        if isinstance(item, str) or item is not None and item.tag in INLINE and id(item) not in way:
            run.append(item)
            continue
        if any(isinstance(x, str) and x.strip() for x in run):
            found.append(run)
        else:
            found.extend(x for x in run if isinstance(x, Node))
        run = []
        if item is not None:
            found.append(item)
    return found


def _text_density(run: list[str | Node], root: Node) -> float:
    """The density of text that stands in no element of its own, as if it did."""
    element = Node("p", None, False)
    element.items, element.children = run, [x for x in run if isinstance(x, Node)]
    _count(element)
    _dense(element, root)
    return element.density


def _written(node: Node, out: list[str]) -> None:
    stack: list[Node | str] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        edge = [] if item.tag in INLINE else [" "]
        stack.extend(reversed([*edge, *item.items, *edge]))


def main_text(page: str | None) -> str:
    """The article's text; empty if the page is null or holds none."""
    if not page:
        return ""
    root = parsed(page)
    prune(root)
    nodes = measure(root)
    if not root.chars:
        return ""
    best = max(nodes, key=lambda n: n.sum)  # the first of equal ones
    whole, up = None, best
    while up is not None:
        whole = up if up.tag in WHOLE else whole
        up = up.parent
    way = [best]
    while way[-1].parent is not None:
        way.append(way[-1].parent)
    threshold = min(n.density for n in way)
    if whole is not None:  # with its like beside it
        chosen = {id(whole)} | {id(c) for c in whole.parent.children if c.tag in WHOLE and c.density >= threshold}
    else:  # the subtree may hold articles instead of lying in one
        held = [n for n in _ordered(best) if n.tag in WHOLE and not n.parent.inside and n.chars]
        if held and 2 * sum(n.chars - n.link_chars for n in held) >= best.chars - best.link_chars:
            chosen = {id(n) for n in held}
        else:
            chosen = {id(best)} | {id(c) for n in way[1:] for c in n.children if c not in way and c.density >= threshold}
    out: list[str] = []
    on_way = {id(n) for n in way[1:]} if id(best) in chosen and whole is None else set()
    stack: list[Node | list] = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, list):
            if _text_density(item, root) >= threshold:
                for part in item:
                    out.append(part) if isinstance(part, str) else _written(part, out)
                out.append(" ")
        elif id(item) in chosen:
            _written(item, out)
            out.append(" ")
        elif id(item) in on_way:
            stack.extend(reversed(_own_text(item, on_way | {id(best)})))
        else:
            stack.extend(reversed(item.children))
    return " ".join("".join(out).split())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """Every page's main text and its number of code points.

    pages: page_id, url, html; other columns are ignored. Menus, page headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and comments are left out; character references are decoded, white space inside a block becomes one
    blank, blocks are joined by one in page order. A null or empty page has an empty text. Repeated rows stay, an empty table
    gives no rows.
    """
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        _extracted, SCHEMA)
