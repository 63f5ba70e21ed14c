"""Main text of web pages by composite text density.

Each page becomes a tree. Subtrees that are never article text (scripts,
styles, menus, forms, and elements whose class, id or role says notice, advert,
sidebar or comments) are pruned, unless they hold the page's largest article or
main element or, without one, nearly all of its text. Every remaining node gets
its characters and tags, those inside links apart, and a link-adjusted
characters-per-tag density; a block's sum is the sum of the densities of the
blocks in it, or its own density if it has none. The block of the largest sum
below the body is the core of the article; the smallest density on its path to
the body is the threshold. Beside that path, subtrees are article text too where
their density reaches the threshold and their densest block is comparable to
the core's; each gives its block of the largest sum. Article and main elements
that hold the core, or most of the text found, stand for it.

Edge cases: null or empty html, and pages without text, give the empty text and
0 characters; repeated rows give repeated results; markup that never closes is
closed where a browser would; a page without a body element is all body.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot legend summary".split())
# What never holds article text: elements, roles, and words of class and id.
PRUNED_TAGS = frozenset(
    "head title script style noscript template iframe object embed svg canvas audio video nav header footer aside form "
    "button select option textarea input menu dialog".split()
)
PRUNED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
PRUNED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent notice notices gdpr popup "
    "modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies "
    "share sharing social related recommended pagination pager toolbar".split()
)

# Words that may stand beside those in one class or id, as in site-footer; has-sidebar or menu-open say something else.
NEUTRAL_WORDS = frozenset("area bar block box button buttons container group inner item items links list main page post posts section site top bottom left right wrapper".split())
# Never text, whatever they hold.
HARD_TAGS = frozenset("head title script style noscript template iframe object embed svg canvas audio video button select option textarea input".split())
MARKS = ("article", "main")
# Parts of a page's layout.
CONTAINERS = frozenset("article body center div main section table tbody td tfoot th thead tr".split())
MOST = 0.8  # of a page's text outside links: what holds so much is not beside the article
COMPARABLE = 0.4  # of the core's density, for the densest block of text beside it

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "items", "pruned", "hard", "mass", "chars", "tags", "link_chars", "link_tags", "density", "block", "parts", "total", "peak")

    def __init__(self, tag: str, parent: Node | None, pruned: bool, hard: bool = False):
        self.hard = hard
        self.tag, self.parent, self.pruned = tag, parent, pruned
        self.items: list[Node | str] = []


def _named(value: str) -> bool:
    """Whether one of the names of a class or id says that its element is beside the article."""
    for name in value.split():
        words = {w.lower() for w in WORD.findall(name)}
        if name.lower() in PRUNED_WORDS or not words.isdisjoint(PRUNED_WORDS) and words <= PRUNED_WORDS | NEUTRAL_WORDS:
            return True
    return False


def _pruned(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is pruned, and whether that holds whatever is in it."""
    if tag in PRUNED_TAGS:
        return True, tag in HARD_TAGS
    if tag in ("html", "body", "article", "main") or not attributes.strip():
        return False, False
    pruned = False
    for match in ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        value = match[2] or match[3] or match[4] or ""
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, True
        if name == "role" and value.lower() in PRUNED_ROLES or name in ("class", "id") and _named(value):
            pruned = True
    return pruned, False


def parse(html: str) -> Node:
    """The tree of a page. Only nesting rules that move text between blocks are applied."""
    tree = _Open(Node("html", None, False))
    root, at, length = tree.top, 0, len(html)
    while at < length:
        match = MARKUP.search(html, at)
        if match is None:
            tree.top.items.append(html[at:])
            break
        if match.start() > at:
            tree.top.items.append(html[at : match.start()])
        at = match.end()
        if match[1]:  # an end tag closes its element if that is open in the same block
            tag = match[1].lower()
            if tag not in ("html", "body"):  # what follows these is in the body too
                tree.end(tag)
            continue
        if not match[2]:
            continue
        tag, attributes = match[2].lower(), match[3]
        if tag == "html":
            continue
        if tag in CLOSES_P:
            tree.close(("p",), ("table", "button", "td", "th"))
        if tag == "li":
            tree.close(("li",), ("ul", "ol", "menu"))
        elif tag in ("dd", "dt"):
            tree.close(("dd", "dt"), ("dl",))
        elif tag in ("td", "th"):
            tree.close(("td", "th"), ("tr", "table"))
        elif tag == "tr":
            tree.close(("tr",), ("table",))
        elif tag == "option":
            tree.close(("option",), ("select",))
        elif tag == "body":
            tree.close(("head",), ())
        node = Node(tag, tree.top, *_pruned(tag, attributes))
        tree.top.items.append(node)
        if tag in VOID or attributes.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            stop = end.start() if end else length
            node.items.append(html[at:stop])
            close = html.find(">", stop) if end else -1
            at = close + 1 if close >= 0 else length
            continue
        tree.open(node)
    return root


class _Open:
    """The open elements and how many there are of each tag, so that none is looked for that is not there."""

    def __init__(self, root: Node):
        self.top, self.counts = root, {}

    def open(self, node: Node) -> None:
        self.top = node
        self.counts[node.tag] = self.counts.get(node.tag, 0) + 1

    def _pop(self, node: Node) -> None:
        """Close ``node`` and what is open in it."""
        parent = node.parent
        while self.top is not parent:
            self.counts[self.top.tag] -= 1
            self.top = self.top.parent

    def close(self, tags: tuple[str, ...], barriers: tuple[str, ...]) -> None:
        """Close the innermost of ``tags`` that is open within the nearest of ``barriers``."""
        if not any(map(self.counts.get, tags)):
            return
        node = self.top
        while node.parent is not None and node.tag not in barriers:
            if node.tag in tags:
                self._pop(node)
                return
            node = node.parent

    def end(self, tag: str) -> None:
        if not self.counts.get(tag):
            return
        node = self.top
        while node.tag != tag:
            if tag not in BLOCK and node.tag in BLOCK:
                return  # an inline end tag does not close blocks
            node = node.parent
        self._pop(node)


def _order(root: Node, soft: bool = False) -> list[Node]:
    """Unpruned nodes in page order, parents before children; no recursion, however deep the page.

    With ``soft`` also those that are pruned only by what they are called.
    """
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(x for x in reversed(node.items) if isinstance(x, Node) and not (x.hard if soft else x.pruned))
    return order


def _path(node: Node, top: Node | None = None) -> list[Node]:
    """A node and what it is in, up to ``top`` or the root."""
    path = [node]
    while path[-1] is not top and path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def restore(root: Node) -> None:
    """Unprune what holds the largest article or main element or, without one, most of the text."""
    order = _order(root, soft=True)
    if not any(n.pruned for n in order):
        return
    for node in reversed(order):
        node.mass = 0
        for item in node.items:
            if isinstance(item, str):
                node.mass += len(SPACE.sub("", item))
            elif not item.hard and item.tag != "a":
                node.mass += item.mass
    largest = max((n for n in order if n.tag in MARKS and n.mass), key=lambda n: n.mass, default=None)
    if largest is not None:
        for node in _path(largest):
            node.pruned = False
    else:
        for node in order:
            if node.mass and node.mass >= MOST * root.mass:
                node.pruned = False


def measure(root: Node) -> list[Node]:
    """Characters, tags, densities and density sums of all unpruned nodes."""
    restore(root)
    order = _order(root)
    for node in reversed(order):
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        for item in node.items:
            if isinstance(item, str):
                node.chars += len(SPACE.sub("", item))
            elif not item.pruned:
                node.chars += item.chars
                node.tags += item.tags + 1
                if item.tag == "a":
                    node.link_chars += item.chars
                    node.link_tags += item.tags + 1
                else:
                    node.link_chars += item.link_chars
                    node.link_tags += item.link_tags
    body_chars, body_links = max(root.chars, 1), root.link_chars
    for node in reversed(order):
        plain = max(node.chars - node.link_chars, 1)
        tags, link_chars, link_tags = max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if node.chars:
            base = math.log(node.chars / plain * node.link_chars + body_links / body_chars * node.chars + math.e)
            node.density = node.chars / tags * math.log(max(node.chars / link_chars * tags / link_tags, 1.0)) / math.log(max(base, 1.0) + 1)
        else:
            node.density = 0.0
        parts = [x for x in node.items if isinstance(x, Node) and not x.pruned and x.block]
        node.block, node.parts = bool(parts) or node.tag in BLOCK, parts
        node.total = sum(x.density for x in parts) if parts else node.density
        node.peak = max((x.peak for x in parts), default=node.density)
    return order


def _runs(body: Node) -> None:
    """Put text, and blocks that are not layout, that lie in the body between parts of the layout into blocks of their own.

    Lists and paragraphs of links for the most part count as layout.
    """

    def layout(item: Node | str) -> bool:
        return isinstance(item, Node) and not item.pruned and item.block and (item.tag in CONTAINERS or not CONTAINERS.isdisjoint(x.tag for x in item.parts) or 2 * item.link_chars > item.chars)

    if not any(layout(x) and x.chars for x in body.items):
        return
    items: list[Node | str] = []
    run: Node | None = None
    for item in body.items:
        if layout(item):
            items.append(item)
            run = None
            continue
        if run is None:
            run = Node("div", body, False)
            items.append(run)
        run.items.append(item)
        if isinstance(item, Node):
            item.parent = run
    body.items = items


def _typical(core: Node) -> float:
    """Mean density of a subtree's smallest blocks, each by its characters."""
    total = chars = 0.0
    for node in _order(core):
        if node.block and not node.parts:
            total += node.density * node.chars
            chars += node.chars
    return total / chars if chars else core.density


def article(root: Node) -> list[Node]:
    """The subtrees of the article, in page order."""
    order = measure(root)
    body = next((n for n in order if n.tag == "body" and n.chars == root.chars), root)
    _runs(body)
    order = measure(root)
    below = [n for n in _order(body)[1:] if n.block and n.chars]
    if not below or not any(n.tag in CONTAINERS or 2 * n.link_chars > n.chars for n in body.parts):
        below = [body]  # all of it is one run of text
    core = max(below, key=lambda n: n.total)
    while True:  # a part with most of the sum, where there is only layout beside it
        part = max(core.parts, key=lambda n: n.density, default=None)
        loose = any(isinstance(x, str) and x.strip() or isinstance(x, Node) and not x.pruned and x.chars and x.tag not in CONTAINERS and 2 * x.link_chars <= x.chars for x in core.items if x is not part)
        if part is None or part.tag not in CONTAINERS or loose or part.density <= 0.5 * core.total:
            break
        core = part
    path = _path(core, body)
    threshold = min(n.density for n in path)
    enough = COMPARABLE * _typical(core)
    found = [core]
    for node, outer in zip(path, path[1:], strict=False):
        for part in outer.parts:
            if part is not node and part.density >= threshold and part.peak >= enough:
                found.append(max((n for n in _order(part) if n.block), key=lambda n: n.total))
    marks: list[Node] = []
    inside: set[int] = set()  # marks and what is in them
    for node in order:  # the outermost ones
        if id(node.parent) in inside:
            inside.add(id(node))
        elif node.tag in MARKS:
            inside.add(id(node))
            if node.chars:
                marks.append(node)
    around, below = {id(n) for n in _path(core)}, {id(n) for n in _order(core)}
    if marks and (any(id(n) in around for n in marks) or any(id(n) in below for n in marks) and 2 * sum(n.chars for n in marks) >= sum(n.chars for n in found)):
        return marks
    at = {id(n): i for i, n in enumerate(order)}
    return sorted(found, key=lambda n: at[id(n)])


def text_of(node: Node) -> str:
    """Blocks of a subtree in page order, white space collapsed, joined by newlines."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        line = SPACE.sub(" ", entities.unescape("".join(run))).strip()
        if line:
            blocks.append(line)
        run.clear()

    stack: list[Node | str | None] = [node]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            run.append(item)
        elif item.pruned:
            continue
        elif item.tag == "br":
            run.append(" ")
        else:
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(item.items))
    flush()
    return "\n".join(blocks)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    return "\n".join(filter(None, map(text_of, article(root))))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page of ``pages(page_id, url, html)``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
