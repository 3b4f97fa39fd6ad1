"""Main text of web pages by composite text density summed over the children of DOM nodes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.rowwise import per_text

#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never main text.
DROPPED = frozenset("script style noscript template head title button select option textarea iframe object svg canvas".split())
#: Elements that hold page furniture, unless nearly all of the page's text is in them.
BESIDES = frozenset("nav header footer aside form dialog menu".split())
#: What a head may hold; anything else ends it.
HEAD = frozenset("title meta link base script style noscript template basefont bgsound".split())
#: Elements that begin and end a block of text.
BLOCKS = frozenset(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
#: Words of class, id or role that name page furniture, adverts, notices and reader comments.
FURNITURE = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header "
    "masthead menu modal nav navbar navigation newsletter notice pagination popup promo promoted related replies share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
#: A class or id that begins so says what the element is beside, not what it is.
BESIDE = frozenset("no not non without with has have is hide show".split())
#: What an article's own header or footer belongs to.
OWN = frozenset("post entry article content story".split())
#: A start tag in the key closes an open element of the value, up to the nearest container.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",)}
_CONTAINERS = frozenset("html body article section main div ul ol dl table tbody thead tfoot blockquote td th li aside".split())


class Node:
    """An element: its children (nodes and texts in page order) and, once measured, its counts and densities."""

    __slots__ = ("tag", "children", "furniture", "doubtful", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, furniture: bool = False, doubtful: bool = False):
        self.tag, self.children, self.furniture, self.doubtful = tag, [], furniture, doubtful
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def _names_furniture(attributes: Sequence[tuple[str, str | None]]) -> bool:
    for name, value in attributes:
        if name in ("class", "id", "role") and value:
            for given in value.lower().split():
                words = given.replace("-", " ").replace("_", " ").split()
                if words and words[0] not in BESIDE:
                    found = FURNITURE.intersection(words)
                    if found - {"header", "footer"} or found and words[0] not in OWN:
                        return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


class _Tree(HTMLParser):
    """Builds the tree; unclosed and stray tags are closed as browsers would in the cases that matter for text.

    Each tag's open elements and the open containers are known by their depth, so a tag costs the same however deep it comes.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}
        self.containers = [0]

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            self._end_head()
            return
        if self.open[-1].tag == "head" and tag not in HEAD:
            self._end_head()
        if tag in BLOCKS:
            self._close(("p",))
        if tag in _CLOSES:
            self._close(_CLOSES[tag])
        node = Node(tag, tag in DROPPED, tag in BESIDES or _names_furniture(attrs))
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            if tag in _CONTAINERS:
                self.containers.append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1 and self.open[-1].tag == tag:
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag):
        depths = self.depths.get(tag)
        # a stray inline end tag closes no container
        if depths and (tag in BLOCKS or tag in DROPPED or tag in BESIDES or depths[-1] >= self.containers[-1]):
            self._cut(depths[-1])

    def handle_data(self, data):
        if self.open[-1].tag == "head" and data.strip():
            self._end_head()
        self.open[-1].children.append(data)

    def _end_head(self):
        if self.depths.get("head"):
            self._cut(self.depths["head"][0])

    def _close(self, tags):
        depth = max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)
        if depth and depth >= self.containers[-1]:
            self._cut(depth)

    def _cut(self, depth):
        while len(self.open) > depth:
            node = self.open.pop()
            self.depths[node.tag].pop()
            if node.tag in _CONTAINERS:
                self.containers.pop()


#: A doubtful element is kept with this share of the page's characters outside of links; one doubtful by its tag with so many at least.
_KEPT_CHARS, _KEPT_SHARE = 140, 0.75


def settle_doubts(root: Node) -> None:
    """Decide which elements that tag, class, id or role make doubtful are furniture: those that hold no more than three quarters of
    the page's text outside of links. An article inside an element named after something else, or after an unclosed one, stays."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [c for c in node.children if isinstance(c, Node) and not c.furniture]
    plain = {}
    for node in reversed(order):
        plain[id(node)] = 0 if node.tag == "a" else sum(
            _size(c) if isinstance(c, str) else plain.get(id(c), 0) for c in node.children)
    for node in order:
        if node.doubtful:
            least = max(_KEPT_CHARS if node.tag in BESIDES else 1, _KEPT_SHARE * plain[id(root)])
            node.furniture = plain[id(node)] < least


def _size(text: str) -> int:
    return sum(map(len, text.split()))


def _in_order(root: Node) -> list[tuple[Node, Node | None]]:
    """Every kept node with its parent, parents first; no recursion, as pages nest without limit."""
    found, waiting = [], [(root, None)]
    while waiting:
        node, parent = waiting.pop()
        found.append((node, parent))
        waiting += [(c, node) for c in reversed(node.children) if isinstance(c, Node) and not c.furniture]
    return found


def measure(root: Node) -> list[tuple[Node, Node | None]]:
    """Fill in counts, densities and density sums; the kept nodes with their parents, parents first."""
    nodes = _in_order(root)
    for node, parent in reversed(nodes):
        node.chars += sum(_size(c) for c in node.children if isinstance(c, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if parent:
            parent.chars += node.chars
            parent.tags += node.tags + 1
            parent.link_chars += node.link_chars
            parent.link_tags += node.link_tags
    body_share = root.link_chars / max(1, root.chars)
    for node, parent in nodes:
        node.density = _density(node, body_share)
        if parent:
            parent.total += node.density
    return nodes


def _density(node: Node, body_share: float) -> float:
    """Composite text density: characters per tag, scaled down where links hold much of the text or the tags."""
    if not node.chars:
        return 0.0
    tags, links, link_tags = max(1, node.tags), max(1, node.link_chars), max(1, node.link_tags)
    plain = max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * node.link_chars + body_share * node.chars + math.e)
    ratio = node.chars / links * tags / link_tags
    return node.chars / tags * max(0.0, math.log(max(ratio, 1.0 + 1e-9)) / math.log(max(base, 1.0 + 1e-9)))


def best_subtree(nodes: Sequence[tuple[Node, Node | None]]) -> Node | None:
    """The node with the largest density sum among those at least as dense as the thinnest on the way down to it.

    The way from the body to the node of the largest sum gives the threshold; a node without child elements counts with
    its own density. Ties go to the node that comes first on the page. None if the page has no text.
    """
    def worth(node: Node) -> float:
        return max(node.total, 0.0 if any(isinstance(c, Node) and c.chars for c in node.children) else node.density)

    if not nodes or not nodes[0][0].chars:
        return None
    parents = {id(n): p for n, p in nodes}
    with_text = [n for n, _ in nodes if n.chars]
    top = max(with_text, key=worth)
    threshold, step = top.density, top
    while step is not None:
        threshold = min(threshold, step.density)
        step = parents[id(step)]
    while top.tag not in _CONTAINERS and parents[id(top)] is not None:
        top = parents[id(top)]  # a paragraph alone is no article
    best = max((n for n in with_text if n.density >= threshold and n.tag in _CONTAINERS), key=worth, default=top)
    return top if worth(best) < worth(top) else best


def article(nodes: Sequence[tuple[Node, Node | None]], best: Node) -> tuple[Node, set[int]]:
    """The highest ancestor of the best subtree with another part of the article beside the way down to it, and the ids of the
    nodes beside that way that are no part of it.

    A part is a subtree at least as dense as the thinnest on the way from the body to the best one, with less than half
    its text in links. In such an ancestor, headings and paragraphs of their own stay too.
    """
    parents, way, threshold = {id(n): p for n, p in nodes}, [best], best.density
    while (above := parents[id(way[-1])]) is not None:
        threshold = min(threshold, above.density)
        way.append(above)
    top, left, pending = best, set(), set()
    for child, node in zip(way, way[1:]):
        beside = [c for c in node.children if isinstance(c, Node) and c is not child and c.chars and not c.furniture]
        plain = [c for c in beside if 2 * c.link_chars < c.chars]
        part = [c for c in plain if c.density >= threshold]
        stay = {id(c) for c in plain if c.density >= threshold or c.tag not in _CONTAINERS}
        pending |= {id(c) for c in beside} - stay
        if part:
            top, left = node, set(pending)
    return top, left


def blocks(node: Node, left: set[int] = frozenset()) -> list[str]:
    """The texts of a subtree's blocks in page order, without the nodes left out, white space as one space, trimmed, without
    empty ones."""
    found, current = [], []

    def end():
        text = " ".join("".join(current).split())
        if text:
            found.append(text)
        current.clear()

    waiting: list = [node]
    while waiting:
        item = waiting.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            current.append(item)
        elif item.tag == "br":
            current.append(" ")
        elif not item.furniture and id(item) not in left:
            edge = item.tag in BLOCKS
            if edge:
                end()
                waiting.append(None)
            waiting += reversed(item.children)
    end()
    return found


def main_text(html: str | None) -> str:
    """The main text of a page; empty if there is none."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    settle_doubts(tree.root)
    nodes = measure(tree.root)
    node = best_subtree(nodes)
    return "\n".join(blocks(*article(nodes, node))) if node else ""


def extract_main_text(df: DataFrame, key: str | Sequence[str] = ("page_id", "url"), html: str = "html") -> DataFrame:
    """One row per row of `df`: the key columns, `text` and `n_chars` (its code points).

    Every DOM node gets its characters per tag, adjusted for links; the densities of a node's children are summed; the
    subtree of the largest sum is the main text, with the parts beside it that are as dense, see `article`. Scripts and styles are
    taken out before, and so are forms, menus, headers, footers, asides and elements whose class, id or role names furniture, unless they
    hold nearly all of the page's text, see `settle_doubts`. Character references are decoded, white space within a block becomes one space, blocks are joined by one \\n; nothing is cut. NULL, empty and text-less pages give an
    empty text. Unclosed tags and truncated pages are read as far as they go; equal rows give equal texts; an empty
    table gives no rows; other columns are not read. One pass, no shuffle.
    """
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def setup():
        def work(pages):
            texts = [main_text(p) for p in pages]
            return [texts, [len(t) for t in texts]]

        return work

    return per_text(df, key, html, fields, setup)
