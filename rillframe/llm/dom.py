"""A small HTML tree for text extraction: tolerant parsing, roles of nodes, text blocks."""

from __future__ import annotations

import re
from collections.abc import Iterable
from html import unescape

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
# For what is left of a page once a quote has turned out not to be closed: a tag ends at the next bracket.
BROKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>]*)>|<[!?/][^<>]*>", re.S)
TAG = re.compile(r"</?[a-zA-Z]")
NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

QUOTE = re.compile("[\"']")

# Elements by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br hr td th img wbr".split())
# Which open elements a start tag ends: itself or siblings, up to the element that bounds them.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# What is not the article, by element, by word of class or id, and by ARIA role.
BOILER_TAGS = frozenset("aside button canvas datalist dialog footer form head header iframe input menu nav noscript object optgroup option script select style svg template textarea title".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies discussion disqus footer"
    " gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted related replies reply respond"
    " share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
BOILER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article-body articlebody entry-content post-content main-content".split())


# First words of class names that tell of a page's layout, not of a node's own role.
LAYOUT_WORDS = frozenset("has hide is no not show with without".split())


def _names_boilerplate(word: str) -> bool:
    parts = re.split(r"[-_\d]+", word)
    return parts[0] not in LAYOUT_WORDS and not BOILER_WORDS.isdisjoint(parts)


class Node:
    __slots__ = ("boiler", "children", "main", "name", "tag")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.children = tag, []
        self.boiler, self.main, self.name = tag in BOILER_TAGS, tag in MAIN_TAGS, tag
        if attributes:
            for key, *values in NAMED.findall(attributes):
                value = next((v for v in values if v), "").lower()
                words = value.split()
                if key.lower() == "role":
                    self.boiler |= value in BOILER_ROLES
                    self.main |= value in ("main", "article")
                elif key.lower() == "itemprop":
                    self.main |= value == "articlebody"
                else:
                    self.boiler |= any(_names_boilerplate(w) for w in words)
                    self.main |= not MAIN_WORDS.isdisjoint(words)
                    if key.lower() == "class" and words:
                        self.name = f"{tag}.{words[0]}"
            self.boiler &= tag not in ("html", "body")


class _Open:
    """The open elements, and the places of each kind among them, so that looking for one costs no walk."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places = [root], {root.tag: [0]}

    def last(self, tags: Iterable[str]) -> int:
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def close(self, tags: Iterable[str], bounds: Iterable[str]) -> None:
        """End the innermost of ``tags`` (never the root), unless one of ``bounds`` is open within it."""
        at = self.last(tags)
        if at > 0 and at >= self.last(bounds):
            self.cut(at)


def parse(html: str) -> Node:
    """The tree of a page. Markup that doesn't nest is mended as browsers do in the plain cases; nothing raises.

    Time is proportional to the page's length, also for broken markup: an unclosed quote is looked for once.
    """
    root = Node("html")
    still, at, end, broken = _Open(root), 0, len(html), False
    closings: dict[str, re.Pattern] = {}
    while at < end:
        start = html.find("<", at)
        if start < 0:
            still.stack[-1].children.append(html[at:])
            break
        found = (BROKEN if broken else TOKEN).match(html, start)
        if not found and not broken:
            broken = bool(TAG.match(html, start))  # no bracket ends this tag outside quotes
            found = BROKEN.match(html, start)
        if not found:
            still.stack[-1].children.append(html[at : start + 1])
            at = start + 1
            continue
        if start > at:
            still.stack[-1].children.append(html[at:start])
        at = found.end()
        closing, tag, attributes = found.groups()
        if not tag:
            continue  # a comment, a doctype or a broken end tag
        tag, attributes = tag.lower(), "" if broken and QUOTE.search(attributes or "") else attributes or ""
        if closing:
            bounds = () if tag in ("html", "body", "article", "main") else ("article", "main", "body")  # a stray end tag doesn't leave the article
            still.close((tag,), bounds)
            continue
        if tag in ("html", "body") and still.places.get(tag):
            continue
        if tag in BLOCKS:
            still.close(("p",), ("td", "th", "button", "article", "section", "div", "body"))
        if tag in ENDS:
            still.close(*ENDS[tag])
        node = Node(tag, attributes)
        still.stack[-1].children.append(node)
        if tag in RAW:
            if tag not in closings:
                closings[tag] = re.compile(rf"</{tag}\b[^<>]*>", re.I)
            closed = closings[tag].search(html, at)
            node.children.append(html[at : closed.start() if closed else end])
            at = closed.end() if closed else end
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            still.push(node)
    return root


def plain(text: str) -> str:
    """White space made one space each, references decoded."""
    return " ".join((unescape(text) if "&" in text else text).split())


def text_blocks(nodes: list[Node], left_out: set[int]) -> list[str]:
    """The blocks of text under nodes, in page order, without boilerplate and the nodes (by id) that are left out."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = plain("".join(run))
        if text:
            blocks.append(text)
        run.clear()

    todo: list = [(n, True) for n in reversed(nodes)]
    while todo:
        node, opening = todo.pop()
        if isinstance(node, str):
            run.append(node)
            continue
        block = node.tag in BLOCKS
        if not opening:
            end()
            continue
        if node.boiler or id(node) in left_out:
            if block:
                end()
            elif node.tag not in ("script", "style", "template"):
                run.append(" ")
            continue
        if block:
            end()
            todo.append((node, False))
        elif node.tag in SPACED:
            run.append(" ")
        todo.extend((c, True) for c in reversed(node.children))
    end()
    return blocks
