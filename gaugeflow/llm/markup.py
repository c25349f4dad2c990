"""Blocks of text of an HTML page, and the page's outline: its tree of blocks with lists folded.

A block is the text between the tags of two block elements; inline tags do not divide it. The outline
has a node per block element. Items that follow each other in a list (paragraphs, rows, entries, or
containers of one class) share a node, so pages of one layout have one outline whatever their length.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_TAG = re.compile(
    r"""<(?:
        !--.*?(?:-->|\Z) | [!?][^>]*(?:>|\Z)
      | (/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^<>"'])*+)>
      | (/?)([a-zA-Z][^\s/>]*)([^<>]*)>
    )""",
    re.VERBOSE | re.DOTALL,
)
_SPACE = re.compile(r"\s+")
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)

#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "xmp", "iframe", "noembed", "noframes", "title"}
#: Raw elements that are closed by their own end tag only.
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in RAW}
#: Elements that fold with the next one of the same name beside them.
ITEMS = {"p", "li", "tr", "td", "th", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
ITEMS |= {"figure", "figcaption", "option", "caption", "summary"}
CONTAINERS = {"html", "head", "body", "title", "div", "section", "article", "main", "nav", "aside"}
CONTAINERS |= {"header", "footer", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "form"}
CONTAINERS |= {"fieldset", "address", "details", "dialog", "menu", "hgroup", "search", "center", "template"}
CONTAINERS |= {"noscript", "script", "style", "select", "textarea", "button", "iframe", "object", "svg"}
CONTAINERS |= {"canvas", "audio", "video", "map", "math", "datalist", "label", "legend", "xmp", "noembed", "noframes"}
BLOCKS = ITEMS | CONTAINERS
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
#: Opening one of the first closes an open one of the second, up to the element in the third.
_CLOSES: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
#: Neighbouring containers of one name without a class fold from this many on.
_MANY = 8
#: Elements nested deeper share the node above them.
_DEEPEST = 100


@dataclass(slots=True)
class Node:
    """A node of an outline; ``number`` counts nodes in the order in which they were met."""

    label: str
    number: int
    tag: str
    children: list[Node] = field(default_factory=list)

    def text(self) -> str:
        """The outline below as text, from which :func:`outline_of` makes it again."""
        inner = "".join(c.text() for c in self.children)
        return f"({self.number} {self.label}{inner})"


_PART = re.compile(r"\((\d+) ([^()]*)|\)")


def outline_of(text: str) -> Node:
    """The outline that :meth:`Node.text` wrote."""
    root = Node("", -1, "")
    open_nodes = [root]
    for m in _PART.finditer(text):
        if m[1] is None:
            open_nodes.pop()
        else:
            node = Node(m[2], int(m[1]), m[2].split(" ")[0])
            open_nodes[-1].children.append(node)
            open_nodes.append(node)
    return root.children[0]


@dataclass(slots=True)
class Block:
    """Text of a block with white space made single, its node, and how much of it is in links."""

    node: int
    text: str
    linked: int


_DIGITS = re.compile(r"[\d()]+")


def _label(tag: str, attributes: str) -> str:
    """Tag, classes, id and role; digits go, as they number items of one kind."""
    if not attributes or "=" not in attributes:
        return tag
    names: list[str] = []
    for m in _NAMED.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        names += _DIGITS.sub("", value).split()
    return " ".join([tag, *dict.fromkeys(names)])


def _folded(parent: Node, label: str, tag: str) -> Node | None:
    """The node of ``parent`` that a new element shares."""
    if not parent.children:
        return None
    if tag in ITEMS:
        return next((c for c in parent.children if c.label == label), None)
    last = parent.children[-1]
    if last.label != label:
        return None
    if " " in label:
        return last
    same = parent.children[-_MANY:]
    return last if len(same) == _MANY and all(c.label == label for c in same) else None


def blocks_of(page: str) -> tuple[Node, list[Block]]:
    """The outline of a page and its blocks in page order, those without text left out.

    Broken markup is read as browsers do in the main: end tags without a start are ignored, an end
    tag closes what is open inside it, a new block closes a paragraph, a new item the one before.
    What follows a ``<`` that starts no tag is text. Character references are decoded.
    """
    root = Node("html", 0, "html")
    stack, count, out = [("html", root)], 1, []
    parts: list[str] = []
    linked, links, at, end = 0, 0, 0, len(page)

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(_SPACE.sub("", text))

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                out.append(Block(stack[-1][1].number, text, linked))
            parts.clear()
        linked = 0

    def close(tags: set[str], bounds: set[str]) -> None:
        """Close the innermost open element of ``tags``, unless one of ``bounds`` is open inside it."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in bounds:
                return

    while at < end:
        found = _TAG.search(page, at)
        if found is None:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), found[1] or found[4]
        if tag not in BLOCKS:
            if tag == "a":
                links = 0 if closing else 1
            elif tag in ("br", "hr", "img", "input"):
                parts.append(" ")
            continue
        flush()
        if closing:
            close({tag}, set())
            continue
        if tag in ("html", "body") and any(t == tag for t, _ in stack[1 if tag == "body" else 0 :]):
            continue
        if stack[-1][0] == "p":
            stack.pop()
        if tag in _CLOSES:
            close(*_CLOSES[tag])
        parent = stack[-1][1]
        label = _label(tag, found[3] or found[6] or "")
        node = parent if len(stack) > _DEEPEST else _folded(parent, label, tag)
        if node is None:
            node = Node(label, count, tag)
            count += 1
            parent.children.append(node)
        if tag in RAW:
            ends = _RAW_END[tag].search(page, at)
            if tag == "title":
                stack.append((tag, node))
                add(page[at : ends.start() if ends else end])
                flush()
                stack.pop()
            at = ends.end() if ends else end
        else:
            stack.append((tag, node))
            links = 0
    flush()
    return root, out
