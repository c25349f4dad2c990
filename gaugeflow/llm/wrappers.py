"""Main text of web pages by wrappers that are induced from the pages of a host.

The most common outline of a host's pages is its template. Outlines of its pages are aligned with the
template by simple tree matching: the largest set of matched nodes that keeps parents and the order of
siblings. Over all pages of a host, a text that nearly every page has at a node is constant and part of
the template; nodes with other texts are slots. A slot is content unless the template's names, or how
much of its text over all pages is links, tell otherwise. Then each page gives the texts of its content
slots, without the constant ones.

Hosts are never gathered: counts, constant texts and slots come from aggregations that combine within
tasks, and a page is aligned by itself with its host's wrapper, which is about as large as a page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.markup import Block, Node, blocks_of, outline_of
from gaugeflow.session import write_out

#: A text is constant if this share of a host's different pages have it, and so many at least.
CONSTANT_SHARE, CONSTANT_PAGES = 0.8, 3
#: A slot with more than this share of its text in links is a menu.
LINK_SHARE = 0.6
#: The node that holds this share of all content is the main one, if no name tells.
MAIN_SHARE = 0.75
#: Wrappers of all hosts together are broadcast up to so many bytes, and joined by shuffle beyond.
MAX_BROADCAST_BYTES = 16_000_000

#: Elements that hold no article text.
_ASIDE_TAGS = {"head", "title", "nav", "aside", "footer", "form", "script", "style", "noscript", "template"}
_ASIDE_TAGS |= {"select", "button", "textarea", "iframe", "svg", "canvas", "object", "dialog", "menu", "fieldset"}
_ASIDE_TAGS |= {"audio", "video", "map", "datalist", "label", "legend", "search", "noembed", "noframes", "xmp"}
#: Words in classes, ids and roles of parts beside the article.
_ASIDE_NAMES = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored"}
_ASIDE_NAMES |= {"promo", "promotion", "nav", "navbar", "navigation", "menu", "sidebar", "aside", "footer"}
_ASIDE_NAMES |= {"masthead", "breadcrumb", "breadcrumbs", "crumbs", "cookie", "cookies", "consent", "gdpr", "notice"}
_ASIDE_NAMES |= {"notices", "notification", "alert", "banner", "popup", "modal", "overlay", "newsletter", "subscribe"}
_ASIDE_NAMES |= {"subscription", "signup", "login", "share", "sharing", "social", "related", "recommended"}
_ASIDE_NAMES |= {"comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion"}
_ASIDE_NAMES |= {"widget", "widgets", "pagination", "pager", "contentinfo", "complementary", "search", "toolbar"}
_ASIDE_NAMES |= {"legal", "copyright", "disclaimer", "skip", "hidden"}
_HEADER_NAMES = {"header", "topbar"}
_NAME_PART = re.compile(r"[a-z]+")
#: Such a name says what is beside an element, or that it is missing.
_ABOUT = re.compile(r"(?:has|with|no|without)[-_]")
_MAIN_TAGS = {"article", "main"}


def _is_aside(node: Node, in_main: bool) -> bool:
    if node.tag in _ASIDE_TAGS:
        return True
    if node.tag == "header" and not in_main:
        return True
    names = [n for n in node.label.split(" ")[1:] if not _ABOUT.match(n)]
    # an article names its state too, such as comment-status-open
    named = set(names) if node.tag in _MAIN_TAGS else {p for n in names for p in _NAME_PART.findall(n)}
    return bool(named & _ASIDE_NAMES) or bool(named & _HEADER_NAMES) and not in_main


def aside_nodes(root: Node) -> dict[int, bool]:
    """For every node whether it is, or lies in, a part beside the article by tag or name.

    What holds a main element is none, whatever its name.
    """
    holds = _holding_main(root)
    found, todo = {}, [(root, False, False)]
    while todo:
        node, aside, in_main = todo.pop()
        aside = aside or node.number not in holds and _is_aside(node, in_main)
        found[node.number] = aside
        in_main = in_main or node.tag in _MAIN_TAGS
        todo += [(c, aside, in_main) for c in node.children]
    return found


def _holding_main(root: Node) -> set[int]:
    """The nodes above main elements, the root and the body."""
    held, todo = {root.number}, [(root, (root.number,))]
    while todo:
        node, path = todo.pop()
        if node.tag in _MAIN_TAGS:
            held.update(path)
        elif node.tag == "body":
            held.add(node.number)
        todo += [(c, (*path, node.number)) for c in node.children]
    return held


# --- simple tree matching -------------------------------------------------------------------------


def matched(a: Node, b: Node) -> dict[int, int]:
    """Simple tree matching: node of ``a`` -> node of ``b``.

    Roots match; children match in order, so that the matched nodes weigh most. Nodes of one tag can
    match; equal labels weigh a little more, so that classes decide between neighbours.
    """
    sizes: dict[tuple[int, int], float] = {}

    def weight(x: Node, y: Node) -> float:
        key = (x.number, y.number)
        if key not in sizes:
            sizes[key] = (1.5 if x.label == y.label else 1.0) + _table(x, y)[-1][-1]
        return sizes[key]

    def _table(x: Node, y: Node) -> list[list[float]]:
        best = [[0.0] * (len(y.children) + 1)]
        for c in x.children:
            above, row = best[-1], [0.0]
            for j, d in enumerate(y.children):
                most = max(above[j + 1], row[j])
                if c.tag == d.tag:
                    most = max(most, above[j] + weight(c, d))
                row.append(most)
            best.append(row)
        return best

    pairs, todo = {a.number: b.number}, [(a, b)]
    while todo:
        x, y = todo.pop()
        best = _table(x, y)
        i, j = len(x.children), len(y.children)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs[x.children[i].number] = y.children[j].number
                todo.append((x.children[i], y.children[j]))
    return pairs


@lru_cache(4096)
def _asides(outline: str) -> dict[int, bool]:
    return aside_nodes(outline_of(outline))


@lru_cache(4096)
def _aligned(outline: str, template: str) -> tuple[dict[int, int], dict[int, bool]]:
    """Every node of the outline -> the template's node that it, or the nearest above it, matches;
    and which nodes lie in a part beside the article by the page's own names."""
    page, pairs = outline_of(outline), matched(outline_of(outline), outline_of(template))
    places, todo = {}, [(page, 0)]
    while todo:
        node, above = todo.pop()
        place = places[node.number] = pairs.get(node.number, above)
        todo += [(c, place) for c in node.children]
    return places, _asides(outline)


# --- what all pages of a host say -------------------------------------------------------------------

_SLIM = "host string, outline string, body long, blocks array<struct<node: int, hash: long, chars: int, linked: int>>"


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def _hash(text: str) -> int:
    return _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))


def _chars(text: str) -> int:
    return len(text) - text.count(" ")


def _slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outline, digest of the main texts and digests of all blocks of every page."""
    kind = pa.struct([("node", pa.int32()), ("hash", pa.int64()), ("chars", pa.int32()), ("linked", pa.int32())])
    for batch in batches:
        outlines, bodies, blocks = [], [], []
        for page in batch.column("html"):
            root, found = blocks_of(page.as_py() or "")
            outlines.append(root.text())
            aside = _asides(outlines[-1])
            bodies.append(_hash("\n".join(b.text for b in found if not aside[b.node])))
            blocks.append(
                [{"node": b.node, "hash": _hash(b.text), "chars": _chars(b.text), "linked": b.linked} for b in found]
            )
        yield pa.RecordBatch.from_pydict(
            {
                "host": batch.column("host"),
                "outline": pa.array(outlines, pa.string()),
                "body": pa.array(bodies, pa.int64()),
                "blocks": pa.array(blocks, pa.list_(kind)),
            }
        )


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks' nodes as nodes of the host's template."""
    for batch in batches:
        outlines, templates = batch.column("outline").to_pylist(), batch.column("template").to_pylist()
        lists = batch.column("blocks")
        flat = lists.flatten()
        sizes = [len(x) for x in lists]
        nodes, out, at = flat.field("node").to_pylist(), [], 0
        for outline, template, n in zip(outlines, templates, sizes, strict=True):
            places, _ = _aligned(outline, template)
            out += [places[node] for node in nodes[at : at + n]]
            at += n
        placed = pa.StructArray.from_arrays(
            [pa.array(out, pa.int32()), flat.field("hash"), flat.field("chars"), flat.field("linked")],
            ["node", "hash", "chars", "linked"],
        )
        offsets = [0]
        for n in sizes:
            offsets.append(offsets[-1] + n)
        yield pa.RecordBatch.from_pydict(
            {
                "host": batch.column("host"),
                "body": batch.column("body"),
                "blocks": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), placed),
            }
        )


def host_of(url: str = "url"):
    """The host in a URL without ``www.``, lower case; null where there is none."""
    name = F.regexp_extract(F.lower(F.col(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(name != "", name)


def induced(pages: DataFrame) -> DataFrame:
    """The wrapper of every host: ``host, template, slots, constants``.

    ``slots`` has the characters and the linked characters of every node of the template over the
    host's different pages, ``constants`` the digests of constant texts by node. Pages count as one
    where their main texts are equal, so copies of a page make nothing constant.
    """
    source = pages.select(host_of().alias("host"), F.col("html").cast("string")).where("host IS NOT NULL")
    slim = write_out(source.mapInArrow(_slim, _SLIM), "outlines")
    counted = slim.groupBy("host", "outline").agg(F.count(F.lit(1)).alias("n"))
    templates = counted.groupBy("host").agg(
        F.max(F.struct("n", "outline")).getField("outline").alias("template")
    )
    templates = write_out(templates, "templates")
    placed = write_out(
        _with_host(slim, templates, "template").mapInArrow(_placed, _SLIM.replace("outline string, ", "")), "placed"
    )
    # one row per text, node and page body, then per text and node
    texts = placed.select("host", "body", F.inline("blocks")).groupBy("host", "node", "hash", "body")
    texts = texts.agg(F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    met = texts.groupBy("host", "node", "hash").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")
    )
    bodies = placed.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n_bodies"))
    many = bodies.where(F.col("n_bodies") >= CONSTANT_PAGES)
    often = met.where(F.col("n_pages") >= CONSTANT_PAGES).join(many, "host")
    constant = often.where(F.col("n_pages") >= CONSTANT_SHARE * F.col("n_bodies"))
    constants = constant.groupBy("host").agg(F.collect_list(F.struct("node", "hash")).alias("constants"))
    slots = met.groupBy("host", "node").agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    slots = slots.groupBy("host").agg(F.collect_list(F.struct("node", "chars", "linked")).alias("slots"))
    return templates.join(slots, "host", "left").join(constants, "host", "left")


def _with_host(rows: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Join a table of one row per host; a hot host's rows are split by Spark where they are shuffled."""
    size = table.agg(F.sum(F.length(F.col(column).cast("string")))).first()[0] or 0
    small = F.broadcast(table) if size <= MAX_BROADCAST_BYTES else table
    return rows.join(small, "host", "left")


# --- texts ------------------------------------------------------------------------------------------


@lru_cache(4096)
def _content(template: str, slots: tuple[tuple[int, int, int], ...]) -> frozenset[int]:
    """The nodes of the template whose texts are content."""
    root = outline_of(template)
    aside = aside_nodes(root)
    chars = {node: n for node, n, _ in slots}
    linked = {node: n for node, _, n in slots}
    content = {n for n in chars if not aside[n] and linked[n] <= LINK_SHARE * max(chars[n], 1)}
    total = sum(chars[n] for n in content)

    def below(node: Node) -> list[int]:
        return [node.number, *[n for c in node.children for n in below(c)]]

    def mass(node: Node) -> int:
        return sum(chars[n] for n in below(node) if n in content)

    main = [n for n in _nodes(root) if n.tag in _MAIN_TAGS or "role" in n.label and " main" in n.label]
    main = [n for n in main if not aside[n.number] and mass(n)]
    if not main:
        node = root
        while inner := [c for c in node.children if mass(c) >= MAIN_SHARE * max(total, 1)]:
            if inner[0].tag not in ("div", "section", "body", "html", "table", "tbody", "center", "tr", "td"):
                break
            node = inner[0]
        main = [node]
    held = {n for m in main for n in below(m)}
    return frozenset(content & held)


def _nodes(root: Node) -> Iterator[Node]:
    yield root
    for child in root.children:
        yield from _nodes(child)


def _text(found: list[Block], outline: Node, wrapper: tuple | None) -> str:
    """The text of one page's content slots; a page without a wrapper is its own template."""
    named = outline.text()
    if wrapper is None:
        template, constants = named, frozenset()
        sums: dict[int, list[int]] = {}
        for b in found:
            s = sums.setdefault(b.node, [0, 0])
            s[0], s[1] = s[0] + _chars(b.text), s[1] + b.linked
        slots = tuple(sorted((n, c, k) for n, (c, k) in sums.items()))
    else:
        template, slots, constants = wrapper
    places, aside = _aligned(named, template)
    content = _content(template, slots)
    return " ".join(
        b.text
        for b in found
        if not aside[b.node]
        and places[b.node] in content
        and not (constants and (places[b.node], _hash(b.text)) in constants)
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, texts, known = batch.column("host").to_pylist(), [], {}
        for i, (host, page) in enumerate(zip(names, batch.column("html"), strict=True)):
            if host not in known:
                template = batch.column("template")[i].as_py()
                if template is None:
                    known[host] = None
                else:
                    slots = batch.column("slots")[i].as_py() or []
                    constants = batch.column("constants")[i].as_py() or []
                    known[host] = (
                        template,
                        tuple(sorted((s["node"], s["chars"], s["linked"]) for s in slots)),
                        frozenset((c["node"], c["hash"]) for c in constants),
                    )
            outline, found = blocks_of(page.as_py() or "")
            texts.append(_text(found, outline, known[host]))
        yield pa.RecordBatch.from_pydict(
            {
                "page_id": batch.column("page_id"),
                "url": batch.column("url"),
                "text": pa.array(texts, pa.string()),
            }
        )


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page: the article in its ``html``.

    Blocks are joined by one space. Null and empty pages, and those without content, have an empty
    text. A page without a host in its ``url``, also one with a null ``url``, is its own template, so
    nothing in it is constant. Every row is a page, also where ``page_id`` or ``url`` are repeated or
    null; other columns are not read. An empty table gives an empty result.
    """
    source = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    wrappers = write_out(induced(source), "wrappers")
    wide = _with_host(source.withColumn("host", host_of()), wrappers, "template")
    texts = wide.mapInArrow(_extracted, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
