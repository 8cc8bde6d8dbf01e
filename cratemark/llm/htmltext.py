"""Main text of web pages by composite text density.

For every node of the DOM: C characters of text on T tags, of which LC characters
in LT links. Its density is C/T, scaled by a logarithm that falls with the share
of link text; the base of the logarithm rises with the links of the whole page:

    C/T * log(C/LC * T/LT) / log(ln(C/notLC * LC + LCbody/Cbody * C + e))

The node with the largest sum of its children's densities holds the text. The
least density on its path to the body is the threshold that other parts of the
page have to reach to belong to it.

Some elements are never part of an article, whatever their text (scripts, forms,
``nav``). Names of classes are evidence only: an element so named is left out unless
the measure speaks against it, because it holds most of the text that is not links,
or, if it is named for links, has few of them.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# --- fixed values: element names as HTML defines them ---------------------------

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a start tag ends, if it is open (up to the nearest of the second set).
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_RAW = frozenset("script style noscript template iframe textarea title svg math object".split())

# --- fixed values: parts of a page that are not its article ----------------------

_DROPPED = frozenset("nav footer aside form button select dialog menu head input".split()) | _RAW
_HINTS = frozenset(
    "header ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sidebar aside widget"
    " footer masthead newsletter subscribe signup login toolbar skip skiplink".split()
)
_READERS = frozenset(
    "comment comments commentlist disqus respond reply replies discussion reviews feedback".split()
)
_LINKS = frozenset("share sharing social related recommended search".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog".split()
)
_KEEP = frozenset(("html", "body", "main"))

_TOKEN = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PARTS = re.compile(r"[^A-Za-z0-9]+")


class _Node:
    __slots__ = ("tag", "parent", "items", "gone", "chars", "tags", "link_chars", "links", "density", "sum", "hint", "core")

    def __init__(self, tag: str, parent: _Node | None, gone: bool, hint: frozenset | None = None) -> None:
        self.tag, self.parent, self.gone, self.hint = tag, parent, gone, hint
        self.items: list[_Node | str] = []

    def children(self) -> list[_Node]:
        return [x for x in self.items if not isinstance(x, str) and not x.gone]


def _is_boilerplate(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in _DROPPED:
        return True
    if tag == "header" and not in_article:
        return True
    if not attrs or tag in _KEEP:
        return False
    for name, *values in _ATTRIBUTE.findall(attrs):
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden" or name == "role" and value in _ROLES and not in_article:
            return True
    return False


def _hint(tag: str, attrs: str, in_article: bool) -> frozenset | None:
    """The set that a word of the element's class or id is in."""
    if not attrs or tag in _KEEP:
        return None
    words: set[str] = set()
    for name, *values in _ATTRIBUTE.findall(attrs):
        if name.lower() in ("class", "id"):
            words.update(_PARTS.split("".join(values).lower()))
    if in_article:
        words.discard("header")
    return next((x for x in (_READERS, _HINTS, _LINKS) if not x.isdisjoint(words)), None)


def parse(page: str) -> _Node:
    """The tree of a page; broken and cut markup is repaired as far as it matters."""
    root = _Node("html", None, False)
    at, node, articles = 0, root, 0
    find, size = _TOKEN.search, len(page)
    while at < size:
        found = find(page, at)
        text = page[at : found.start() if found else size]
        if text:
            node.items.append(text)
        if not found:
            break
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if tag is None:
            continue
        if found["tag2"] and not page[at - 1] == ">":
            break  # the page ends within a tag
        tag = tag.lower()
        attrs = found["attrs"] or found["attrs2"] or ""
        if found["end"] or found["end2"]:
            above = node
            while above is not None and above.tag != tag:
                # The end of an inline element does not reach out of its block.
                above = None if tag not in _BLOCKS and above.tag in _BLOCKS else above.parent
            if above is not None and above.parent is not None:
                while node is not above:
                    articles -= node.tag == "article"
                    node = node.parent
                articles -= node.tag == "article"
                node = node.parent
            continue
        if tag in ("html", "body"):
            if tag == "body" and node is root:
                node.items.append(node := _Node("body", root, False))
            continue
        if tag in _BLOCKS:
            above = node
            while above.parent is not None and above.tag not in _BLOCKS:
                above = above.parent
            if above.tag == "p":
                node = above.parent
        if tag in _ENDS:
            ended, scope = _ENDS[tag]
            above, outer = node, None
            while above.parent is not None and above.tag not in scope:
                outer = above if above.tag in ended else outer
                above = above.parent
            node = outer.parent if outer is not None else node
        fresh = _Node(tag, node, _is_boilerplate(tag, attrs, articles > 0), _hint(tag, attrs, articles > 0))
        node.items.append(fresh)
        if tag in _RAW and not attrs.endswith("/"):
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in _VOID:
            node = fresh
            articles += tag == "article"
    return root


def _ordered(root: _Node) -> list[_Node]:
    """Parents before children; without recursion, as pages may be deep."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(reversed(node.children()))
    return nodes


def _measure(nodes: list[_Node]) -> None:
    for node in reversed(nodes):
        node.chars = node.tags = node.link_chars = node.links = 0
        for item in node.items:
            if isinstance(item, str):
                node.chars += len("".join(item.split()))
            elif not item.gone:
                # Inline markup is part of the text; links and blocks count.
                own = item.tag == "a" or item.tag in _BLOCKS
                node.tags += item.tags + own
                node.chars += item.chars
                node.links += item.links + (item.tag == "a")
                node.link_chars += item.chars if item.tag == "a" else item.link_chars
    body = nodes[0]
    link_share = body.link_chars / max(1, body.chars)
    for node in nodes:
        chars, tags = node.chars, max(1, node.tags)
        if not chars:
            node.density = 0.0
            continue
        base = math.log(
            chars / max(1, chars - node.link_chars) * node.link_chars + link_share * chars + math.e
        )
        scale = chars / max(1, node.link_chars) * tags / max(1, node.links)
        # A base of e stands for a page without links: nothing to adjust.
        node.density = chars / tags * (math.log(max(scale, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1.0 else 1.0)
    for node in nodes:
        node.sum = 0.0
    for node in reversed(nodes):
        if node.parent is not None and (node.tag in _BLOCKS):
            above = node.parent
            while above.parent is not None and above.tag not in _BLOCKS:
                above = above.parent
            above.sum = getattr(above, "sum", 0.0) + node.density


def _leave_out(nodes: list[_Node]) -> bool:
    """Leave out what is named as no article and not measured as one; whether
    there was any. ``nodes`` are in order and measured."""
    for node in reversed(nodes):
        node.core = node.tag in ("h1", "main") or node.tag == "article" and node.hint is None
        node.core = node.core or any(x.core for x in node.children())
    total = nodes[0].chars - nodes[0].link_chars
    left = False
    for node in nodes[1:]:
        if node.hint is None:
            continue
        own = node.chars - node.link_chars
        if node.hint is _LINKS:
            kept = 3 * own > 2 * node.chars
        else:
            kept = node.core and 2 * own > total
        # Readers may write much more than the article has.
        if not kept and not (node.hint is not _READERS and 5 * own > 4 * total):
            node.gone = left = True
    return left


def _selected(nodes: list[_Node]) -> list[_Node]:
    """The subtrees that make up the text, in the order of the page."""
    body = nodes[0]
    best = max(nodes, key=lambda n: n.sum)  # the outermost of equals
    if best.sum == 0.0:
        return [body]
    threshold, up = math.inf, best
    while True:
        threshold = min(threshold, up.density)
        if up is body:
            break
        up = up.parent
    up = best
    while up is not body:
        if up.tag in ("article", "main"):
            _without_links(up, threshold)
            return [up]
        up = up.parent
    chosen, inside = [], set()
    for node in nodes:
        if node.parent is not None and id(node.parent) in inside:
            inside.add(id(node))
        elif node is best or (
            node.sum > 0 and node is not body and node.density >= threshold and not _holds(node, best)
        ) or (node.tag in _HEADINGS and node.parent is best.parent):
            chosen.append(node)
            inside.add(id(node))
    return chosen


def _without_links(top: _Node, threshold: float) -> None:
    """Leave out, within an element that holds the text, groups of blocks or links
    that stay below the threshold and are links for the most part. Short blocks
    of plain text stay, and so does a paragraph, heading or item with a link."""
    for node in _ordered(top)[1:]:
        if (
            node.tag in _BLOCKS
            and node.links > 1
            and node.density < threshold
            and 2 * node.link_chars > node.chars
            and node.tag not in _HEADINGS
            and node.tag not in ("p", "li", "dd", "td", "tr")
        ):
            node.gone = True


def _holds(node: _Node, other: _Node) -> bool:
    while other is not None:
        if other is node:
            return True
        other = other.parent
    return False


def _blocks(top: _Node) -> list[str]:
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            blocks.append(text)
        run.clear()

    todo: list[_Node | str | None] = [top]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            run.append(item)
        elif not item.gone:
            if item.tag in _BLOCKS:
                close()
                todo.append(None)
            elif item.tag == "br":
                run.append(" ")
            todo.extend(reversed(item.items))
    close()
    return blocks


def main_text(page: str | None) -> str:
    """Text blocks of the article, joined by line feeds; empty if there are none."""
    if not page:
        return ""
    root = parse(page)
    bodies = [x for x in root.children() if x.tag == "body"]
    top = bodies[0] if bodies else root
    nodes = _ordered(top)
    _measure(nodes)
    if _leave_out(nodes):
        nodes = _ordered(top)
        _measure(nodes)
    if not top.chars:
        return ""
    return "\n".join(block for node in _selected(nodes) for block in _blocks(node))


def extract(
    pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
) -> DataFrame:
    """Per row of ``pages``: the columns ``keep`` and text, the main text.

    The whole page is parsed, cut or broken as it may be. Character references
    are decoded after the markup is gone; white space within a block is one
    space. A null, empty or textless page has an empty text; nulls in ``keep``
    stay; repeated pages each get their row; other columns are not read. A page is
    one task's work at a time, of a size in proportion to the page.
    """
    slim = pages.select(*[pages[c] for c in keep], pages[html_col].alias("_html"))
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(x.as_py()) for x in batch.column(len(keep))], pa.string())
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, texts], [*keep, "text"])

    return slim.mapInArrow(run, f"{schema}, text string")
