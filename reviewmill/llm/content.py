"""Main text of a page by composite text density.

A page becomes a tree of nodes. What its tag names as menu, header, footer, aside, form, script or style is cut off,
unless it holds an article. A role, class or id that names such a thing, or reader comments, or an advert, is evidence:
the node's density counts by a tenth, or by a little less for words that articles use as well, and it is cut only
where that falls short beside the densest node. Every node gets a density: characters per tag, where links
count against it by the shares of linked and unlinked characters and tags. Of the containers, the one
whose children's densities have the largest sum holds the article. The smallest density on the path from it
to the body, or to a main element around it, is the threshold: what hangs from that path and reaches it belongs to
the article as well. Of equal sums an article or main element wins. Blocks of links below the threshold are left out.

Defined results: a null or empty page has an empty text; tags that are never closed end with their parent; a
broken tag is text; repeated rows give the same text; other columns pass through.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from reviewmill.llm.common import unused

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<close>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACES = re.compile(r"[\x20\x09-\x0D]+")
_PARTS = re.compile(r"[^a-z0-9]+")

# Elements of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = frozenset("article body center dd div dl fieldset figure html li main ol section table tbody td tr ul blockquote".split())
#: A start tag ends these open elements, looked for up to the nearest container.
_ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_CUT_TAGS = frozenset("nav header footer aside form button select input label dialog menu head".split()) | _RAW
#: Words of a menu or box that an article's own parts may have as well.
_WEAK_WORDS = frozenset("notice alert form related recommended promotion response responses reply replies".split())
#: Parts of a name that say where a thing stands, not what it is.
_PLACES = frozenset("site page main top bottom left right list box bar area block section container wrapper slot links item items".split())
#: How much of a density counts after strong and weak evidence, and the share of the threshold it must reach in the article.
STRONG, WEAK, ENOUGH = 0.1, 0.7, 0.35
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert popup modal newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs pager pagination "
    "header masthead footer sidebar aside widget widgets related recommended share sharing social comment comments disqus "
    "reply replies responses form search toolbar".split()
)


class Node:
    __slots__ = ("tag", "parent", "items", "hint", "holds", "chars", "tags", "link_chars", "link_tags", "density", "trust", "cut")

    def __init__(self, tag: str, parent: Node | None, hint: float = 1.0):
        self.tag, self.parent, self.hint = tag, parent, hint
        self.items: list = []  # texts and nodes in page order
        self.holds = tag in ("article", "main")
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density, self.trust, self.cut = 0.0, 1.0, False


def _hinted(tag: str, attributes: str) -> float:
    """How much of the node's density counts after what its role, classes and id say."""
    hint = 1.0
    if tag in ("html", "body", "article", "main"):
        return hint
    for name, *values in _ATTRIBUTE.findall(attributes):
        for word in "".join(values).lower().split():
            if name.lower() == "role":
                hint = min(hint, STRONG if word in _CUT_ROLES else 1.0)
                continue
            # A compound counts only as a whole: with-sidebar, no-comments and long-form name something else.
            parts = {part for part in _PARTS.split(word) if part and not part.isdigit()}
            named = parts & _CUT_WORDS
            if not named or parts - named - _PLACES:
                continue
            if not named <= _WEAK_WORDS:
                hint = min(hint, STRONG)
            elif tag in _CONTAINER:
                hint = min(hint, WEAK)
    return hint


def parse(page: str) -> Node:
    root = node = Node("html", None)
    place, end = 0, len(page)
    while place < end:
        match = _TOKEN.search(page, place)
        start = match.start() if match else end
        if start > place:
            node.items.append(page[place:start])
        if not match:
            break
        place = match.end()
        if not match["name"]:
            continue
        tag = match["name"].lower()
        if match["close"]:
            found = node
            while found is not None and found.tag != tag:
                found = found.parent
            if found is not None and found.parent is not None:
                node = found.parent
            continue
        if tag in _RAW:
            closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, place)
            # A raw element that is never closed swallows the rest only if it cannot hold text.
            if closing:
                place = closing.end()
            elif tag in ("script", "style"):
                place = end
            continue
        if tag in ("html", "body"):
            # Later copies of these only lend their place to the one there is.
            if tag == "body" and node.tag == "head":
                node = node.parent
            if tag == "html":
                continue
        ends = _ENDS.get(tag, "").split() or (["p"] if tag in _BLOCK else [])
        if ends:
            found = node
            while found is not None and found.tag not in ends and (found.tag not in _CONTAINER or found.tag in ends):
                found = found.parent
            if found is not None and found.tag in ends and found.parent is not None:
                node = found.parent
        child = Node(tag, node, _hinted(tag, match["attributes"]) if match["attributes"] else 1.0)
        node.items.append(child)
        if tag not in _VOID and not match["attributes"].endswith("/"):
            node = child
    return root


def _walk(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    found = [root]
    for node in found:
        found.extend(item for item in node.items if isinstance(item, Node))
    return found


def _measure(root: Node) -> list[Node]:
    nodes = _walk(root)
    for node in reversed(nodes):
        if node.parent is not None:
            node.parent.holds |= node.holds
    for node in nodes:
        above = node.parent
        # A heading's header inside the article is kept; another wrapper that holds the article only counts for less.
        named = node.tag in _CUT_TAGS and not (node.tag == "header" and any(n.tag in ("article", "main") for n in _up(node)))
        if named and node.holds:
            node.hint = min(node.hint, STRONG)
        node.trust = node.hint * (above.trust if above is not None else 1.0)
        node.cut = (above is not None and above.cut) or (named and not node.holds)
    live = [node for node in nodes if not node.cut]
    for node in reversed(live):
        own = sum(len(_SPACES.sub(" ", item).strip()) for item in node.items if isinstance(item, str))
        node.chars += own
        linked = node.tag == "a"
        if linked:
            node.link_chars, node.link_tags = node.chars, node.tags + 1
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.tags += node.tags + 1
            node.parent.link_chars += node.link_chars
            node.parent.link_tags += node.link_tags
    all_chars, all_links = max(root.chars, 1), root.link_chars
    for node in live:
        c, t, lc, lt = node.chars, max(node.tags, 1), node.link_chars, node.link_tags
        if not c:
            continue
        plain = max(c - lc, 1)
        weight = math.log(c / plain * lc + all_links / all_chars * c + math.e)
        node.density = c / t * max(math.log(c / max(lc, 1) * t / max(lt, 1)), 0.0) / weight + c / t * 1e-9
    return live


def _up(node: Node) -> Iterator[Node]:
    while node.parent is not None:
        node = node.parent
        yield node


def main_nodes(root: Node) -> list[Node]:
    """The nodes whose text is the article, in page order."""
    live = _measure(root)
    sums = [
        (_sum(node), node.tag in ("article", "main"), -i, node)
        for i, node in enumerate(live)
        if node.tag in _CONTAINER and node.chars
    ]
    if not sums:
        return [root]
    best = max(sums, key=lambda s: s[:3])[3]
    path = [best, *_up(best)]
    bound = next((i for i, node in reversed(list(enumerate(path))) if node.tag == "main"), len(path) - 1)
    path = path[: bound + 1]
    least = min((node.density for node in path if node.tag != "html"), default=best.density)
    chosen = {id(best)}
    for above, below in zip(path[1:], path):
        chosen.update(
            id(item) for item in above.items if isinstance(item, Node) and item is not below and not item.cut and item.density * item.hint >= least
        )
    found = [node for node in live if id(node) in chosen]
    for node in found:
        _cut_inside(node, least)
    return found


def _sum(node: Node) -> float:
    """The densities of the children and of the node's own text, by what their names leave of them."""
    return sum(item.density * item.trust for item in node.items if isinstance(item, Node) and not item.cut) + _direct(node) * node.trust


def _cut_inside(top: Node, least: float) -> None:
    """Cuts what the article holds of lists of links, below the threshold, and of blocks whose names speak against them."""
    for node in _walk(top)[1:]:
        above = node.parent
        links = node.tag in _CONTAINER and node.link_tags > 1 and 2 * node.link_chars > node.chars and node.density < least
        named = node.hint < 1 and node.density * node.hint < ENOUGH * least
        node.cut = node.cut or above.cut or links or named


def _direct(node: Node) -> float:
    """Density of text that stands in the node itself, as if it were a child."""
    return float(sum(len(item.strip()) for item in node.items if isinstance(item, str)))


def block_text(nodes: list[Node]) -> str:
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACES.sub(" ", html.unescape("".join(line))).strip(" ")
        if text:
            blocks.append(text)
        line.clear()

    def order(node: Node) -> list[int]:
        places = []
        while node.parent is not None:
            places.append(next(i for i, item in enumerate(node.parent.items) if item is node))
            node = node.parent
        return places[::-1]

    for top in sorted(nodes, key=order) if len(nodes) > 1 else nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                line.append(item)
            elif item is None:
                flush()
            elif not item.cut:
                if item.tag == "br":
                    line.append(" ")
                    continue
                if item.tag in _BLOCK:
                    flush()
                    stack.append(None)
                stack.extend(reversed(item.items))
        flush()
    return "\n".join(blocks)


def main_text(page: str | None) -> str:
    return block_text(main_nodes(parse(page))) if page else ""


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without the markup, with ``text``."""
    name = unused([c for c in pages.columns if c != column], "text")
    others = [c for c in pages.columns if c != column]
    schema = pages.select(*(f"`{c}`" for c in others)).schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(batch.schema.get_field_index(column))]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string())], names=[*others, name])

    return pages.mapInArrow(run, schema)
