"""Main text of web pages by tree scoring.

A page is parsed into a light tree. Paragraphs give points for length and commas to the elements above
them, all to the parent and less further up, and an element's points are cut by the share of its text
that is link text. The element with most points, widened to the article or main element around it, is
the text's container; siblings with enough points of their own, or that read like paragraphs, stay with
it. What is never article text (menus, forms, adverts and so on) is left out before scoring.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""",
    re.S).search
_NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I).findall

# What elements mean in HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
          "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
          "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
HOLDERS = {"article", "main", "section", "div", "td", "th", "body", "ul", "ol", "dl", "table", "aside", "blockquote", "li"}
NOT_TEXT = {"nav", "footer", "aside", "form", "button", "select", "input", "svg", "canvas", "object", "menu", "dialog",
            "audio", "video", "map", "head", "fieldset"}
NOT_TEXT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
# Words of class and id names.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adbox|banner|breadcrumbs?|combx|comments?|commentlist|consent|cookies?|disqus|disclaimer|"
    r"footer|footnav|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notification|pager|pagination|"
    r"popup|promo|promoted|reader-comments|related|remark|replies|respond|rss|share|shares|sharing|shoutbox|side|sidebar|skip|social|"
    r"sponsor|sponsored|subscribe|tags|teaser|toolbar|topbar|widget|alert|signup|login)(?:$|[\s_-]|\d)", re.I).search
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|content|entry|main|post|story|text)(?:$|[\s_-]|body)", re.I).search
PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd"}
WEIGHTS = {"article": 10.0, "main": 8.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0,
           "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "th": -5.0}


class Node:
    __slots__ = ("tag", "parent", "items", "skip", "likely", "score", "length", "linked", "commas", "paragraph")

    def __init__(self, tag: str, parent: "Node | None", skip: bool = False, likely: bool = False):
        self.tag, self.parent, self.items, self.skip, self.likely = tag, parent, [], skip, likely
        self.score, self.length, self.linked, self.commas, self.paragraph = None, 0, 0, 0, False


def _unwanted(tag: str, attributes: str, parent: Node) -> tuple[bool, bool]:
    """Whether an element is never article text, and whether its names say that it is."""
    if tag in NOT_TEXT:
        return True, False
    if tag == "header":
        node = parent
        while node and node.tag not in ("article", "main"):
            node = node.parent
        if node is None:
            return True, False
    if not attributes or attributes == "/" or tag in ("body", "html"):
        return False, False
    names = []
    for name, value in _NAMES(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            names.append(value)
        elif name == "role" and value.lower() in NOT_TEXT_ROLES or name == "hidden" \
                or name == "aria-hidden" and value.lower() == "true" \
                or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, False
    likely = any(LIKELY(n) for n in names)
    return tag not in ("article", "main") and any(UNLIKELY(n) for n in names) and not (
        likely and not any(re.search(r"comment|sidebar|(?:^|[\s_-])ad", n, re.I) for n in names)), likely


def parse(html: str) -> list[Node]:
    """All elements in page order; the first is the root."""
    root = Node("body", None)
    nodes, here, at = [root], root, 0
    while True:
        found = _TOKEN(html, at)
        if found is None:
            here.items.append(html[at:])
            return nodes
        if found.start() > at:
            here.items.append(html[at:found.start()])
        at = found.end()
        end, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if end:
            node = here
            while node and node.tag != tag and not (tag in INLINE and node.tag not in INLINE):
                node = node.parent
            if node and node.tag == tag and node is not root:
                here = node.parent
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        if tag in VOID:
            here.items.append(" ")
            if tag == "hr":
                here.items.append(Node(tag, here))
            continue
        if tag in ("html", "body"):
            node = here
            while node.parent and node.tag != "head":
                node = node.parent
            here = root if node.tag == "head" else here  # an open head ends where the body begins
            continue
        if tag not in INLINE:
            closes = CLOSED_BY.get(tag)
            node = here
            while node and node.tag not in HOLDERS or node and closes and node.tag in closes:
                if node.tag == "p" or closes and node.tag in closes:
                    here = node.parent
                    if node.tag != "p":
                        break
                node = node.parent
        skip, likely = _unwanted(tag, attributes, here)
        node = Node(tag, here, here.skip or skip, likely)
        here.items.append(node)
        nodes.append(node)
        if not attributes.endswith("/") or tag in INLINE or tag in HOLDERS:
            here = node


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        if node.skip:
            continue
        for item in node.items:
            if item.__class__ is str:
                length = len(item) if not item.isspace() else 0
                node.length += length
                node.commas += item.count(",")
                node.paragraph |= length > 0
            elif not item.skip:
                node.length += item.length
                node.linked += item.length if item.tag == "a" else item.linked
                if item.tag in INLINE:
                    node.commas += item.commas
                    node.paragraph |= item.paragraph


def _score(nodes: list[Node]) -> Node | None:
    """Passes paragraphs' points up; returns the element with most points, the first on a tie."""
    for node in nodes:
        if node.skip or not node.paragraph or not node.length or node.tag in INLINE:
            continue
        if node.tag not in PARAGRAPHS and node.tag not in HOLDERS:
            continue
        points = (1 if node.length >= 25 else node.length / 25) + node.commas + min(node.length / 100, 3)
        points *= 1 - min(1.0, node.linked / node.length)
        above, level = node.parent if node.tag in PARAGRAPHS else node, 0
        while above and level < 5:
            if above.score is None:
                above.score = WEIGHTS.get(above.tag, 0.0) + (5.0 if above.likely else 0.0)
            above.score += points if level == 0 else points / 2 if level == 1 else points / (3 * level)
            above, level = above.parent, level + 1
    best = None
    for node in nodes:
        if node.score is not None and not node.skip:
            node.score *= 1 - min(1.0, node.linked / max(1, node.length))
            if best is None or node.score > best.score:
                best = node
    return best


def _kept(best: Node) -> list[Node]:
    """The container and the siblings that stay with it, in page order."""
    node = best
    while node:
        if node.tag in ("article", "main"):
            best = node
        node = node.parent
    if best.parent is None:
        return [best]
    out, least = [], max(10.0, best.score * 0.2 if best.score else 0.0)
    for node in best.parent.items:
        if node.__class__ is str or node.skip:
            continue
        density = node.linked / max(1, node.length)
        if node is best or (node.score or 0.0) >= least or node.tag == "p" and (
                node.length > 80 and density < 0.25 or 0 < node.length <= 80 and not density and node.commas):
            out.append(node)
    return out


def _blocks(node: Node, out: list[list[str]]) -> None:
    """Text runs by block; a stack instead of recursion, for pages nested very deeply."""
    stack = [(node, 0)]
    out.append([])
    while stack:
        node, k = stack.pop()
        items = node.items
        while k < len(items):
            item = items[k]
            k += 1
            if item.__class__ is str:
                out[-1].append(item)
            elif not item.skip:
                stack.append((node, k))
                if item.tag not in INLINE:
                    out.append([])
                stack.append((item, 0))
                break
        else:
            if node.tag not in INLINE:
                out.append([])


def main_text(html: str | None) -> str:
    """The article of a page: one line a block, white space in it as single spaces, references decoded."""
    if not html:
        return ""
    nodes = parse(html)
    _measure(nodes)
    best = _score(nodes)
    if best is None:
        return ""
    blocks: list[list[str]] = []
    for node in _kept(best):
        _blocks(node, blocks)
    lines = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract_text(pages: DataFrame) -> DataFrame:
    """pages without `html`, with `text` and `n_chars` (instead of columns so named).

    One row for each row, whatever the other columns hold. Null or empty html, and pages without any text,
    give an empty text. Markup that is cut off or nested wrongly is read as far as it goes. No page is
    dropped and no text capped; an empty table gives an empty result.
    """
    passing = [c for c in pages.columns if c.lower() not in ("html", "text", "n_chars")]
    names = {c: f"_in{k}" for k, c in enumerate(passing)}
    rows = pages.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("html").cast("string").alias("html"))
    schema = StructType([rows.schema[n] for n in names.values()]).add("text", StringType()).add("n_chars", LongType())

    def extract(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names.values()), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=[*names.values(), "text", "n_chars"])

    return rows.mapInArrow(extract, schema).toDF(*passing, "text", "n_chars")
