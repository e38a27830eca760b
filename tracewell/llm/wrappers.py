"""Main text of web pages by union-free regular-expression inference.

Pages of a host are read as token trees. Repeated siblings fold into repeated groups; page after page is aligned with
the host's wrapper, where a mismatch of elements makes an optional group and a mismatch of texts a slot. The finished
wrapper is a regular expression without unions: constants, slots, optional and repeated groups. Its deepest element with
the slots' text outside boilerplate is the host's main region, from which each page's blocks are taken.

Wrappers are merged within tasks, then over salted groups, then by host, so a host with a third of all pages is no
single task. A wrapper's size is bounded by the template, not by the pages: past ``MOST_ENTRIES`` different children
an element becomes a free region of so many characters, below which no main region is named.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import stored

SALTS = 32
MOST_ENTRIES = 60
#: A text that this many pages of a host share, and all that have its place, belongs to the template.
TEMPLATE_PAGES = 5
#: The main region is the deepest element that holds all of the slots' text; an article or main element needs this share.
ARTICLE_SHARE = 0.6

#: Elements nested deeper lie side by side at this depth, with all their texts.
DEEPEST = 150

TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">]++)*+)>")
#: For pages in which a quote never ends: a tag ends at the next bracket.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][\w:-]*+)([^>]*+)>")
TAG_START = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
# HTML's element names.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Skipped elements that stand inside a paragraph without ending it.
PHRASING = set("svg math button select textarea iframe object script noscript template".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = set("html body article section main div ul ol dl table tbody td th blockquote aside nav header footer form".split())
SKIPPED = set("head script style noscript template nav footer aside form button select textarea title iframe object svg math dialog menu".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words of class, id and role that mark what isn't the article. Those of the first group always do; the others do not on
#: an element that holds most of a page's text.
_ALWAYS = r"nav\w*|menu\w*|breadcrumbs?|masthead|footer|comments?|respond|replies|disqus\w*|cookies?|consent|popup|modal|overlay|newsletter|subscribe|signup|login|sharing|related|recommend\w*|ads?|advert\w*|banner|sponsor\w*|promo\w*|pagination|pager|complementary|contentinfo|navigation|dialog"
_MOSTLY = r"header|sidebar\w*|aside|widget\w*|notices?|alert|search|share|social|skip"
MARKS = re.compile(rf"(?:^|[_-])(?:({_ALWAYS})|{_MOSTLY})(?:$|[_-])", re.I)
#: Words that turn a mark's meaning: ``no-comments``, ``has-sidebar``.
TURNED = re.compile(r"(?:^|[_-])(?:no|without|has|with|free|hide|hidden)(?:$|[_-])", re.I)


@cache
def marked(mark: str) -> int:
    """0 for a mark of no meaning, 1 for one that tells unless the element holds most of the text, 2 for one that always
    tells."""
    found = [m for word in mark.split() if not TURNED.search(word) for m in MARKS.finditer(word)]
    return max((2 if m[1] else 1 for m in found), default=0)


class Element:
    """An element of a page: its name, its class and id, and children that are elements or decoded texts."""

    __slots__ = ("name", "mark", "hidden", "children")

    def __init__(self, name: str, mark: str = "", hidden: bool = False) -> None:
        self.name, self.mark, self.hidden, self.children = name, mark, hidden, []


def tags(page: str, at: int, pattern: re.Pattern) -> Iterator[tuple[int, int, re.Match | None, re.Pattern]]:
    """The markup from ``at`` on, as begin, end, the match of a tag (None for comments and declarations), and the pattern to
    go on with. No part of the page is looked at again and again, however broken it is."""
    last = page.rfind(">")
    while (begin := page.find("<", at)) >= 0:
        at, tag = begin + 1, None
        if page.startswith("<!--", begin) or page.startswith("<![CDATA[", begin):
            close = "-->" if page[begin + 2] == "-" else "]]>"
            end = page.find(close, begin + 4)
            at = len(page) if end < 0 else end + len(close)
        elif begin > last:
            continue  # a bracket in a text
        elif page[begin + 1] in "!?":
            at = page.find(">", begin) + 1
        elif TAG_START.match(page, begin):
            tag = pattern.match(page, begin)
            if tag is None:  # a quote that never ends
                pattern = PLAIN_TAG
                tag = pattern.match(page, begin)
            at = tag.end()
        else:
            continue
        yield begin, at, tag, pattern


def parse(page: str) -> Element:
    """A page's tree. Open paragraphs and list items end where the next one starts; stray end tags are passed over."""
    root = Element("#page")
    stack, deep, at, pattern = [root], [], 0, TAG
    found_tags = tags(page, 0, pattern)
    while at < len(page):
        begin, end, token, pattern = next(found_tags, (len(page), len(page), None, pattern))
        text = page[at:begin]
        if text and not text.isspace():
            stack[-1].children.append(entities.unescape(text))
        elif text:
            stack[-1].children.append(" ")
        at = end
        if token is None:
            continue
        name = token[2].lower()
        if token[1]:
            if name in deep:
                while deep.pop() != name:
                    pass
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    deep.clear()
                    break
                if name in INLINE and stack[depth].name not in INLINE:
                    break
            continue
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(token[3])}
        mark = " ".join(found[k] for k in ("class", "id", "role") if found.get(k))
        element = Element(name, re.sub(r"\d+", "0", mark), "hidden" in found or found.get("aria-hidden") == "true")
        if name not in INLINE and name not in VOID and name not in PHRASING and not deep:
            closes = CLOSES.get(name, set())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == "p" or stack[depth].name in closes:
                    del stack[depth:]
                elif stack[depth].name in HOLDS or stack[depth].name in PHRASING:
                    break
        stack[-1].children.append(element)
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = page.find(">", close.end()) + 1 if close else 0
            at = at or len(page)
            found_tags = tags(page, at, pattern)
        elif name not in VOID and not token[3].rstrip().endswith("/"):
            if len(stack) < DEEPEST:
                stack.append(element)
            else:
                deep.append(name)
    return root


def boilerplate(name: str, mark: str, hidden: bool, inside_article: bool, most: bool) -> bool:
    """Whether an element isn't part of the article; ``most`` tells that it holds most of the text there is."""
    if hidden or name in SKIPPED:
        return hidden or name != "form" or not most
    if name in ("html", "body", "article", "main"):
        return False
    told = marked(mark)
    return told == 2 or (told == 1 and not most) or (name == "header" and not inside_article)


# A wrapper is [name, mark, entries, pages, characters]; the characters are those of an element whose entries became too
# many and are now the single "~". An entry is a wrapper with its quantifier, ["1" | "?" | "+" | "*", wrapper],
# or a text, ["#", constant or None, characters, pages].


def _fold(entries: list, pages: int) -> list:
    """Neighbouring entries of one kind become one repeated entry, neighbouring texts one text."""
    out: list = []
    for entry in entries:
        last = out[-1] if out else None
        if last and last[0] == "#" and entry[0] == "#":
            out[-1] = ["#", None, last[2] + entry[2], pages]
        elif last and last[0] != "#" and entry[0] != "#" and last[1][:2] == entry[1][:2]:
            merged = merge(last[1], entry[1])
            merged[3] = pages
            out[-1] = ["+", merged]
        else:
            out.append(entry)
    return out


def wrap(element: Element) -> list:
    """The wrapper of one page's element, with inline markup taken as text and repeated children folded."""
    entries: list = []
    for child in element.children:
        if isinstance(child, str):
            if text := " ".join(child.split()):
                entries.append(["#", text if len(text) <= 200 else None, len(text), 1])
        elif child.name in INLINE or child.name == "br":
            inner = wrap(child)
            entries += inner[2]
        elif child.name not in VOID:
            entries.append(["1", wrap(child)])
    return [element.name, element.mark, _fold(entries, 1), 1, 0]


def _key(entry: list):
    return "#" if entry[0] == "#" else (entry[1][0], entry[1][1])


def _quantifier(a: str, b: str) -> str:
    return {(False, False): "1", (False, True): "+", (True, False): "?", (True, True): "*"}[(a in "?*" or b in "?*", a in "+*" or b in "+*")]


def _characters(wrapper: list) -> int:
    """All characters of a wrapper's texts."""
    return wrapper[4] + sum(e[2] if e[0] == "#" else _characters(e[1]) for e in wrapper[2] if e != "~")


def merge(a: list, b: list) -> list:
    """Two wrappers of one kind of element aligned: shared entries merge, others become optional."""
    pages = a[3] + b[3]
    if a[2] == ["~"] or b[2] == ["~"]:
        return [a[0], a[1], ["~"], pages, _characters(a) + _characters(b)]
    x, y = [_key(e) for e in a[2]], [_key(e) for e in b[2]]
    length = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if x[i] == y[j] else max(length[i + 1][j], length[i][j + 1])
    out: list = []
    i = j = 0

    def lone(entry: list) -> list:
        return entry if entry[0] == "#" else [_quantifier(entry[0], "?"), entry[1]]

    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            p, q = a[2][i], b[2][j]
            if p[0] == "#":
                out.append(["#", p[1] if p[1] == q[1] else None, p[2] + q[2], p[3] + q[3]])
            else:
                out.append([_quantifier(p[0], q[0]), merge(p[1], q[1])])
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and length[i + 1][j] >= length[i][j + 1]):
            out.append(lone(a[2][i]))
            i += 1
        else:
            out.append(lone(b[2][j]))
            j += 1
    if len(out) <= MOST_ENTRIES:
        return [a[0], a[1], out, pages, 0]
    return [a[0], a[1], ["~"], pages, _characters(a) + _characters(b)]


def _texts(wrapper: list) -> Iterator[list]:
    for entry in wrapper[2]:
        if entry[0] == "#":
            yield entry
        elif entry != "~":
            yield from _texts(entry[1])


def _shape(wrapper: list) -> str:
    inner = ",".join("#" if e[0] == "#" else "~" if e == "~" else e[0] + _shape(e[1]) for e in wrapper[2])
    return f"{wrapper[0]}.{wrapper[1]}({inner})"


class Wrappers:
    """Wrappers by host, merged as pages come; pages of a shape already seen only have their texts compared."""

    def __init__(self) -> None:
        self.by_shape: dict[tuple[str, str], list] = {}

    def add(self, host: str, wrapper: list) -> None:
        key = (host, _shape(wrapper))
        known = self.by_shape.get(key)
        if known is None:
            self.by_shape[key] = wrapper
            return
        self._count(known, wrapper)
        for p, q in zip(_texts(known), _texts(wrapper), strict=True):
            p[1:] = [p[1] if p[1] == q[1] else None, p[2] + q[2], p[3] + q[3]]

    def _count(self, known: list, new: list) -> None:
        known[3] += new[3]
        known[4] += new[4]
        for p, q in zip(known[2], new[2], strict=True):
            if p[0] not in "#~":
                self._count(p[1], q[1])

    def merged(self) -> dict[str, list]:
        out: dict[str, list] = {}
        for (host, _), wrapper in sorted(self.by_shape.items()):
            out[host] = merge(out[host], wrapper) if host in out else wrapper
        return out


def main_path(wrapper: list) -> dict[str, list]:
    """``path``: names and marks of the elements from the page down to the host's main region; ``most``: those of elements
    that look like boilerplate, but hold at least half of the slots' text."""

    def slots(node: list) -> int:
        """Characters that aren't the template's, whatever the weaker marks."""
        if node[0] in SKIPPED and node[0] != "form" or marked(node[1]) == 2:
            return 0
        texts = [e for e in node[2] if e[0] == "#"]
        own = sum(e[2] for e in texts if e[1] is None or e[3] < TEMPLATE_PAGES)
        return node[4] + own + sum(slots(e[1]) for e in node[2] if e[0] not in "#~")

    def article_in(node: list) -> bool:
        return (node[0] in ("article", "main") and slots(node) > 0) or any(article_in(e[1]) for e in node[2] if e[0] not in "#~")

    total, most, told = slots(wrapper), [], article_in(wrapper)  # pages with articles leave less to guess

    def held(node: list, article: bool) -> int:
        """The slots' characters that aren't in boilerplate."""
        if boilerplate(node[0], node[1], False, article, False):
            if node[:2] not in most:
                apart = told and not article and not article_in(node)
                if apart or boilerplate(node[0], node[1], False, article, True) or not total or 2 * slots(node) < total:
                    return 0
                most.append(node[:2])
        article = article or node[0] in ("article", "main")
        own = sum(e[2] for e in node[2] if e[0] == "#" and (e[1] is None or e[3] < TEMPLATE_PAGES))
        return node[4] + own + sum(held(e[1], article) for e in node[2] if e[0] not in "#~")

    path, node, article, whole = [], wrapper, False, held(wrapper, False)
    while whole and node[2] != ["~"]:
        article = article or node[0] in ("article", "main")
        inner = [e[1] for e in node[2] if e[0] in "1?" and e[1][0] in HOLDS]  # a repeated group is content, not a region
        best = max(inner, key=lambda n: held(n, article), default=None)
        least = ARTICLE_SHARE * whole if best and best[0] in ("article", "main") else held(node, article)
        if best is None or held(best, article) < least:
            break
        path.append(best[:2])
        node = best
    return {"path": path, "most": most}


def blocks(root: Element, main: dict[str, list]) -> list[str]:
    """The blocks of text of a page's main region, as :func:`main_path` gives it, in page order; of the whole page if it
    hasn't the region. All elements that the path names are read."""
    regions, article = [root], False
    for name, mark in main["path"]:
        inner = [c for r in regions for c in r.children if not isinstance(c, str) and c.name == name and c.mark == mark]
        if not inner:
            regions, article = [root], False
            break
        regions, article = inner, article or name in ("article", "main")
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(held).split()):
            out.append(text)
        held.clear()

    def walk(element: Element, inside: bool) -> None:
        for child in element.children:
            if isinstance(child, str):
                held.append(child)
            elif child.name == "br":
                held.append(" ")
            elif boilerplate(child.name, child.mark, child.hidden, inside, [child.name, child.mark] in main["most"]):
                if child.name not in PHRASING:
                    flush()
            elif child.name in INLINE:
                walk(child, inside)
            else:
                flush()
                if child.name not in VOID:
                    walk(child, inside or child.name in ("article", "main"))
                    flush()

    for region in regions:
        walk(region, article)
        flush()
    return out


def infer(pages: DataFrame) -> DataFrame:
    """``(host, path)`` of the pages ``(host, html)``: each host's main region, as JSON."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Wrappers()
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.add(host, wrap(parse(page)))
        yield rows(found)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Wrappers()
        for batch in batches:
            for host, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.add(host, json.loads(text))
        yield rows(found)

    def rows(found: Wrappers) -> pa.RecordBatch:
        done = found.merged()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(done), pa.string()), pa.array([json.dumps(w) for w in done.values()], pa.string())], ["host", "wrapper"]
        )

    schema = "host string, wrapper string"
    part = pages.mapInArrow(first, schema)
    part = part.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).repartition("host", "salt").drop("salt")
    whole = part.mapInArrow(again, schema).repartition("host").mapInArrow(again, schema)

    def path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.dumps(main_path(json.loads(w))) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string()), batch.column(1)], ["host", "path", "wrapper"])

    return whole.mapInArrow(path, "host string, path string, wrapper string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``id, url, text``, the main text's blocks joined by line feeds, empty if there is none.

    Null pages are empty, pages with a null or odd url share one host, pages without their host's main region are read
    whole. Pages are read whole, however long, broken or deeply nested: elements nested deeper than ``DEEPEST`` lie side by
    side there, and if a quote in a tag never ends, tags from there on end at the next bracket. Equal rows give equal rows; extra columns are ignored; an empty table gives no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][\w+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")
    )
    paths = stored(infer(rows.select("host", "html")), "wrappers").select("host", "path")
    schema = T.StructType(
        [T.StructField("id", pages.schema[id_col].dataType), T.StructField("url", T.StringType()), T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                "\n".join(blocks(parse(page), json.loads(path)))
                for page, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], schema.names)

    return rows.join(paths, "host").select("id", "url", "html", "path").mapInArrow(run, schema)
