"""Main text of web pages by composite text density.

A page is read into a tree. Elements that are never article text (menus, scripts,
forms, adverts and the like, by tag, role, class or id) are set aside. Every other
node gets its composite density, the characters per tag adjusted by how much of
both belongs to links, and the sum of its children's densities. The subtree with
the largest sum is the article's core. The article is the core's highest ancestor,
within its <article> or <main> if it has one, up to which no step adds mostly links;
every block in it that is not set aside is kept. Beside it, the least density on the
path from the body to the core is the threshold by which neighbours belong to it.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches

# Elements by their role in a page.
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th pre blockquote "
    "figure figcaption address header footer nav aside form fieldset hr br details summary center hgroup search dialog menu option".split()
)
ASIDE = frozenset(
    "head nav aside footer header button select option input label fieldset dialog menu svg canvas object audio video map search".split()
) | RAW
OWN_END = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner comment comments disqus respond reply replies cookie "
    "cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead "
    "share sharing social related recommended newsletter subscribe subscription signup login search pagination pager toolbar widget skip".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
#: Names that readers' own words stand under, which may outweigh the article.
READERS = frozenset("comment comments disqus respond reply replies".split())
#: Words before a name that say it is something else: no-sidebar, has-sidebar.
OTHERWISE = frozenset("no non not without with has have had is in hide hidden post".split())
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++)))?+|[\"'][^\s]*+")


def _named_noise(value: str) -> str | None:
    """The noise name that a whole class or id, its first part, or its last part is."""
    for token in value.split():
        if token in NOISE:
            return token
        first, *_, last = re.split(r"[_\-]+", token) if "-" in token or "_" in token else (token, token)
        if first in NOISE:
            return first
        if last in NOISE and first not in OTHERWISE:
            return last
    return None


def _noise(tag: str, attributes: str) -> str | bool:
    """Whether an element is set aside; if its class or id alone says so, or a form does, the name that does."""
    if tag in ASIDE:
        return True
    named: str | bool = "form" if tag == "form" else False  # a form may be wrapped around a whole page
    if not attributes.strip() or tag in ("html", "body", "main", "article"):
        return named
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "role" and not NOISE_ROLES.isdisjoint(value.split()):
            return True
        if name in ("class", "id"):
            named = named if named in READERS else _named_noise(value) or named
    return named


class Page:
    """The tree of a page: per node its parent, tag and whether it is set aside, and texts and breaks in page order."""

    def __init__(self, source: str):
        self.parent, self.tag, self.aside = [-1], ["body"], [False]
        self.named: dict[int, str] = {}  # nodes that only a class, an id or being a form speaks against
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of each tag, their places in the stack
        self.blocks: list[int] = []  # the places of open blocks
        self.flow: list[tuple[int, str | None]] = []  # (node, text), or (node, None) for a break between blocks
        stack, at, size = [0], 0, len(source)
        while at < size:
            found = _TOKEN.search(source, at)
            end = found.start() if found else size
            if end > at:
                self.flow.append((stack[-1], html.unescape(source[at:end])))
            if not found:
                break
            at = found.end()
            if closing := found[1]:
                self._close(stack, closing.lower())
            elif opening := found[2]:
                tag = opening.lower()
                self._open(stack, tag, found[3])
                if tag in RAW and not found[3].endswith("/"):
                    over = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                    at = over.start() if over else size
        if self.named:
            self._set_aside()

    def _set_aside(self) -> None:
        """Set aside what its class or id speaks against, unless it holds most of the page's unlinked text and all of its articles'."""
        n = len(self.parent)
        linked, chars, below, within, of_article = [False] * n, [0] * n, [False] * n, [False] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            linked[i] = linked[up] or self.tag[i] == "a"
            below[i] = below[up] or self.named.get(i) in READERS
            within[i] = within[up] or self.tag[i] in ("article", "main")
        for node, text in self.flow:
            if text and not (self.aside[node] or linked[node] or below[node]):
                size = len("".join(text.split()))
                chars[node] += size
                of_article[node] += size if within[node] else 0
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            of_article[self.parent[i]] += of_article[i]
        for i in range(1, n):
            named = i in self.named and (below[i] or 2 * chars[i] <= chars[0] or of_article[i] < of_article[0])
            self.aside[i] = self.aside[i] or self.aside[self.parent[i]] or named

    def _break(self, node: int) -> None:
        self.flow.append((node, None))

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in BLOCK:
            if tag != "br":
                self._end_paragraph(stack)
            for other in (("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)):
                if tag in OWN_END:
                    self._pop_to(stack, other, OWN_END[tag])
            self._break(stack[-1])
        if tag in ("html", "body"):
            return
        node = len(self.parent)
        self.parent.append(stack[-1])
        self.tag.append(tag)
        noise = _noise(tag, attributes)
        if isinstance(noise, str):
            self.named[node] = noise
        self.aside.append(self.aside[stack[-1]] or noise is True)
        if tag not in VOID and not (attributes.endswith("/") and tag not in BLOCK):
            self.places[tag].append(len(stack))
            if tag in BLOCK:
                self.blocks.append(len(stack))
            stack.append(node)

    def _cut(self, stack: list[int], place: int) -> None:
        """End the open elements from ``place`` on."""
        for node in stack[place:]:
            self.places[self.tag[node]].pop()
            if self.tag[node] in BLOCK:
                self.blocks.pop()
        del stack[place:]

    def _last(self, tag: str) -> int:
        """The place of the innermost open element of a tag; 0 if there is none."""
        places = self.places.get(tag)
        return places[-1] if places else 0

    def _end_paragraph(self, stack: list[int]) -> None:
        """A block ends an open paragraph, unless a block stands between them."""
        if self.blocks and self.blocks[-1] == self._last("p"):
            self._cut(stack, self.blocks[-1])

    def _pop_to(self, stack: list[int], tag: str, bounds: tuple[str, ...]) -> None:
        if self._last(tag) > max(map(self._last, bounds)):
            self._cut(stack, self._last(tag))

    def _close(self, stack: list[int], tag: str) -> None:
        if tag in BLOCK:
            self._break(stack[-1])
        if self._last(tag):
            self._cut(stack, self._last(tag))

    def densities(self) -> tuple[list[float], list[float]]:
        """(composite density, sum of the children's) of every node that is not set aside; others have 0."""
        n = len(self.parent)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for i in range(1, n):
            linked[i] = linked[self.parent[i]] or self.tag[i] == "a"
        for node, text in self.flow:
            if text and not self.aside[node]:
                size = len("".join(text.split()))
                chars[node] += size
                link_chars[node] += size if linked[node] else 0
        for i in range(n - 1, 0, -1):
            if not self.aside[i]:
                up = self.parent[i]
                chars[up] += chars[i]
                link_chars[up] += link_chars[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i] + (self.tag[i] == "a")
        self.sizes = chars, link_chars
        density, sums = [0.0] * n, [0.0] * n
        of_page = link_chars[0] / max(chars[0], 1)
        for i in range(n):
            if chars[i] and not self.aside[i]:
                c, t, lc, lt = chars[i], max(tags[i], 1), max(link_chars[i], 1), max(link_tags[i], 1)
                base = math.log(c / max(c - link_chars[i], 1) * lc + of_page * c + math.e)
                density[i] = c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9, max(base, 1.01))
                if i and self.tag[i] in BLOCK:  # words marked inside a block are no parts of it
                    sums[self.parent[i]] += density[i]
        return density, sums

    def article(self) -> set[int]:
        """The roots of the article's subtrees."""
        density, sums = self.densities()
        top = max(range(len(sums)), key=lambda i: sums[i])
        if sums[top] <= 0:
            return {0}  # text stands in the body itself
        path, node = [], top
        while node >= 0:
            path.append(node)
            node = self.parent[node]
        threshold = min(density[i] for i in path)
        root = self._root(path)
        on_path = set(path)
        beside = {i for i in range(1, len(density)) if self.parent[i] in on_path and i not in on_path and not self.aside[i]}
        return {root} | {i for i in beside if self.parent[i] != top and density[i] >= threshold > 0}

    def _root(self, path: list[int]) -> int:
        """Of the core and its ancestors, the highest that is reached without adding mostly links."""
        named = [place for place, i in enumerate(path) if self.tag[i] in ("article", "main")]
        chars, link_chars = self.sizes
        root = path[0]
        for up in path[1 : (named[-1] + 1 if named else None)]:
            if 2 * (link_chars[up] - link_chars[root]) > chars[up] - chars[root]:
                break
            root = up
        return root

    def text(self) -> str:
        """The article's blocks, one per line."""
        roots = self.article()
        inside = [False] * len(self.parent)
        for i in range(len(self.parent)):
            inside[i] = not self.aside[i] and (i in roots or i > 0 and inside[self.parent[i]])
        blocks, held = [], []
        for node, text in [*self.flow, (0, None)]:
            if text is None:
                if block := " ".join("".join(held).split()):
                    blocks.append(block)
                held = []
            elif inside[node]:
                held.append(text)
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page has an empty text, as has one without article text; null
    ids and addresses are kept; repeated rows each give a row; an empty table gives
    none; other columns are left aside.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    return map_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), run, "page_id long, url string, text string, n_chars long")
