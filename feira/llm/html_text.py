"""Main text of web pages by composite text density.

For every node of the document tree, with C characters, T tags, LC link characters and LT
link tags below it, and the same numbers of the body (index b), the density is

    C / T * log((C * T) / (LC * LT), base ln(C * LC / (C - LC) + C * LC_b / C_b + e)),

characters per tag, lowered where text is link text (a zero divisor counts as 1). A
node's sum is the sum of its children's densities. The node of the largest sum leads to
the article; the smallest density on the path from the body to it is the threshold.
Without an article or main element the text of the body is the article, if all containers
beside the path reach the threshold. Otherwise each neighbour of the path is judged by
itself: it belongs to the article if it isn't mostly links and, being a container or list,
has a tenth of the threshold, or two fifths of it if it is of a single part.
Containers of links inside the article must reach the threshold to stay.

Elements that are never main text by their tag, role or class (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, reader comments) are taken out first;
of a header inside an article the headings stay. Classes and ids count as whole words or
compounds of such, so has-sidebar is none. A form, or an element marked by role, class or
id, that holds the main element or the largest article, or most of its characters outside
of links (of the page's, without these), is left to the densities. A paragraph ends where
the next block begins, closed or not.

Defined cases: null or empty html, and pages without text, give an empty text. Html
without tags is one block. Rows are judged one by one; repeated rows give equal rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
DROPPED = frozenset(
    "head script style noscript template iframe object svg canvas nav footer aside "
    "button select textarea input dialog menu title".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure footer header hr html li main ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
LISTS = CONTAINERS | frozenset("ul ol dl figure details".split()) - {"article", "main", "body", "html"}
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu "
    "menubar toolbar".split()
)
#: Words of a class or id that mark an element as no main text, and as readers' comments.
READERS = re.compile(r"comments?|commentlist|respond|replies|disqus", re.IGNORECASE)
NOISE = re.compile(
    r"ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|"
    r"notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|nav|navbar|navigation|"
    r"menus?|breadcrumbs?|topbar|masthead|header|footer|sidebars?|aside|widgets?|related|recommended|"
    r"share|sharing|social|login|signup|search|pager|pagination|skip|" + READERS.pattern,
    re.IGNORECASE,
)
#: Words that don't change what a compound with a word of NOISE means.
PLACES = frozenset(
    "site page global main top bottom left right primary secondary box bar block container "
    "wrapper wrap area list link links item items button buttons inner outer section form "
    "message the and to".split()
)
WORD = re.compile(r"[a-z]+", re.IGNORECASE)
OPEN_TAG = re.compile(r"<[a-z/!?]", re.IGNORECASE)


#: Share of the threshold that a neighbour needs, and one of a single part. Parts of one
#: article differ by less, and lines such as a date or a copyright notice are below it.
NEIGHBOUR, SINGLE = 0.1, 0.4


def _marks_noise(mark: str) -> bool:
    """Whether a class or id is a word of NOISE, or a compound of such and of PLACES."""
    words = WORD.findall(mark)
    noise = [bool(NOISE.fullmatch(word)) for word in words]
    return any(noise) and all(
        x or word.lower() in PLACES for x, word in zip(noise, words, strict=True)
    )


class _Tree(HTMLParser):
    """Nodes of a page in document order, as parallel lists."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = ["html"]
        self.parents: list[int] = [-1]
        self.dropped: list[bool] = [False]
        self.doubted: dict[int, bool] = {}  # dropped unless it holds the article; is it comments?
        self.texts: list[list[tuple[int, str]]] = [[]]  # (number of children before, text)
        self.children: list[list[int]] = [[]]
        self.open: list[int] = [0]
        self.names: dict[str, int] = {}

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.names[self.tags[node]] -= 1
        del self.open[depth:]

    def _close_last(self, wanted: frozenset[str] | set[str], stops: frozenset[str]) -> None:
        """Close the innermost open element of `wanted`, unless a stop is nearer."""
        if not any(self.names.get(tag) for tag in wanted):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[depth]]
            if tag in wanted:
                self._close(depth)
                return
            if tag in stops:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body") and self.names.get(tag):
            return
        if tag in BLOCKS:
            self._close_last({"p"} | (HEADINGS if tag in HEADINGS else set()), CONTAINERS)
            if tag == "body":
                self._close(1)
            if tag == "li":
                self._close_last({"li"}, frozenset(("ul", "ol")))
            elif tag in ("dt", "dd"):
                self._close_last({"dt", "dd"}, frozenset(("dl",)))
            elif tag in ("td", "th"):
                self._close_last({"td", "th"}, frozenset(("tr", "table")))
            elif tag == "tr":
                self._close_last({"tr"}, frozenset(("table",)))
        parent = self.open[-1]
        node = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        named = dict(attrs)
        self.dropped.append(self.dropped[parent] or self._noise(tag, named))
        if not self.dropped[node]:
            self._doubt(node, tag, named)
        self.texts.append([])
        self.children.append([])
        self.children[parent].append(node)
        if tag not in VOID:
            self.open.append(node)
            self.names[tag] = self.names.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def _noise(self, tag: str, attrs: dict[str, str | None]) -> bool:
        if tag in DROPPED or tag == "header":
            return not (tag == "header" and self._in_article())
        return "hidden" in attrs or attrs.get("aria-hidden") == "true"

    def _doubt(self, node: int, tag: str, attrs: dict[str, str | None]) -> None:
        if tag in ("html", "body", "article", "main") or tag in HEADINGS:
            return
        marks = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
        noise = [mark for mark in marks if _marks_noise(mark)]
        if noise or tag == "form" or (attrs.get("role") or "").lower() in ROLES:
            readers = any(READERS.fullmatch(word) for mark in noise for word in WORD.findall(mark))
            self.doubted[node] = readers

    def _sizes(self, left_out: list[bool]) -> list[int]:
        """Characters below each node, without those of nodes left out."""
        chars = [0] * len(self.tags)
        for node in range(len(chars) - 1, -1, -1):
            if not left_out[node]:
                chars[node] += sum(len("".join(text.split())) for _, text in self.texts[node])
            if node:
                chars[self.parents[node]] += chars[node]
        return chars

    def _below(self, nodes) -> list[bool]:
        """Whether each node is one of `nodes` or below one."""
        out = [0 in nodes] + [False] * (len(self.tags) - 1)
        for node in range(1, len(out)):
            out[node] = out[self.parents[node]] or node in nodes
        return out

    def drop_doubted(self) -> None:
        """Drop the doubted elements that hold neither the article nor most of its text.

        The article is the largest article element of the largest main element, or of the
        page, characters of links and of readers' comments not counted; else the main
        element; else the page, where readers' comments count too.
        """
        if not self.doubted:
            return
        n = len(self.tags)
        linked = self._below({k for k in range(n) if self.tags[k] == "a"})
        readers = self._below({k for k, is_readers in self.doubted.items() if is_readers})
        chars = self._sizes([a or b for a, b in zip(linked, readers, strict=True)])
        scope, inside, keep = 0, [True] * n, set()
        for tag in ("main", "article"):
            found = [k for k in range(n) if self.tags[k] == tag and inside[k] and chars[k]]
            if found:
                scope = max(found, key=lambda k: (chars[k], -k))
                inside = self._below({scope})
                node = scope
                while node >= 0 and node not in keep:
                    keep.add(node)
                    node = self.parents[node]
        if not scope:
            chars = self._sizes(linked)
        keep.update(k for k in self.doubted if inside[k] and 2 * chars[k] > chars[scope])
        for node in range(1, n):
            if (node in self.doubted and node not in keep) or self.dropped[self.parents[node]]:
                self.dropped[node] = True
                self.texts[node] = []

    def _in_article(self) -> bool:
        return bool(self.names.get("article") or self.names.get("main"))

    def handle_endtag(self, tag: str) -> None:
        if not self.names.get(tag) or tag in ("html", "body"):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tags[self.open[depth]] == tag:
                self._close(depth)
                return

    def handle_data(self, data: str) -> None:
        node = self.open[-1]
        if not self.dropped[node]:
            self.texts[node].append((len(self.children[node]), data))


def _densities(tree: _Tree) -> tuple[list[float], list[float], list[int], list[int]]:
    """Per node: density, sum of the children's densities, characters, link characters."""
    n = len(tree.tags)
    chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
    for node in range(n - 1, -1, -1):
        own = sum(len("".join(text.split())) for _, text in tree.texts[node])
        chars[node] += own
        if tree.tags[node] == "a":
            link_chars[node] = chars[node]
        parent = tree.parents[node]
        if parent >= 0 and not tree.dropped[node]:
            chars[parent] += chars[node]
            tags[parent] += tags[node] + 1
            link_chars[parent] += link_chars[node]
            link_tags[parent] += link_tags[node] + (tree.tags[node] == "a")
    body_links = link_chars[0] / max(chars[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for node in range(n - 1, -1, -1):
        c, t, lc, lt = chars[node], tags[node] or 1, link_chars[node], link_tags[node]
        if c and not tree.dropped[node]:
            base = log(c * lc / max(c - lc, 1) + c * body_links + e)
            value = max((c / (lc or 1)) * (t / (lt or 1)), 1.0)
            density[node] = c / t * log(value) / max(log(base), 1.0)
            if tree.parents[node] >= 0:
                sums[tree.parents[node]] += density[node]
    return density, sums, chars, link_chars


def _article(
    tree: _Tree, density: list[float], sums: list[float], chars: list[int], link_chars: list[int]
) -> tuple[int, float, set[int]]:
    """Root of the main text, the threshold of the path that leads to it, and nodes below
    the root that are left out."""
    best = max(range(len(sums)), key=lambda node: (sums[node], -node))
    path = [best]
    while tree.parents[path[-1]] >= 0:
        path.append(tree.parents[path[-1]])
    below = [density[node] for node in path if tree.tags[node] not in ("html", "body")]
    threshold = min(below, default=0.0)
    for node in path:
        if tree.tags[node] in ("article", "main"):
            return node, threshold, set()

    def needed(node: int) -> float:
        """Density of a neighbour that belongs to the article.

        A node has fewer characters per tag than its parts, so one of a single part, as a
        notice is, needs more.
        """
        parts = sum(tree.tags[k] in BLOCKS and chars[k] > 0 for k in tree.children[node])
        return threshold * (NEIGHBOUR if parts > 1 else SINGLE)

    root = next(node for node in path if tree.tags[node] in CONTAINERS)
    out: set[int] = set()
    mixed = False  # some neighbour on the way is below the threshold
    while tree.parents[root] >= 0:
        parent = tree.parents[root]
        others = [k for k in tree.children[parent] if k != root and density[k] > 0]
        mixed |= any(density[k] < threshold and tree.tags[k] in CONTAINERS for k in others)
        if mixed:
            out.update(
                k
                for k in others
                if tree.tags[k] not in HEADINGS
                and (
                    2 * link_chars[k] > chars[k]
                    or (tree.tags[k] in CONTAINERS | LISTS and density[k] < needed(k))
                )
            )
        root = parent
    return root, threshold, out


def main_text(html: str | None) -> str:
    """The blocks of the main text, one line each."""
    if not html:
        return ""
    tree = _Tree()
    # no tag ends behind the last ">", and the parser would look for its end again and again
    end = html.rfind(">") + 1
    tree.feed(html[:end])
    if tree.rawdata.startswith("<!--"):  # a comment that never ends
        tree.rawdata = ""
    elif not tree.cdata_elem:
        tree.feed(OPEN_TAG.split(html[end:], maxsplit=1)[0])
    tree.close()
    tree.drop_doubted()
    density, sums, chars, link_chars = _densities(tree)
    if not chars[0]:
        return ""
    root, threshold, out = _article(tree, density, sums, chars, link_chars)
    lines: list[str] = []
    block: list[str] = []

    def end_block() -> None:
        line = " ".join("".join(block).split())
        if line:
            lines.append(line)
        block.clear()

    # (node, next child, next text, only headings) of the open nodes
    stack = [[root, 0, 0, False]]
    while stack:
        node, child, text, headings = top = stack[-1]
        texts, children = tree.texts[node], tree.children[node]
        if text < len(texts) and texts[text][0] <= child:
            if not headings:
                block.append(texts[text][1])
            top[2] += 1
        elif child < len(children):
            top[1] += 1
            below = children[child]
            tag = tree.tags[below]
            linked = (
                tag in LISTS and density[below] < threshold and 2 * link_chars[below] > chars[below]
            )
            if tag in ("br", "hr"):
                block.append(" ")
            if tree.dropped[below] or linked or below in out:
                continue
            if tag in BLOCKS:
                end_block()
            within = (headings or tag == "header") and tag not in HEADINGS
            stack.append([below, 0, 0, within])
        else:
            stack.pop()
            if tree.tags[node] in BLOCKS:
                end_block()
    end_block()
    return "\n".join(lines)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of `pages` (page_id, url, html)."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
