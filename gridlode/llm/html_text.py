"""Main text of web pages by text-to-tag ratio.

A streaming parser turns a page into lines, one for each block of text, each
with the tags seen since the line before. A line's text-to-tag ratio, 0 inside
barred elements and FAVOUR times as much inside article and main, is smoothed by a
Gaussian over its neighbours; free lines at or over the standard deviation of
the smoothed ratios that aren't mostly links are content. Content lines select regions, and a region is
kept whole, however short some of its lines are: the nearest container of more
than one line around a content line, whatever its share of the page. Of a page
with article or main elements, all of those are selected too. A container with
two selected parts is selected itself. Where a line's container is the page's
body, the region is the stretch from the first to the last such content line,
with the headings and paragraphs that adjoin it. A region outside article and main
grows within the containers around it, the page excepted: over the lines that adjoin
it, up to a barred line or one that is mostly links.

Barred are lines inside menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments, told by element or by whole names in
class, id or role: a name of the list, one that ends in such a name behind a
hyphen, or begins with it and goes on with a word for a box.

Defined cases: null, empty or text-free html gives the empty text; unclosed
elements end with their parents, a head at the first tag or text that can't
be in one; stray end tags are passed over; a `<![` of no known section is a
comment up to the next `>`; a menu, form, header, footer, sidebar or the like that is
never closed bars its headings and paragraphs no more; a line exactly at the threshold is content; without
content lines all free lines are kept; repeated rows give a row each; an empty
table gives no rows; a very long page is one string in a Python worker, with its
lines, in time that grows with its length; other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlode.llm.common import small_batches

SIGMA, RADIUS = 1.0, 2
FAVOUR = 2.0
MOST_LINKED = 0.5

# Elements by their part in a page, and names that classes, ids and roles are made of.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
IN_HEAD = frozenset("html head title base basefont link meta style script noscript template bgsound".split())
BARRED = frozenset("nav footer aside form script style noscript template head title button select textarea svg iframe object canvas dialog menu".split())
OPEN_ENDED = frozenset("nav footer aside form menu".split())
ROOTS = frozenset(("article", "main"))
CONTAINERS = frozenset("article main section div td center details figure".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
BARRED_NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe signup sidebar sidebars aside widget widgets related recommended recommendations share sharing social comment comments "
    "commentlist disqus replies respond menu menus nav navbar navigation breadcrumb breadcrumbs footer pagination pager toolbar login search complementary contentinfo".split()
)
HEADER_NAMES = frozenset(("header", "masthead", "topbar"))
BOX_NAMES = frozenset(
    "area bar block body bottom box col column container content footer form group header holder inner item items left link links list main outer panel right row "
    "section slot text top unit widget wrap wrapper".split()
)
STATE_NAMES = frozenset("no non not has have with without is js hide show".split())
_SPACE = re.compile(r"\s+")
_NUMBER = re.compile(r"[0-9]*\Z")
_SECTION = re.compile(r"<!\[(?:temp|cdata|ignore|include|rcdata)(?![-_.a-z0-9])", re.IGNORECASE)


def named(value: str, names: frozenset[str], whole: bool = False) -> bool:
    """Whether one of the names in a class, id or role is of the list, as it is or (unless `whole`) with parts that say where or what box."""
    for name in value.lower().replace("_", "-").split():
        if name in names:
            return True
        parts = [_NUMBER.sub("", x) for x in name.split("-")]
        parts = [x for x in parts if x]
        if whole or not parts or parts[0] in STATE_NAMES:
            continue
        if parts[-1] in names or parts[0] in names and all(x in BOX_NAMES or x in names for x in parts[1:]):
            return True
    return False


class Line(NamedTuple):
    text: str
    tags: int
    barred: bool
    paragraph: bool
    container: int
    linked: int = 0  # characters in links, as they stand


class _Lines(HTMLParser):
    """Collects the lines and the containers, each with its parent (0: the page) and whether it is an article or main."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents, self.roots = [0], [False]
        self.stack: list[tuple[str, bool, int, int]] = []  # element, barred and container before it, and the lines before it
        self.parts: list[str] = []
        self.tags = self.container = self.links = self.linked = 0
        self.barred = self.paragraph = False

    def flush(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append(Line(text, self.tags, self.barred, self.paragraph, self.container, self.linked))
                self.tags = 0
            self.parts, self.linked = [], 0

    def _in_root(self) -> bool:
        return any(s[0] in ROOTS for s in self.stack)

    def _bars(self, tag: str, attrs: list) -> bool:
        if tag in BARRED or tag == "header" and not self._in_root():
            return True
        for name, value in attrs:
            if value and name in ("class", "id", "role") and tag not in ("html", "body"):
                if named(value, BARRED_NAMES, tag in ROOTS) or tag not in ROOTS and named(value, HEADER_NAMES) and not self._in_root():
                    return True
        return False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag not in IN_HEAD and self.stack and any(s[0] == "head" for s in self.stack[-2:]):
            self._close("head")
        if tag in INLINE:
            self.links += tag == "a"
            if tag == "br":
                self.parts.append(" ")
            elif attrs and tag not in VOID and not self.barred and self._bars(tag, attrs):
                self.flush()
                self._open(tag, True)
            return
        self.flush()
        if tag in CLOSES_P and self.stack and any(s[0] == "p" for s in self.stack[-4:]):
            self._close("p")
        if tag == "li" and self.stack and self.stack[-1][0] == "li":
            self._close("li")
        if tag in VOID:
            return
        first = tag in ROOTS and not self._in_root() and not any(s[0] in BARRED for s in self.stack)
        self._open(tag, self._bars(tag, attrs) or self.barred and not first)
        if tag in CONTAINERS:
            self.parents.append(self.container)
            self.roots.append(tag in ROOTS)
            self.container = len(self.parents) - 1
        self.paragraph = tag in PARAGRAPHS

    def _open(self, tag: str, barred: bool) -> None:
        self.stack.append((tag, self.barred, self.container, len(self.lines)))
        self.barred = barred

    def _close(self, tag: str) -> None:
        for n in range(len(self.stack) - 1, -1, -1):
            if self.stack[n][0] == tag:
                self.flush()
                self._free(n + 1)
                _, self.barred, self.container, _ = self.stack[n]
                del self.stack[n:]
                self.paragraph = False
                return

    def _free(self, first: int) -> None:
        """Of the open elements from `first` on, which get no end tag, the first that bars its lines bars paragraphs no more."""
        for n in range(first, len(self.stack)):
            tag, before, _, since = self.stack[n]
            now = self.stack[n + 1][1] if n + 1 < len(self.stack) else self.barred
            if now and not before and (tag not in BARRED or tag in OPEN_ENDED):
                self.lines[since:] = [x._replace(barred=x.barred and not x.paragraph) for x in self.lines[since:]]
                return

    def close(self) -> None:
        super().close()
        self.flush()
        self._free(0)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        self.links -= tag == "a" and self.links > 0
        if tag not in INLINE:
            self.flush()
            self._close(tag)
        elif self.stack and self.stack[-1][0] == tag:
            self._close(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Any other name, or none, makes a comment up to the next `>`; the parser would stop at it."""
        return super().parse_marked_section(i, report) if _SECTION.match(self.rawdata, i) else self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._close("head")
        self.parts.append(data)
        self.linked += len(data.strip()) if self.links else 0


def _smoothed(ratios: np.ndarray) -> np.ndarray:
    near = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    padded = np.pad(ratios, RADIUS, mode="edge")
    return np.convolve(padded, near / near.sum(), mode="valid")


def content_lines(lines: list[Line], inside: list[bool]) -> np.ndarray:
    """Which lines the smoothed text-to-tag ratios make content. inside: of each container, whether it is in an article or main."""
    ratios = np.array([0.0 if x.barred else len(x.text) / max(1, x.tags) * (FAVOUR if inside[x.container] else 1.0) for x in lines])
    smooth = _smoothed(ratios)
    return (smooth >= smooth.std()) & ~np.array([x.barred or _links(x) for x in lines])


def _links(line: Line) -> bool:
    """Whether a line is mostly links: such a line selects no region, but stays in one."""
    return line.linked > MOST_LINKED * len(line.text)


def regions(lines: list[Line], parents: list[int], roots: list[bool]) -> list[int]:
    """Numbers of the lines of the selected regions."""
    inside, outermost = list(roots), list(range(len(parents)))  # parents come before their children
    for c in range(1, len(parents)):
        if inside[parents[c]]:
            inside[c], outermost[c] = True, outermost[parents[c]]
    content = content_lines(lines, inside)
    free = [n for n, x in enumerate(lines) if not x.barred]
    if not content.any():
        return free
    count = [0] * len(parents)
    for n in free:
        count[lines[n].container] += 1
    for c in range(len(parents) - 1, 0, -1):
        count[parents[c]] += count[c]
    region = list(range(len(parents)))  # of each container, the region that its lines stand for
    for c in range(1, len(parents)):
        region[c] = outermost[c] if inside[c] else c if count[c] > 1 else region[parents[c]]
    picked = {region[lines[n].container] for n in np.flatnonzero(content).tolist()} | {c for c in range(1, len(parents)) if outermost[c] == c and inside[c]}
    selected = [c in picked for c in range(len(parents))]
    parts: dict[int, int] = {}
    for c in range(len(parents) - 1, 0, -1):  # children come first
        if not selected[c] and parts.get(c, 0) > 1:
            selected[c] = True
        if selected[c] or parts.get(c):
            parts[parents[c]] = parts.get(parents[c], 0) + 1
    whole = [False] * len(parents)
    for c in range(1, len(parents)):
        whole[c] = selected[c] or whole[parents[c]]
    out = {n for n in free if whole[lines[n].container]}
    out |= _adjoining(lines, parents, [n for n in out if not inside[lines[n].container]])
    if selected[0]:
        own = [n for n in free if region[lines[n].container] == 0]
        hits = [k for k, n in enumerate(own) if content[n]]
        first, last = hits[0], hits[-1]
        while first and lines[own[first - 1]].paragraph and own[first - 1] == own[first] - 1:
            first -= 1
        while last + 1 < len(own) and lines[own[last + 1]].paragraph and own[last + 1] == own[last] + 1:
            last += 1
        out.update(own[first : last + 1])
    return sorted(out)


def _adjoining(lines: list[Line], parents: list[int], region: list[int]) -> set[int]:
    """The lines next to those of a region that lie in a container with it, up to a barred one or one that is mostly links."""
    found, inner = set(), set(region)
    for step in (-1, 1):
        for n in region:
            if n + step in inner:
                continue
            around, c = set(), parents[lines[n].container] if lines[n].container else 0
            while c:
                around.add(c)
                c = parents[c]
            k = n + step
            while 0 <= k < len(lines) and k not in inner and not lines[k].barred and not _links(lines[k]):
                c = lines[k].container
                while c and c not in around:
                    c = parents[c]
                if not c:
                    break
                found.add(k)
                k += step
    return found


def main_text(html: str | None) -> str:
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    if not parser.lines:
        return ""
    return "\n\n".join(parser.lines[n].text for n in regions(parser.lines, parser.parents, parser.roots))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
