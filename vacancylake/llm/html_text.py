"""Main text of pages by line-block distribution.

Markup is stripped so that every block element is one line; lines of elements
that are never article text (menus, footers, adverts, forms, comments) are left
out before anything is summed. Text lengths are summed over a sliding window of
lines. The text lies between a surge, where the sums rise over a threshold that
the page's own sums lower, and the dive, where next to nothing follows. Stretches
are one text if less lies between them than in either; the one with most text
wins. Where a page marks its articles, marked lines weigh :data:`MARKED` times
as much: unless the rest of the page outweighs them, lines outside the marks have
no length, and a stretch reaches to both ends of every mark it touches. Without
marks, a stretch loses lines of links alone at its ends, what stands before its
first heading, if that is near, and the copyright line.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vacancylake.llm.shared import map_batches, prepare

WINDOW = 3
#: Characters in a window that make a surge; at most half the page's fullest window.
SURGE = 80
#: Lines that end a stretch if together they hold less than a quarter of a surge.
DIVE = 3
#: Weight of a character inside an article mark against one outside.
MARKED = 4
#: Share of a line's characters from which on it counts as links alone.
LINKS = 0.9

#: Elements by what they mean for the text. Fixed values.
DROPPED = frozenset("script style noscript template head title nav footer aside form select button textarea iframe svg "
                    "object canvas audio video dialog menu".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                   "tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY_SIBLING = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
                     "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: Parts of class names and ids that tell of something beside the article.
BAD_NAMES = frozenset("ad ads adv advert adverts advertisement advertisements banner banners sponsor sponsored promo promotion "
                      "sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead cookie "
                      "cookies consent gdpr notice notices alert popup modal newsletter subscribe signup comment comments "
                      "disqus reply replies respond share sharing social related recommended widget widgets toolbar pager "
                      "pagination login search skip discussion discussions".split())
#: Parts that tell nothing: a name is bad if it has a bad part and all others are of these.
PLAIN_NAMES = frozenset("area article articles bar block bottom box button buttons column container content form global group "
                        "inline inner item items icons left link links list main media outer overlay page panel post posts "
                        "primary reader readers region right row secondary section site slot stories sticky text thread top "
                        "unit user wrap wrapper js id new".split())
#: Parts that also name parts of an article, where they stand inside its mark.
OWN_NAMES = frozenset("header footer notice notices alert discussion discussions".split())
COMMENTS = frozenset("comment comments disqus reply replies respond discussion discussions".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"\s(?:hidden\b(?!\s*=)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RIGHTS = re.compile(r"(?:\u00a9|\(c\)|copyright\b|all rights reserved)", re.I)


class Line(NamedTuple):
    text: str
    dropped: bool
    mark: int  # number of the outermost article mark it lies in, or 0
    links: bool  # holds next to nothing but link texts
    heading: bool


def _bad_name(name: str, inside: bool) -> str | None:
    """The part of one class name or id by which its element is not article text."""
    parts = [p.lower() for p in _WORD.findall(name)]
    bad = [p for p in parts if p in BAD_NAMES and not (inside and p in OWN_NAMES)]
    return bad[0] if bad and all(p in BAD_NAMES or p in PLAIN_NAMES for p in parts) else None


def _judge(tag: str, attributes: str, inside: bool) -> tuple[bool, str | None, bool]:
    """(is not article text, bad part of its names, marks the article) of an element."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True, None, False
    mark, named = tag in ("article", "main"), None
    for m in _NAMES.finditer(attributes):
        kind, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if kind in ("class", "id"):
            if not mark and tag not in HEADINGS and tag not in ("html", "body"):
                named = named or next(filter(None, (_bad_name(name, inside) for name in value.split())), None)
            continue
        value = value.lower()
        if kind == "role" and value in BAD_ROLES:
            return True, None, False
        mark |= (kind == "role" and value == "main") or (kind == "itemprop" and value == "articlebody")
    return bool(attributes and _HIDDEN.search(attributes)), named, mark


class _Open(NamedTuple):
    tag: str
    outer: tuple[bool, int, int, bool]  # state around the element: dropped, mark, named element, heading
    breaks: bool  # begins and ends a line
    held: tuple[list[str], int] | None  # the line around a dropped inline element


class _Lines:
    """The lines of a page while its tags go by."""

    def __init__(self) -> None:
        self.found: list[tuple[Line, int]] = []  # with the innermost element of a bad name, or 0
        self.named: list[tuple[int, str]] = [(0, "")]  # (element of a bad name around it, bad part)
        self.stack: list[_Open] = []
        self.state = (False, 0, 0, False)
        self.parts: list[str] = []
        self.linked = self.marks = 0
        self.link = False

    def add(self, text: str) -> None:
        self.parts.append(text)
        if self.link:
            self.linked += len(text.strip())

    def flush(self) -> None:
        words = markup.unescape("".join(self.parts)).split()
        if words:
            dropped, mark, name, heading = self.state
            links = self.linked >= LINKS * sum(map(len, words))
            self.found.append((Line(" ".join(words), dropped, mark, links, heading), name))
        self.parts, self.linked = [], 0

    def open(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            while self.stack and tag in CLOSED_BY_SIBLING.get(self.stack[-1].tag, ()):
                self.close(len(self.stack) - 1)
        if tag in VOID:
            return
        outer = dropped, inside, name, heading = self.state
        bad, part, mark = _judge(tag, attributes, bool(inside))
        mark = mark and not bad and not inside
        if mark or part is not None:
            self.flush()
        held = None
        if bad and not block and not dropped:
            held = self.parts, self.linked
            self.parts, self.linked = [], 0
        self.marks += mark
        if part is not None:
            self.named.append((name, part))
            name = len(self.named) - 1
        self.state = dropped or bad, self.marks if mark else inside, name, heading or tag in HEADINGS
        self.stack.append(_Open(tag, outer, block or mark or part is not None, held))

    def close(self, depth: int) -> None:
        """Close the open elements from ``depth`` on, innermost first."""
        while len(self.stack) > depth:
            element = self.stack.pop()
            if element.breaks or element.held:
                self.flush()
            self.state = element.outer
            if element.held:
                self.parts, self.linked = element.held
                self.parts.append(" ")

    def lines(self) -> list[Line]:
        """The lines, those in elements of bad names dropped.

        If without them no window of the page makes a surge, the outermost one
        that holds most of the page is the article, unless it holds comments.
        """
        if len(self.named) == 1:
            return [line for line, _ in self.found]
        held = [0] * len(self.named)
        for line, name in self.found:
            if not line.dropped:
                held[name] += len(line.text)
        for name in range(len(held) - 1, 0, -1):  # an element's number is greater than that of one around it
            held[self.named[name][0]] += held[name]
        free = np.array([0 if line.dropped or name else len(line.text) for line, name in self.found], np.int64)
        bare = not len(free) or np.convolve(free, np.ones(WINDOW, int)).max() < SURGE
        dropped = [False] * len(held)
        for name, (around, part) in enumerate(self.named[1:], 1):
            whole = bare and part not in COMMENTS and 2 * held[name] > held[0] and held[name] > 5 * SURGE
            dropped[name] = dropped[around] or not whole
        return [line._replace(dropped=line.dropped or dropped[name]) for line, name in self.found]


def lines_of(page: str) -> list[Line]:
    """Lines of a page in order."""
    lines = _Lines()
    at = 0
    for m in _TAG.finditer(page):
        lines.add(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[1] is not None:
                lines.add(" ")
            continue
        tag = m[3].lower()
        if tag == "br":
            lines.add(" ")
        elif tag == "a":
            lines.link = not m[2]
        elif tag not in BLOCKS and tag not in DROPPED and tag != "span":
            continue
        elif m[2]:
            depth = next((k for k in range(len(lines.stack) - 1, -1, -1) if lines.stack[k].tag == tag), None)
            if depth is not None:
                lines.close(depth)
            elif tag in BLOCKS:
                lines.flush()
        else:
            lines.open(tag, m[4])
    lines.add(page[at:])
    lines.flush()
    lines.close(0)
    lines.flush()
    return lines.lines()


def _trimmed(lines: list[Line], begin: int, end: int) -> tuple[int, int]:
    """A stretch of a page without marks, less what is not the article at its ends."""
    first, last = begin, end
    while first < last and lines[first].links:
        first += 1
    while first < last and (lines[last - 1].links or len(lines[last - 1].text) < 2 * SURGE and _RIGHTS.match(lines[last - 1].text)):
        last -= 1
    if first == last:
        return begin, end
    title = next((k for k in range(first, min(first + WINDOW, last)) if lines[k].heading), first)
    return (title if all(len(line.text) < SURGE / 2 for line in lines[first:title]) else first), last


def main_lines(lines: list[Line]) -> list[str]:
    """The lines between the surge and the dive that hold most text."""
    lines = [line for line in lines if not line.dropped]
    size = np.array([len(line.text) for line in lines], np.int64)
    mark = np.array([line.mark for line in lines], np.int64)
    marked = bool(mark.any()) and MARKED * size[mark > 0].sum() >= size[mark == 0].sum()
    if marked:
        size[mark == 0] = 0
    if not size.any():
        return []
    total = np.convolve(size, np.ones(WINDOW, int))[WINDOW - 1 :]  # of each line and those after it
    after = np.convolve(size, np.ones(DIVE, int))[DIVE:]  # of the lines after each
    surge = min(SURGE, int(total.max()) / 2)
    edges: dict[int, tuple[int, int]] = {}
    if marked:
        for k, line in enumerate(lines):
            if line.mark:
                edges[line.mark] = edges.get(line.mark, (k, k))[0], k + 1
    stretches, at = [], 0
    while at < len(size):
        if total[at] < surge or not size[at]:
            at += 1
            continue
        begin, end = edges.get(lines[at].mark, (at, at + 1))
        while end < len(size) and (4 * after[end - 1] >= surge or end + DIVE > len(size)):
            end = edges.get(lines[end].mark, (end, end + 1))[1]
        stretches.append((begin, end))
        at = end
    held = np.concatenate([[0], np.cumsum(size)])
    joined = stretches[:1]
    for begin, end in stretches[1:]:
        first, last = joined[-1]
        if held[begin] - held[last] < min(held[last] - held[first], held[end] - held[begin]):
            joined[-1] = first, end
        else:
            joined.append((begin, end))
    begin, end = max(joined, key=lambda s: (held[s[1]] - held[s[0]], -s[0]))
    if not marked:
        begin, end = _trimmed(lines, begin, end)
    return [lines[k].text for k in range(begin, end) if size[k]]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; text is empty if there is none.

    Null and empty pages, and pages of markup alone, give an empty text. Repeated
    rows, equal and null ids are extracted each; very long pages are read whole;
    further columns are not read.
    """
    prepare(pages.sparkSession)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = ["\n\n".join(main_lines(lines_of(p))) if p else "" for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id bigint, url string, text string, n_chars bigint")
