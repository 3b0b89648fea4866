"""Main text of web pages by line-block distribution.

1. Markup is stripped: every block element starts a line; white space inside a line becomes one space; character
references are decoded. Lines inside containers that are no article by their element, role, id or class (menus,
headers, footers, sidebars, notices, adverts, forms, comments) carry no text weight, nor do lines made of links.
Scripts and styles give no line. A form that holds the page's parts is none of these containers. Classes and ids count by
their whole names. An article or main element inside a container that is shut by its name alone is read where it outweighs
the other text and the page has no article elsewhere; without any text, forms are read if they have a surge.
2. The line-block value of a line is the summed weight of ``WINDOW`` lines from it on; lines of those containers are left
out before. Where it rises to ``SURGE`` characters, main text begins; where it falls to zero, the text dives and the segment
ends. A page that marks an article or main element is judged inside it alone, where any text is a surge, so short
paragraphs stay.
3. Segments are extended to the next lines with weight on both sides as long as these stand in the same container.
4. All lines of a segment are kept, in page order, but for lists made of links and, where a segment was extended, lines made
of links in other containers.

Pages are read row by row in Spark tasks, nothing is shuffled and nothing of a page is cut off.

Defined results: null, empty and text-free pages have the empty text. Truncated pages are read to their end: an
unclosed script or comment reaches to the end of the page, an unclosed container to the end of its parent, an unclosed list of
choices to the last choice, and any other hidden element hides nothing.
Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 3
SURGE = 80
#: A line outside an article with more than this share of its characters in links carries no weight of its own.
LINK_SHARE = 0.5

# Elements by their part in a page.
_HIDDEN = frozenset(
    "script style noscript template textarea select datalist option title iframe object svg annotation annotation-xml canvas audio video head".split()
)
#: Of these, those that reach to the end of the page if they are not closed; the others then hide their own tag alone.
_TO_THE_END = frozenset("script style noscript template textarea title".split())
_CHOICES = frozenset("select datalist option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_ARTICLE = frozenset("nav footer aside form menu dialog button fieldset search".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notification alert sidebar aside comment comments commentlist disqus reply replies respond share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login breadcrumb breadcrumbs menu nav navbar navigation footer masthead "
    "popup modal overlay widget toolbar pagination pager skip".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: With these a name still means nothing else; any other word (with-sidebar, no-comments, related-work) makes it another name.
_NAME_FILLERS = frozenset(
    "a area article articles aside bar block bottom box button buttons c container entry fixed form global group header icons info inner item "
    "items js l label left link links list m main media message o outer page panel placeholder policy popup post posts primary right secondary "
    "section site slot story stories this thread top unit user wrap wrapper x".split()
)
#: What a form holds that stands around a whole page.
_PAGE_PARTS = re.compile(r"<(?:article|main|nav|header|footer|aside)\b|\b__VIEWSTATE\b", re.I)
#: Elements whose children stand together, and lists.
_GROUPING = frozenset("html body div section center header hgroup td th form details dialog figure article main nav aside footer".split())
_LISTS = frozenset("ul ol dl menu".split())
#: Marks of lines: read; in an article inside a container shut by name; in a form; in a container shut by name; never read.
_READ, _REGAINED, _FORM, _NAMED, _SHUT = range(5)
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-hidden|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_MORE_CHOICES = re.compile(r"[^<]*+(?:</?(?:option|optgroup)\b[^>]*>[^<]*+)*", re.I)
_NO_CHOICE = re.compile(r"<(?!/?(?:option|optgroup)\b)", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _mark(name: str, rest: str, in_article: bool) -> int:
    """Whether an element is no article by what it is called."""
    mark = _FORM if name == "form" else _SHUT if name in _NO_ARTICLE or (name == "header" and not in_article) else _READ
    for attribute, *values in _ATTRIBUTE.findall(rest):
        value = html.unescape("".join(values))
        if attribute.lower() == "role" and value.strip().lower() in _ROLES:
            return _SHUT
        if attribute.lower() in ("class", "id") and name not in ("html", "body", "article", "main"):
            for whole in value.split():
                parts = {part.lower() for part in _NAME_PARTS.findall(whole)}
                if parts & _NAMES and parts <= _NAMES | _NAME_FILLERS:
                    mark = max(mark, _SHUT if parts & _COMMENTS else _NAMED)
    return mark


class _Open(NamedTuple):
    """An open element: its mark, whether an article holds it, the innermost container and the one around that, the list."""

    name: str
    mark: int = _READ
    article: bool = False
    place: int = 0
    around: int = -1
    list: int | None = None


class _Line(NamedTuple):
    text: str
    weight: int
    inside: _Open

    @property
    def places(self) -> set[int]:
        """Containers that the line stands in; one whose own text it is stands beside others."""
        return {self.inside.place, self.inside.around} if self.inside.name in _GROUPING else {self.inside.place}


class _Lines:
    """The lines of one page, without weight if made of links, and the elements that hold them."""

    def __init__(self, page: str) -> None:
        self.lines: list[_Line] = []
        self.open: list[_Open] = []
        self.names: Counter[str] = Counter()  # of the open elements
        self.unclosed: set[str] = set()
        self.opened = 0
        self.parts: list[str] = []
        self.linked = self.link_depth = 0
        at = 0
        while at < len(page):
            found = _TOKEN.search(page, at)
            self.text(page[at : found.start() if found else len(page)])
            if not found:
                break
            at = found.end()
            if name := (found["name"] or "").lower():
                if name in _HIDDEN and not found["end"]:
                    if name == "head":
                        at = self.after_head(page, at)
                    elif not found["rest"].endswith("/"):
                        at = self.after(page, name, at)
                elif found["end"]:
                    self.close(name)
                else:
                    self.start(name, found["rest"], name == "form" and self.around_page(page, at))
        self.flush()

    def after(self, page: str, name: str, at: int) -> int:
        """Where a hidden element ends. Lists of choices may leave out end tags: they go on as long as choices follow."""
        if name not in self.unclosed:
            if found := re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at):
                if name != "option" or not _NO_CHOICE.search(page, at, found.start()):
                    return found.end()
            else:
                self.unclosed.add(name)
        if name in _CHOICES:
            return _MORE_CHOICES.match(page, at).end()
        return len(page) if name in _TO_THE_END else at

    @staticmethod
    def around_page(page: str, at: int) -> bool:
        end = re.compile(r"</?form\b", re.I).search(page, at)  # forms do not nest
        return bool(_PAGE_PARTS.search(page, at, end.start() if end else len(page)))

    @staticmethod
    def after_head(page: str, at: int) -> int:
        """The head ends where it says so; without an end it is read as if it were not there."""
        found = re.compile(r"</head\b[^>]*>?|<body\b", re.I).search(page, at)
        return found.start() if found else at

    @property
    def state(self) -> _Open:
        return self.open[-1] if self.open else _Open("")

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.link_depth:
                self.linked += len(raw)

    def flush(self) -> None:
        raw = "".join(self.parts)
        if raw and (text := " ".join(html.unescape(raw).split())):
            of_links = not self.state.article and self.linked > LINK_SHARE * len(raw)
            self.lines.append(_Line(text, 0 if of_links else len(text), self.state))
        self.parts, self.linked = [], 0

    def start(self, name: str, rest: str, around_page: bool = False) -> None:
        article = self.state.article
        is_article = name in ("article", "main") or 'role="main"' in rest
        shut = _READ if around_page else _mark(name, rest, article)
        if name == "br":
            self.parts.append(" ")
        if name == "a":
            self.link_depth = 1
        if name in _VOID and name != "hr":
            return
        if name in _BLOCK or shut:
            self.flush()
            if name in ("p", "li", "dd", "dt", "td", "th", "tr") and self.open and self.open[-1].name == name:
                self.names[self.open.pop().name] -= 1  # its end tag is optional
            _, mark, article, place, around, of_list = self.state
            self.opened += 1
            if name in _GROUPING:
                place, around = self.opened, place
            if is_article and mark in (_FORM, _NAMED):
                mark = _REGAINED
            if name != "hr" and not rest.endswith("/"):
                of_list = self.opened if name in _LISTS else None if name in _GROUPING else of_list
                self.open.append(_Open(name, max(mark, shut), article or is_article, place, around, of_list))
                self.names[name] += 1

    def close(self, name: str) -> None:
        if name == "a":
            self.link_depth = 0
        if name in _BLOCK or self.names[name]:
            self.flush()
        if self.names[name]:
            gone = None
            while gone != name:
                gone = self.open.pop().name
                self.names[gone] -= 1


def line_blocks(weights: list[int], window: int = WINDOW) -> list[int]:
    """The summed weight of ``window`` lines from each line on."""
    sums = [0]
    for w in weights:
        sums.append(sums[-1] + w)
    last = len(weights)
    return [sums[min(n + window, last)] - sums[n] for n in range(last)]


def segments(weights: list[int], surge: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(first line, line after the last) between each surge and its dive."""
    blocks, found, begun = line_blocks(weights, window), [], None
    for n, block in enumerate(blocks):
        if begun is None and block >= surge and weights[n]:
            begun = n
        elif begun is not None and not block:
            found.append((begun, n))
            begun = None
    return found if begun is None else [*found, (begun, len(blocks))]


def _kept(lines: list[_Line], weights: list[int], surge: int = SURGE) -> list[int]:
    """The lines of the segments, extended to what stands in the same container."""
    listed: dict[int, int] = {}  # weight of each list
    for line, weight in zip(lines, weights, strict=True):
        if line.inside.list is not None:
            listed[line.inside.list] = listed.get(line.inside.list, 0) + weight
    of_text = lambda n: weights[n] or lines[n].inside.list is None or listed[lines[n].inside.list]
    heavy = [n for n, weight in enumerate(weights) if weight]
    own = [[n for n in range(a, b) if weights[n]] for a, b in segments(weights, surge)]
    surged = {n for some in own for n in some}
    kept = {n for some in own for n in range(some[0], some[-1] + 1) if of_text(n)}
    for some in own:
        for end, step in ((some[0], -1), (some[-1], 1)):
            at = bisect_left(heavy, end) + step
            while 0 <= at < len(heavy) and (near := lines[end].places & lines[heavy[at]].places):
                between = range(min(end, heavy[at]), max(end, heavy[at]) + 1)
                kept.update(n for n in between if of_text(n) and lines[n].places & near)
                if heavy[at] in surged:
                    break
                end, at = heavy[at], at + step
    return sorted(kept)


def main_text(page: str | None) -> str:
    """The lines of main text of one page, one per line."""
    lines = _Lines(page or "").lines
    of = lambda mark: [line for line in lines if line.inside.mark == mark]
    weight = lambda some: sum(line.weight for line in some)
    read, regained = of(_READ), [line for line in of(_REGAINED) if line.inside.article]
    article = [line for line in read if line.inside.article]
    if weight(article) or weight(regained) > weight(read):
        inside = article if weight(article) else regained
        return "\n".join(inside[n].text for n in _kept(inside, [line.weight for line in inside], surge=1))
    if not weight(read):
        read = of(_FORM)
        return "\n".join(read[n].text for n in _kept(read, [line.weight for line in read]))
    weights = [line.weight for line in read]
    kept = _kept(read, weights) or [n for n, w in enumerate(weights) if w]  # a page with little text all over has no surge
    return "\n".join(read[n].text for n in kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` as a struct ``row``, with ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    others = [F.col(f"`{c}`") for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*others).alias("row"), F.col(html_col).alias("page"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")
