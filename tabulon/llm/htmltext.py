"""Main text of web pages by the distribution of text over blocks ("lines").

Markup is stripped into lines of text, one a block.  What a page says is no article (menus, headers,
footers, sidebars, notices, adverts, forms, reader comments, by tag, role, class or id) is stripped with it.
Of the rest, on every page, the line blocks decide: text lengths without link text are summed over
sliding windows of lines; the main text begins at a surge, where the sum rises over the threshold,
and ends at the dive behind it, where it falls below.

The threshold is a share of the window in which the middle character of the page stands, and a line counts
with ``LONG`` characters at most, so neither many short lines nor one very long block moves it far.  A window
never reaches over the edge of an article or main element.  Where most text of such an element, or of a
div, section or table cell, lies between surges and dives, these move to its edges.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import slices, table, text_or_empty

WINDOW = 3
#: A window is dense from this share of the middle character's window on.
DENSE = 0.25
#: Characters that a line counts with at most, and with which a line can begin a surge whatever the threshold.
LONG, BEGINS = 320, 25
#: Share of a container's text between surges and dives from which these move to its edges.
MOSTLY = 0.5

# fixed values: names of HTML
_RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "template", "xmp", "noembed", "noframes")
_STRIPPED_TAGS = frozenset("nav header footer aside form menu button select dialog svg canvas object audio video fieldset head".split())
_STRIPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
_BLOCKS = frozenset(
    "address article blockquote body br caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul aside dialog title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: End tags that authors leave out; such an element also ends where a sibling begins.
_LOOSE = frozenset("p li dt dd tr td th option".split())
#: Class and id words of what is no article.
_STRIPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar notice notices cookie cookies consent popup modal newsletter subscribe share sharing pagination toolbar "
    "hidden".split())
_REPLY_WORDS = frozenset("comment comments commentlist disqus reply replies respond".split())

_MARK = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: A tag's rest up to its end, quoted values whole; it never steps back, so it reads each character once.
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_WHOLE = ("article", "main")
_CONTAINERS = frozenset("div section td".split())


@dataclass
class Line:
    """A block's text; its length without link text; the article (or main) and the container it stands in, 0 for none."""

    text: str
    size: int
    article: int
    container: int
    heading: bool


def _stripped(tag: str, attributes: str) -> str:
    """'replies', 'hidden' or 'stripped' for an element that is no article, else ''."""
    why = "stripped" if tag in _STRIPPED_TAGS else ""
    if not attributes or tag in ("html", "body"):
        return why
    for name, a, b, c in _MARK.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name == "role":
            why = "stripped" if value in _STRIPPED_ROLES else why
        elif name in ("hidden", "aria-hidden"):
            why = "hidden" if name == "hidden" or value == "true" else why
        else:
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & _REPLY_WORDS:
                return "replies"
            if words & _STRIPPED_WORDS:
                why = "stripped"
    return why


class _Page:
    """One pass over a page's markup; every character is read a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.linked = 0
        self.stack: list[tuple[str, str, int]] = []  # open elements of interest: tag, why stripped, number
        self.open: Counter = Counter()  # of the stack: tags and reasons
        self.articles: list[int] = []
        self.containers: list[int] = []
        self.numbers = 0
        self.in_link = self.heading = False

    def flush(self) -> None:
        if self.parts:
            line = " ".join(unescape("".join(self.parts)).split())
            if line:
                self.lines.append(Line(line, max(0, len(line) - self.linked), self.articles[-1] if self.articles else 0,
                                       self.containers[-1] if self.containers else 0, self.heading))
            self.parts.clear()
        self.linked = 0

    def close(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, why, number = self.stack.pop()
            self.open[tag] -= 1
            self.open[why] -= 1
            for held in (self.articles, self.containers):
                if held and held[-1] == number:
                    held.pop()

    def close_tag(self, tag: str) -> None:
        if self.open[tag] > 0:
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.close(at)

    def begin(self, tag: str, attributes: str) -> None:
        if tag == "body":
            return self.close(0)
        if tag in _LOOSE:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    self.close(i)
                    break
                if self.stack[i][0] not in _LOOSE:
                    break
        why = _stripped(tag, attributes)
        if tag in _WHOLE and not why and not self.open["replies"] and (self.open["stripped"] or self.open["hidden"]):
            # an article also ends stripped elements whose end tag is missing
            self.close(next(i for i, e in enumerate(self.stack) if e[1] in ("stripped", "hidden")))
        if tag == "a":
            self.in_link = True
        if tag in _VOID or attributes.endswith("/") and tag in ("svg", "path", "circle", "rect"):
            return None
        if why or tag in _WHOLE or tag in _CONTAINERS or tag in ("ul", "ol", "table"):
            self.numbers += 1
            self.stack.append((tag, why, self.numbers))
            self.open[tag] += 1
            self.open[why] += 1
            if tag in _WHOLE:
                self.articles.append(self.numbers)
            if tag in _CONTAINERS or tag in _WHOLE:
                self.containers.append(self.numbers)
        return None

    def text(self, text: str) -> None:
        if text and not (self.open["stripped"] or self.open["replies"] or self.open["hidden"]):
            self.parts.append(text)
            if self.in_link:
                self.linked += len(text)

    def read(self) -> list[Line]:
        page, at, end, quotes = self.page, 0, len(self.page), True
        while at < end:
            start = page.find("<", at)
            if start < 0:
                self.text(page[at:])
                break
            self.text(page[at:start])
            at = start + 1
            if page.startswith("!--", at):
                stop = page.find("-->", at + 3)
                at = end if stop < 0 else stop + 3
                continue
            if page.startswith("![CDATA[", at):
                stop = page.find("]]>", at)
                self.text(page[at + 8 : end if stop < 0 else stop].replace("&", "&amp;"))
                at = end if stop < 0 else stop + 3
                continue
            name = _NAME.match(page, at)
            if not name:
                if page[at : at + 1] in ("!", "?", "/"):
                    stop = page.find(">", at)
                    at = end if stop < 0 else stop + 1
                else:
                    self.text("<")
                continue
            rest = _REST.match(page, name.end()) if quotes else None
            if rest:
                attributes, at = page[name.end() : rest.end() - 1], rest.end()
            else:  # a quote that never closes: from here on quotes mean nothing
                quotes = False
                stop = page.find(">", name.end())
                attributes, at = page[name.end() : end if stop < 0 else stop], end if stop < 0 else stop + 1
            tag = name.group().lower()
            closing, tag = tag[0] == "/", tag.lstrip("/")
            if tag in _BLOCKS:
                self.flush()
                self.heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
            if closing:
                if tag == "a":
                    self.in_link = False
                self.close_tag(tag)
            elif tag in _RAW:
                shut = re.compile(rf"</{tag}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                at = shut.end() if shut else end
            else:
                self.begin(tag, attributes)
        self.flush()
        return self.lines


def lines_of(page: str) -> list[Line]:
    """The blocks of a page that are left when markup and what is no article are stripped."""
    return _Page(page).read()


def window_sums(lines: list[Line], window: int = WINDOW) -> list[int]:
    """Text in the ``window`` lines from each line on, without those beyond the edge of an article."""
    sizes = [min(x.size, LONG) for x in lines]
    sums = []
    for i, line in enumerate(lines):
        total = 0
        for k in range(i, min(i + window, len(lines))):
            if lines[k].article != line.article:
                break
            total += sizes[k]
        sums.append(total)
    return sums


def threshold(sums: list[int], sizes: list[int], dense: float = DENSE) -> float:
    """``dense`` of the window sum at the page's middle character, when lines are put in order of their sums."""
    half, passed = sum(sizes) / 2, 0
    for total, size in sorted(zip(sums, sizes)):
        passed += size
        if passed >= half:
            return max(1.0, dense * total)
    return 1.0


def stretches(lines: list[Line], window: int = WINDOW) -> list[tuple[int, int]]:
    """(first, one past last) line of each stretch between a surge and its dive.

    A surge is a line whose sum reaches the threshold with text on the line itself; a dive is the
    next line whose sum and own text are both below it, or that another article begins.
    """
    sizes = [min(x.size, LONG) for x in lines]
    sums = window_sums(lines, window)
    least = threshold(sums, sizes)
    found, start = [], -1
    for i, total in enumerate(sums):
        if start >= 0 and (lines[i].article != lines[start].article or total < least and sizes[i] < least / window):
            found.append((start, i))
            start = -1
        if start < 0 and total >= least and sizes[i] >= min(least / window, BEGINS):
            start = i
    if start >= 0:
        found.append((start, len(lines)))
    return found


def kept(lines: list[Line]) -> list[bool]:
    """Which lines are main text: the stretches, moved to the edges of what they mostly fill, and the headings right above them."""
    keep = [False] * len(lines)
    for a, b in stretches(lines):
        for i in range(a, b):
            keep[i] = True
    for of in (lambda x: x.container, lambda x: x.article):
        whole, inside = Counter(), Counter()
        for x, k in zip(lines, keep):
            size = min(x.size, LONG)
            whole[of(x)] += size
            inside[of(x)] += size * k
        for i, x in enumerate(lines):
            if of(x) and inside[of(x)] and inside[of(x)] >= MOSTLY * whole[of(x)]:
                keep[i] = True
    for i in range(len(lines) - 2, -1, -1):
        if keep[i + 1] and lines[i].heading and lines[i].article == lines[i + 1].article:
            keep[i] = True
    return keep


def main_text(page: str | None) -> str:
    """The main text of one page; '' if there is none."""
    lines = lines_of(page or "")
    return " ".join(x.text for x, k in zip(lines, kept(lines)) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row.

    Null and empty pages have empty text.  Repeated rows repeat; an empty table
    stays empty; extra columns are not read.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))

    def run(batches):
        for b in slices(batches):
            texts = [main_text(h.as_py()) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return source.mapInArrow(run, f"page_id {dict(source.dtypes)['page_id']}, url string, text string, n_chars long")


def query(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
