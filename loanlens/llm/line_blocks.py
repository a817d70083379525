"""Main text of web pages by the distribution of text over blocks of lines.

A page is stripped of its markup line by line: every block element starts a new line, every layout
container leaves an empty one, and what stands in menus, forms, notices, scripts and the like is not
kept. A line weighs as many characters as it has outside links. The weights are summed over windows
of WINDOW lines. A sum of at least SURGE of the page's largest is a surge; the text runs on from it,
both ways, until the sums dive to nothing. All such runs make the main text. Where a page marks
its article (article or main element), the lines outside weigh nothing and links inside count.

Defined results: null or empty html, and a page without text, give an empty text; null ids and urls,
and repeated rows, are kept as they are; other columns are not read; an empty table gives no rows.
A very long page is scanned once from start to end, in time linear in its length, and is held by one
task together with its lines. Unclosed comments, scripts and tags run to the end of the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.arrays import chunks
from loanlens.llm.frames import table

WINDOW = 3
SURGE = 0.1
_SCHEMA = "page_id long, url string, text string, n_chars long, n_lines long, n_passages long"

# Element names of HTML by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math nobr q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("body center div dl main article ol section table ul".split())
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
UNREAD = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head input label menu nav object "
    "optgroup option select svg video".split()
)
UNREAD_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "status toolbar".split()
)
#: Words of class and id attributes that mark what is not the article.
UNREAD_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright discussion disqus footer form header login masthead menu modal "
    "nav navbar navigation newsletter notice notification pager pagination popup promo promoted "
    "promotion recommended related replies reply respond responses search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that say a header or the like belongs to the article.
READ_WORDS = frozenset("article body content entry main post story text".split())
PAGE_PARTS = frozenset(["article", "body", "html", "main"])
#: End tags that the start of another element of the second set stands for.
ENDED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}

_NAME = r"</?(?P<name>[a-zA-Z][^\s/>]*)"
_OTHER = r"|<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?/][^>]*+(?:>|\Z)"
#: Tags as written, and how they are read once a quote of an attribute was never closed.
_STRICT = re.compile(
    _NAME + r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>" + _OTHER + r"|<(?P<loose>[a-zA-Z])", re.S
)
_LOOSE = re.compile(_NAME + r"(?P<rest>[^>]*+)(?:>|\Z)" + _OTHER, re.S)
_HINT = re.compile(r"""\b(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass
class Line:
    text: str
    weight: int
    in_main: bool


def _marked(name: str, rest: str) -> bool:
    """True if the attributes of a tag say that it is not part of the article."""
    if _HIDDEN.search(_HINT.sub("", rest)):
        return True
    found: set[str] = set()
    for key, value in _HINT.findall(rest):
        key, value = key.lower(), value.strip("\"'")
        if key == "role" and value.lower() in UNREAD_ROLES:
            return True
        if key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if key in ("class", "id"):
            found.update(w.lower() for w in _WORDS.findall(value))
    bad = found & UNREAD_WORDS
    if name in PAGE_PARTS:
        bad &= {"comment", "comments"}
    elif bad <= {"header", "form"} and found & READ_WORDS:
        bad = set()
    return bool(bad)


class _Stripper:
    """Lines of one page; open elements are a stack, so that end tags may be missing."""

    def __init__(self) -> None:
        self.lines: list[Line] = []
        self.parts: list[str] = []
        self.weight = 0
        self.stack: list[tuple[str, bool, bool]] = []  # name, unread, starts the article
        self.open: Counter[str] = Counter()
        self.unread = self.main = 0

    def add_text(self, raw: str) -> None:
        if self.unread or not raw:
            return
        found = unescape(raw)
        self.parts.append(found)
        if not self.open["a"] or self.main:
            self.weight += len(found) - sum(map(found.count, " \t\n\f\r"))

    def end_line(self) -> None:
        if self.parts:
            found = " ".join("".join(self.parts).split())
            if found:
                self.lines.append(Line(found, self.weight, self.main > 0))
            self.parts, self.weight = [], 0

    def blank(self) -> None:
        if not self.main:
            self.lines.append(Line("", 0, False))

    def pop(self) -> str:
        name, unread, main = self.stack.pop()
        self.open[name] -= 1
        self.unread -= unread
        self.main -= main
        return name

    def close(self, name: str) -> None:
        if self.open[name]:
            while self.pop() != name:
                pass

    def start(self, name: str, rest: str) -> None:
        block = name not in INLINE
        if block:
            self.end_line()
            if self.open["p"]:
                self.close("p")
        if name in CONTAINERS and not self.unread:
            self.blank()
        if name in ENDED_BY and self.stack and self.stack[-1][0] in ENDED_BY[name]:
            self.pop()
        if name in VOID:
            if name == "br":
                self.end_line()
            return
        main = name in ("article", "main") or 'role="main"' in rest.lower()
        if main:
            # a menu or page header that was never closed ends where the article starts
            while self.unread and any(self.open[x] for x in ("nav", "header", "menu", "head")):
                self.pop()
        unread = name in UNREAD or (name == "header" and not self.main)
        unread = unread or (bool(rest) and _marked(name, rest))
        if name == "body":
            self.close("head")
        self.stack.append((name, unread, main and not unread))
        self.open[name] += 1
        self.unread += unread
        self.main += main and not unread

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.end_line()
        self.close(name)
        if name in CONTAINERS and not self.unread:
            self.blank()


def page_lines(html: str) -> list[Line]:
    """The page without markup, a line for every block and an empty one for every container's edge."""
    strip, pattern, at = _Stripper(), _STRICT, 0
    while found := pattern.search(html, at):
        if pattern is _STRICT and found["loose"]:
            pattern = _LOOSE
            continue
        strip.add_text(html[at : found.start()])
        at = found.end()
        if found["name"] is None:
            continue
        name = found["name"].lower()
        if html[found.start() + 1] == "/":
            strip.end(name)
        elif name in RAW:
            if name not in INLINE:
                strip.end_line()
            stop = _RAW_END[name].search(html, at)
            if stop is None:
                at = len(html)
                break
            at = stop.start()
        else:
            strip.start(name, found["rest"])
    strip.add_text(html[at:])
    strip.end_line()
    return strip.lines


def window_sums(weights: Sequence[int], window: int = WINDOW) -> list[int]:
    """Sums over each run of ``window`` lines, the first run ending with the first line."""
    sums, total = [], 0
    for i in range(len(weights) + window - 1):
        total += weights[i] if i < len(weights) else 0
        total -= weights[i - window] if i >= window else 0
        sums.append(total)
    return sums


def passages(weights: Sequence[int], window: int = WINDOW, surge: float = SURGE) -> list[tuple[int, int]]:
    """First and last line of every run between a rise from nothing and a dive to nothing that has a surge."""
    sums = window_sums(weights, window)
    least = max(1.0, surge * max(sums, default=0))
    found, start, high = [], None, False
    for i, total in enumerate([*sums, 0]):
        if total > 0:
            start = i if start is None else start
            high = high or total >= least
        elif start is not None:
            # window i ends with line i: the run's first line is new in the first window, its last
            # line is the oldest of the last one
            if high:
                found.append((start, i - window))
            start, high = None, False
    return found


def extract(html: str) -> tuple[str, int, int]:
    """Main text, its number of lines and of passages."""
    lines = page_lines(html)
    inside = any(line.in_main for line in lines)
    weights = [line.weight if line.in_main or not inside else 0 for line in lines]
    runs = passages(weights)
    kept = [x.text for a, b in runs for x in lines[a : b + 1] if x.text and (x.in_main or not inside)]
    return " ".join(kept), len(kept), len(runs)


def main_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Text of every page with the numbers of its code points, lines and passages."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            found = [extract(x) for x in batch.column("html").to_pylist()]
            text, lines, runs = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(text, pa.string()),
                    pa.array(map(len, text), pa.int64()),
                    pa.array(lines, pa.int64()),
                    pa.array(runs, pa.int64()),
                ],
                names=[x.split()[0] for x in _SCHEMA.split(", ")],
            )

    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), "url", F.coalesce(html_col, F.lit("")).alias("html")
    )
    return rows.mapInArrow(run, _SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


#: The article element of well-marked pages, as those of the table are: tags become blanks, character
#: references that occur are decoded. What the operator does for other pages SQL can't say.
SQL = r"""
WITH cut AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages
), plain AS (
  SELECT page_id, url, replace(replace(replace(replace(
    regexp_replace(regexp_replace(body, '</?(b|i|em|strong|span|a)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g'),
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#x27;', '''') AS body FROM cut
), decoded AS (
  SELECT page_id, url, trim(regexp_replace(regexp_replace(body, '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS text
  FROM plain
)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM decoded
"""
