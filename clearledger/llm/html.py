"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing, content regions."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearledger.llm.common import text_slices

PIECE = 1 << 20  # characters that the parser is fed at once
SIGMA = 1.5  # of the Gaussian, in lines
LEAST_OF_BEST = 0.25  # share of the best region's text that another content region has
MOST_LINKED = 0.33  # share of a region's text in links

# HTML elements by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style head title noscript template svg math iframe object canvas audio video select textarea button datalist map".split()
)
APART = frozenset("nav header footer aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("body section div td blockquote center fieldset details".split())
#: Words in a class, id or role that set an element apart from the main text.
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs header masthead footer contentinfo "
    "complementary comment comments disqus reply replies share sharing social related recommended newsletter subscribe signup login search "
    "pagination pager widget toolbar".split()
)
_MARKUP = re.compile(r"<[!?]|</?[a-zA-Z]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def _set_apart(attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
    """Whether the attributes set an element apart, and whether they hide it."""
    apart = hidden = False
    for name, value in attrs:
        value = value or ""
        if name in ("class", "id", "role"):
            apart = apart or any(w.lower() in APART_WORDS for w in _WORDS.findall(value))
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style":
            hidden = hidden or "display:none" in value.replace(" ", "").lower()
    return apart, hidden


@dataclass(slots=True)
class Line:
    """One block: its words, tags and the characters of its words in links. ``region`` tells the
    container; blocks that are ``apart`` are never main text."""

    region: int
    named: bool
    apart: bool
    words: list[str] = field(default_factory=list)
    tags: int = 1
    chars: int = 0
    linked: int = 0


@dataclass(slots=True)
class _Open:
    tag: str
    block: bool
    unseen: bool
    apart: bool
    region: int
    named: bool  # the region is an article or main element
    link: bool


class PageLines(HTMLParser):
    """Lines of a page, from events of the parser. Unclosed, stray and crossing tags are borne."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack = [_Open("", True, False, False, 0, False, False)]
        self.open: Counter[str] = Counter()
        self.regions = 0
        self.pending: list[str] = []
        self.tags = 0
        self.line: Line | None = None

    def _flush_text(self) -> None:
        """Words of the text since the last tag; white space at its ends separates words."""
        if not self.pending:
            return
        text, self.pending = "".join(self.pending), []
        top = self.stack[-1]
        if top.unseen:
            return
        words = text.split()
        if not words:
            if self.line is not None and text:
                self.line.words.append("")  # white space only: a border between words
            return
        if self.line is not None and self.line.apart != top.apart:
            if top.apart:  # set apart inside a block: only that text goes
                self.line.words.append("")
                return
            self.line = None
        if self.line is None:
            self.line = Line(top.region, top.named, top.apart)
            self.lines.append(self.line)
        line = self.line
        before = line.words
        if before and before[-1] and not text[0].isspace():
            before[-1] += words.pop(0)
        before.extend(words)
        if text[-1].isspace():
            before.append("")
        line.chars += len(text)
        if top.link:
            line.linked += len(text)

    def _end_line(self) -> None:
        self._flush_text()
        if self.line is not None:
            self.line.tags += self.tags
        self.line, self.tags = None, 0

    def _pop_to(self, depth: int) -> None:
        self._flush_text()
        for element in self.stack[depth:]:
            self.open[element.tag] -= 1
        del self.stack[depth:]

    def _within_inline(self, tag: str) -> int:
        """Depth of the innermost open ``tag`` that has only inline elements above it, or 0."""
        if self.open[tag]:
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth].tag == tag:
                    return depth
                if self.stack[depth].block:
                    break
        return 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        block = tag in BLOCKS
        if block:
            self._end_line()
            for closed in ("p", "li") if tag == "li" else ("dt", "dd", "p") if tag in ("dt", "dd") else ("p",):
                if depth := self._within_inline(closed):
                    self._pop_to(depth)
        else:
            self._flush_text()
        if tag in VOID:
            if tag == "br" and self.line is not None:
                self.line.words.append("")
            return
        top = self.stack[-1]
        apart, hidden = _set_apart(attrs) if attrs else (False, False)
        inside = top.named and tag == "header"  # the title of an article
        apart = tag not in ("html", "body", "article", "main") and ((tag in APART and not inside) or apart)
        region, named = top.region, top.named
        if not named and (tag in CONTAINERS or tag in ("article", "main")):
            self.regions += 1
            region, named = self.regions, tag in ("article", "main")
        unseen = top.unseen or hidden or tag in UNSEEN
        self.stack.append(_Open(tag, block or tag in UNSEEN, unseen, top.apart or apart, region, named, top.link or tag == "a"))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS or tag in UNSEEN:
            self._end_line()
            if self.open[tag]:
                depth = len(self.stack) - 1
                while self.stack[depth].tag != tag:
                    depth -= 1
                self._pop_to(depth)
        elif depth := self._within_inline(tag):
            self._pop_to(depth)

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)  # sections of unknown kinds would raise


def page_lines(html: str) -> list[Line]:
    """Lines with a word, in page order."""
    parser = PageLines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    if _MARKUP.match(parser.rawdata):  # a tag or comment that never ends
        parser.rawdata = ""
    parser.close()
    parser._end_line()
    for line in parser.lines:
        line.words = [w for w in line.words if w]
    return [line for line in parser.lines if line.words]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean over the lines around each, by the weights of those there are."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    over = lambda x: np.convolve(x, kernel)[reach : reach + len(x)]
    return over(ratios) / over(np.ones(len(ratios)))


def content_lines(lines: list[Line]) -> list[bool]:
    """Whether each line is main text.

    A line's ratio is its characters outside links for each tag, 0 if it is set apart. Lines whose
    smoothed ratio is above the threshold, the standard deviation over the page, are seeds of
    content; the regions that hold enough of their text are content, with all their lines that are
    not set apart, short ones too. Regions named article or main go before others.
    """
    if not lines:
        return []
    ratios = np.array([0.0 if x.apart else max(0, x.chars - x.linked) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratios)
    seeds = (smooth >= smooth.std()) & (ratios > 0)
    weight, total, linked = Counter(), Counter(), Counter()
    named = {x.region for x in lines if x.named and not x.apart}
    for line, seed in zip(lines, seeds):
        if line.apart or (named and line.region not in named):
            continue
        total[line.region] += line.chars
        linked[line.region] += line.linked
        weight[line.region] += line.chars if seed else 0
    if not any(weight.values()):  # no line stands out: every line counts
        weight = total
    best = max(weight.values(), default=0)
    chosen = {
        r for r, w in weight.items()
        if w >= LEAST_OF_BEST * best and w > 0 and (r in named or linked[r] <= MOST_LINKED * total[r])
    }
    return [x.region in chosen and not x.apart for x in lines]


def main_text(html: str | None) -> str:
    """The content lines of a page, joined by line feeds."""
    lines = page_lines(html or "")
    return "\n".join(" ".join(x.words) for x, content in zip(lines, content_lines(lines)) if content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``text`` and ``n_chars`` (code points) of every page: id, url, text, n_chars.

    The whole page is parsed as a stream of events; nothing is cut off or left out but what
    is set apart: menus, headers, footers, sidebars, notices, adverts, forms, comments, hidden
    elements, scripts and styles, by their elements, or by the words of their class, id or role. The rest
    is clustered by ``content_lines``. Character references are decoded, white space in a block
    becomes one space, blocks are joined by one line feed. A line break element is white space.

    One pass over the rows without a shuffle, in slices of a few MB. Null and empty pages give an
    empty text. Null and repeated ids and urls pass through, each row with its own text; other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    source = pages.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("text")
    )
    kinds = [source.schema[c].dataType for c in ("id", "url")]
    arrow = [to_arrow_type(k) for k in kinds]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = [main_text(h) for h in part.column("text").to_pylist()]
            keys = [part.column(c).cast(t) for c, t in zip(("id", "url"), arrow)]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["id", "url", "text", "n_chars"])

    schema = f"id {kinds[0].simpleString()}, url {kinds[1].simpleString()}, text string, n_chars long"
    return source.mapInArrow(run, schema).toDF(id_col, url_col, "text", "n_chars")
