"""Main text of web pages by text-to-tag ratio.

The page streams through the standard library's parser; its events cut the page
into lines, one for each block of text, with the number of tags in it. A line's
text-to-tag ratio is the length of its text over its tags; text inside links
counts as tags do, since it leads away. The ratios are smoothed with a Gaussian over neighbouring lines, and a threshold splits them
into content and the rest (the two-means cut of the logarithms, after Weninger,
Hsu and Han, CETR, 2010). Lines in an element that says it is no content (nav,
footer, aside, script ..., a header outside articles, a form, or a class, id or
role with such a name) do not count; an article or main inside a part that only its
name speaks against does, unless a name says it is a comment. A name or a form
speaks for nothing if the element holds the page: several times the text that is
left without it. Content regions are the containers that hold content lines: the
article and main elements with any, unless another container has more content,
else all containers with a content line that is not mostly links, and sections
with a heading beside them. All lines of a region are returned, short ones too, so
the ratios choose regions and not lines: an article's short lines and its title
have low ratios of their own.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by a newline in page order. Null or empty html, and pages
without text, give an empty text. A broken or unclosed tag ends where its parent
ends. Work and memory go by the page's length, however deep its elements are. Pages are independent: Spark only maps. Repeated rows and extra columns
pass through; a column called as the output is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.text import portions, small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that hold no article text.
NO_CONTENT = frozenset(
    "head title nav header footer aside script style noscript template iframe object svg canvas button select "
    "textarea input menu dialog audio video map datalist".split()
)
#: Words of class, id and role that name other parts of a page.
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments cookie "
    "cookies consent contentinfo copyright disqus footer gdpr header legal login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification overlay pagination pager popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar topbar widget widgets complementary".split()
)
#: Names of reader comments; they hold for article elements too.
COMMENT_NAMES = frozenset("comment comments disqus replies reply respond".split())
#: Words that make a name speak of the page around it ("with-sidebar") or of the article's own head ("entry-header").
ABOUT = frozenset("has hide is layout no not with without".split())
#: First words of names that tell what a text is about.
SUBJECTS = frozenset("author cat category format lang section status subject tag topic type".split())
OWN_HEAD = frozenset("article content entry post story".split())
#: Parts of an element whose own start ends an open element of the same kind.
SELF_CLOSING = {
    "p": BLOCK - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"},
}
MAIN = ("article", "main")
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def named(value: str) -> frozenset[str]:
    """The names of other parts of a page that a class, id or role has among its words.

    "cookie-notice", "siteHeader" and "promo-card" are such parts; "with-sidebar",
    "category-social-science" and "entry-header" are not.
    """
    found = set()
    for token in value.split():
        words = [x.lower() for x in NAME.findall(token)]
        if not words or ABOUT & set(words) or words[0] in SUBJECTS:
            continue
        found |= NO_CONTENT_NAMES & set(words) - ({"header"} if OWN_HEAD & set(words) else set())
    return frozenset(found)


#: What an open element says of its text: content, named as no content, or no content whatever is inside.
KEEP, NAMED, GONE = 0, 1, 2
#: An end tag does not reach over these.
BARRIERS = ("article", "main", "body", "table")
BOXES = frozenset(("html", "body", "div", "section", "td", "blockquote"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: An element that only its name speaks against holds the page if it has this many characters outside links, and so many times those left without it.
WRAPS, TIMES = 140, 3


class _Open:
    """An open element; what it takes over from its parent is kept with it, so nothing walks up the page."""

    __slots__ = ("box", "main", "named", "number", "state", "tag")

    def __init__(self, tag: str, number: int, state: int, own: bool, above: _Open | None):
        self.tag, self.number, self.state = tag, number, state
        self.main = (tag, number) if tag in MAIN else above.main if above else None
        self.box = (tag, number) if tag in BOXES else above.box if above else ("", 0)
        #: the innermost element whose own name speaks against what is here
        self.named = number if own else above.named if above and state == NAMED else 0


class _Lines(HTMLParser):
    """Lines of a page: [text, tags, characters in links, state, container, naming element, its block's tag]."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.at: dict[str, list[int]] = {}  # places of a tag's open elements
        self.blocks: list[int] = []  # places of open blocks
        self.lines: list[list] = []
        self.text: list[str] = []
        self.tags = self.linked = self.number = 0
        self.above: dict[int, int] = {}  # of elements with a name against them, the one around
        self.around: dict[tuple, tuple] = {}  # of containers, the one around

    def _end_line(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            top = self.open[-1] if self.open else None
            block = self.open[self.blocks[-1]].tag if self.blocks else ""
            # the innermost article or main, else the block's parent
            place = (top.main or top.box) if top else ("", 0)
            self.lines.append([text, self.tags, self.linked, top.state if top else KEEP, place, top.named if top else 0, block])
        self.text, self.tags, self.linked = [], 0, 0

    def _close(self, place: int) -> None:
        """End the element at a place, with all that is open inside it."""
        while len(self.open) > place:
            tag = self.open.pop().tag
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def _state(self, tag: str, attrs) -> tuple[int, bool]:
        """What an element says of its text, and whether its own name speaks against it."""
        above = self.open[-1] if self.open else None
        state = above.state if above else KEEP
        names = frozenset().union(*(named(v) for k, v in attrs if k in ("class", "id", "role") and v))
        if tag in MAIN:
            # an article counts in a part that only its name speaks against, unless it is a comment
            comment = any(COMMENT_NAMES & set(NAME.findall(x.lower())[-1:]) for k, v in attrs if k in ("class", "id", "role") and v for x in v.split() if named(x))
            return GONE if comment or state == GONE else KEEP, False
        if state == GONE or tag in ("html", "body"):
            return state, False
        hidden = any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)
        if hidden or names & COMMENT_NAMES or tag in NO_CONTENT and not (tag == "header" and above and above.main and above.main[0] == "article"):
            return GONE, False
        return (NAMED, True) if names or tag == "form" else (state, False)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end_line()
        self.tags += 1
        if tag in BLOCK:
            while self.open and tag in SELF_CLOSING.get(self.open[-1].tag, ()):
                self._close(len(self.open) - 1)
            # a block ends a paragraph that was left open, with what is open inside it
            if self.blocks and self.open[self.blocks[-1]].tag == "p" and tag in SELF_CLOSING["p"]:
                self._close(self.blocks[-1])
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        self.number += 1
        above = self.open[-1] if self.open else None
        element = _Open(tag, self.number, *self._state(tag, attrs), above)
        if element.named == self.number:
            self.above[self.number] = above.named if above else 0
        if element.box[1] == self.number:
            self.around[element.box] = above.box if above else ("", 0)
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self._end_line()
        places = self.at.get(tag)
        if not places:
            return
        barrier = max((self.at[x][-1] for x in BARRIERS if self.at.get(x)), default=-1)
        if tag in ("html", "body", *MAIN) or places[-1] >= barrier:
            self._close(places[-1])

    def handle_data(self, data):
        if self.open and self.open[-1].tag in ("script", "style"):
            return
        self.text.append(data)
        if self.at.get("a"):
            self.linked += len(data)


def smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over lines; the ends are weighed by what there is."""
    r = math.ceil(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel, "full")[r : r + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel, "full")[r : r + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Where two means of the values part; all values pass if they hardly differ."""
    low, high = float(values.min()), float(values.max())
    if high - low < math.log(2):
        return low
    for _ in range(30):
        cut = (low + high) / 2
        new = float(values[values <= cut].mean()), float(values[values > cut].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _wrappers(parser: _Lines) -> set[int]:
    """Elements that hold the page although their names speak against them."""
    held: dict[int, int] = {}
    for text, _, linked, state, _, by, _ in parser.lines:
        if state != GONE:
            held[by if state == NAMED else 0] = held.get(by if state == NAMED else 0, 0) + max(0, len(text) - linked)
    left = held.pop(0, 0)
    most = max(held.values(), default=0)
    found = {k for k, n in held.items() if n >= WRAPS and n >= TIMES * left and 2 * n >= most}
    around: set[int] = set()
    for k in found:
        while (k := parser.above[k]) and k not in around:
            around.add(k)
    return found | around


def _common(around: dict[tuple, tuple], places: set[tuple]) -> tuple:
    """The innermost container around all of some. A container's number is above that of any around it."""
    seen: set[tuple] = set()
    common = None
    for k in places:
        common = common or k
        while k not in seen and k[1] > common[1]:
            seen.add(k)
            k = around[k]
        while k not in seen and k != common:
            seen.add(common)
            common = around[common]
            while k[1] > common[1] and k not in seen:
                seen.add(k)
                k = around[k]
    return common or ("", 0)


def _beside(parser: _Lines, lines: list[list], regions: set[tuple]) -> set[tuple]:
    """Containers with a heading and more, mostly not links, that stand beside the regions' common container."""
    common = _common(parser.around, regions)
    roof = parser.around.get(common, common) if common in regions else common
    sums: dict[tuple, list[int]] = {}
    for text, _, linked, _, place, _, block in lines:
        if place[0] not in MAIN:
            n = sums.setdefault(place, [0, 0, 0, 0])
            for i, x in enumerate((len(text), linked, block in HEADINGS, block not in HEADINGS)):
                n[i] += x
    inside = {roof: True}
    found = set()
    for place, (n, linked, heads, others) in sums.items():
        if heads and others and 2 * linked < n and place not in regions:
            way = [place]
            while way[-1] not in inside and way[-1] in parser.around:
                way.append(parser.around[way[-1]])
            inside |= dict.fromkeys(way, inside.get(way[-1], False))
            if inside[place]:
                found.add(place)
    return found


def main_text(html: str, sigma: float = 1.0) -> str:
    """The page's main text, blocks joined by newlines."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser._end_line()
    wrap = _wrappers(parser)
    lines = [x for x in parser.lines if x[3] == KEEP or x[3] == NAMED and x[5] in wrap]
    if not lines:
        return ""
    ratios = np.array([max(0, len(x[0]) - x[2]) / max(1, x[1] + x[2] / 8) for x in lines])
    smoothed = np.log1p(smooth(ratios, sigma))
    content = smoothed >= threshold(smoothed)
    found = [x for x, c in zip(lines, content) if c]
    # a menu beside the text passes by its neighbour's ratio: links and headings alone open no region, but stay in one
    own = [x for x in found if 2 * x[2] < len(x[0])]
    own = [x for x in own if x[6] not in HEADINGS] or own
    weight: dict[tuple, int] = {}
    for x in own:
        weight[x[4]] = weight.get(x[4], 0) + len(x[0]) - x[2]
    main = {x[4] for x in found if x[4][0] in MAIN}
    others = {k: n for k, n in weight.items() if k[0] not in MAIN}
    if main and sum(weight.get(k, 0) for k in main) >= max(others.values(), default=0):
        regions = main
    else:
        regions = set(others) or {x[4] for x in found}
        regions |= _beside(parser, lines, regions)
    return "\n".join(x[0] for x in lines if x[4] in regions)


def extract(pages: DataFrame, *, html: str = "html", out: str = "text", sigma: float = 1.0) -> DataFrame:
    """Add the main text of each page."""
    small_batches(pages.sparkSession)
    pages = pages.drop(out)
    schema = T.StructType([*pages.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, html):
            got = [main_text(x, sigma) if x else "" for x in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string())], names=[*batch.schema.names, out])

    return pages.mapInArrow(run, schema)
