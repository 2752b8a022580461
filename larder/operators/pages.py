"""Product pages: fields found by ladders of selectors over a page's elements.

One pass of the standard library's parser records the elements and their texts;
the ladders then look at the record. An end tag closes the nearest open element
of its name, and one that closes nothing is passed over, so pages may be broken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.functions import fixed

FIELDS = [
    T.StructField("title", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("ingredients", T.StringType()),
    T.StructField("nutrition", T.MapType(T.StringType(), T.StringType())),
    T.StructField("images", T.ArrayType(T.StringType())),
]
_ARROW = (pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.list_(pa.string()))


@cache
def _selector(s: str) -> tuple[str, str | None, str]:
    """What a selector asks of an element: ("tag", None, name), ("class", None, name), or ("attribute", its name, value)."""
    attribute = re.fullmatch(r'\[([\w-]+)="([^"]*)"\]', s)
    return ("attribute", attribute[1], attribute[2]) if attribute else ("class", None, s[1:]) if s[0] == "." else ("tag", None, s)


@cache
def _said(word: str) -> re.Pattern:
    return re.compile(re.escape(word), re.I)


class Page(HTMLParser):
    """Elements in order, each with its tag, attributes, parent, and the run of texts that it holds."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tags, self.attributes, self.starts, self.ends = [""], [{}], [0], [0]
        self.open = [0]
        #: text, its element, and whether a reader sees it in the elements around
        self.texts: list[tuple[str, int, bool]] = []
        self._last: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        for k in self.open:
            self.ends[k] = len(self.texts)

    def _flush(self) -> None:
        if self._last:
            k = self.open[-1]
            self.texts.append(("".join(self._last), k, self.tags[k] not in ("script", "style", "template")))
            self._last = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        k = len(self.tags)
        self.tags.append(tag)
        self.attributes.append({a: v or "" for a, v in attrs})
        self.starts.append(len(self.texts))
        self.ends.append(len(self.texts))
        if tag not in fixed.VOID_TAGS:
            self.open.append(k)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.tags[self.open[i]] == tag), 0)
        if at:
            for k in self.open[at:]:
                self.ends[k] = len(self.texts)
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        self._last.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self.texts.append((data, self.open[-1], False))

    def text(self, k: int) -> str:
        """The stripped texts of an element and those in it, put together without anything between."""
        return "".join(t.strip() for t, of, seen in self.texts[self.starts[k] : self.ends[k]] if seen or (of == k and self.tags[k] in ("script", "style", "template")))

    def first(self, selectors: tuple[str, ...]) -> int | None:
        """The first element of the first selector that has any: a tag, .class, or [attribute="value"]."""
        for kind, name, value in map(_selector, selectors):
            for k in range(1, len(self.tags)):
                a = self.attributes[k]
                if self.tags[k] == value if kind == "tag" else value in a.get("class", "").split() if kind == "class" else a.get(name) == value:
                    return k
        return None

    def around(self, word: str) -> Iterator[int]:
        """Elements with a text of their own that holds the word, in any case, in order."""
        found = _said(word).search
        for t, k, _ in self.texts:
            if found(t):
                yield k


def fields(url: str, html: str) -> tuple:
    """title, price, ingredients, nutrition, images; '' or empty where a page has none."""
    page = Page(html)
    known: dict[int, str] = {}

    def text(k: int | None) -> str:
        if k is None:
            return ""
        if k not in known:
            known[k] = page.text(k)
        return known[k]

    nutrition = []
    for word in fixed.PAGE_NUTRITION:
        # of several the last counts
        last = next((x for x in map(text, reversed(list(page.around(word)))) if len(x) > 10), None)
        if last is not None:
            nutrition.append((word, last))
    ingredients = text(page.first(fixed.PAGE_INGREDIENTS))
    if not ingredients:
        said = (x for word in fixed.PAGE_INGREDIENT_WORDS for x in map(text, page.around(word)))
        ingredients = next((x for x in said if len(x) > 20), "")
    images = []
    for tag, a in zip(page.tags, page.attributes):
        src = (a.get("src") or a.get("data-src")) if tag == "img" else None
        if src and ("product" in src.lower() or "item" in src.lower()):
            images.append("https:" + src if src.startswith("//") else urljoin(url, src) if src.startswith("/") else src)
    return text(page.first(fixed.PAGE_TITLE)), text(page.first(fixed.PAGE_PRICE)), ingredients, nutrition, images


def product_pages(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add title, price, ingredients, nutrition (by keyword) and images; columns so called are replaced.

    Null pages and addresses are empty ones. A map over the rows: no shuffle.
    """
    names = [f.name for f in FIELDS]
    pages = pages.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fields(u or "", h or "") for u, h in zip(batch.column(url).to_pylist(), batch.column(html).to_pylist())]
            added = [pa.array([x[i] for x in got], kind) for i, kind in enumerate(_ARROW)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, *FIELDS]))
