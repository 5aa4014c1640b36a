"""Landed HTML pages to their links, text contexts and page attributes."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import parser as html_parser, unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from gridtide.functions.text import collapse

# Functions of this module travel to the executors whole: the package need not be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTLINE = (
    "page_id BIGINT, h1 STRING, description STRING, "
    "links ARRAY<STRUCT<ord: INT, href: STRING, label: STRING>>, "
    "contexts ARRAY<STRUCT<selector: INT, ord: INT, text: STRING, hrefs: ARRAY<STRING>>>"
)
# Elements and classes whose text describes the downloads inside, best first.
CONTEXT_TAGS = {"tr": 0, "li": 1, "p": 2, "article": 6, "section": 7}
CONTEXT_CLASSES = {"download": 3, "downloads": 4, "field--name-field-downloads": 5}
_VOID = {"br", "img", "hr", "meta", "link", "input", "col", "area", "base", "wbr", "source"}
_BLOCKS = {
    "p", "div", "ul", "ol", "table", "section", "article", "h1", "h2", "h3", "h4", "h5",
    "h6", "nav", "header", "footer", "form", "pre", "main", "aside",
}
# An opening tag ends these open elements, looking no further out than the fence.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_PARAGRAPH = ({"p"}, _BLOCKS - {"p"} | {"td", "th", "li"})
PAGES_AT_ONCE = 500


# Elements whose content the parser reads in other ways than tags and text.
_RAW = {
    *HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext",
}
# Text up to a plain opening tag, all of its attributes in double quotes, or a plain closing tag.
_PLAIN = re.compile(
    r"""([^<]*)<(?:([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9_:]*="[^"]*")*)[ \t\n\r\f]*>"""
    r"""|/([a-zA-Z][a-zA-Z0-9]*)>)"""
)
_ATTRIBUTE = re.compile(r'([^ \t\n\r\f=]+)="([^"]*)"')
_attribute_text = getattr(html_parser, "_unescape_attrvalue", unescape)


class _Outline(HTMLParser):
    """One pass over a page: open elements on a stack, text pieces in one list. The texts around
    links are put together only where they are asked for."""

    def __init__(self, with_contexts: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.with_contexts = with_contexts
        self.pieces: list[str] = []
        # tag, ord, first piece, selectors, href, first link
        self.stack: list[tuple[str, int, int, list[int], str | None, int]] = []
        self.paragraphs = 0
        self.links: list[tuple[int, str, str]] = []
        self.contexts: list[tuple[int, int, str, list[str]]] = []
        self.h1: str | None = None
        self.description: str | None = None
        self.count = 0

    def read(self, html: str) -> None:
        """The whole page. Plain tags, nearly all there are, are told apart here; the parser
        takes over at the first markup of any other kind."""
        at, plain = 0, _PLAIN.match
        while found := plain(html, at):
            text, tag, attributes, ended = found.groups()
            if tag and (tag := tag.lower()) in _RAW:
                break
            if text:
                self.pieces.append(unescape(text) if "&" in text else text)
            if ended:
                self.handle_endtag(ended.lower())
            else:
                values = {}
                if attributes:
                    for name, value in _ATTRIBUTE.findall(attributes):
                        values.setdefault(name.lower(), _attribute_text(value) if "&" in value else value)
                self._open(tag, values)
            at = found.end()
        self.feed(html[at:])
        self.close()
        while self.stack:
            self._close()

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for lines

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._open(tag, {name: value or "" for name, value in reversed(attrs)})

    def _open(self, tag: str, values: dict[str, str]) -> None:
        if tag == "meta" and self.description is None:
            if values.get("name", "").lower() == "description":
                self.description = values.get("content", "")
        if tag in _VOID:
            return
        self._imply_ends(tag)
        self.count += 1
        selectors = []
        if self.with_contexts:
            if tag in CONTEXT_TAGS:
                selectors.append(CONTEXT_TAGS[tag])
            if "class" in values:
                classes = set(values["class"].split())
                selectors += [rank for name, rank in CONTEXT_CLASSES.items() if name in classes]
        self.paragraphs += tag == "p"
        self.stack.append(
            (
                tag, self.count, len(self.pieces), selectors,
                values.get("href") if tag == "a" else None, len(self.links),
            )
        )

    def _imply_ends(self, tag: str) -> None:
        if tag in _BLOCKS and self.paragraphs:
            closes, fence = _PARAGRAPH
        elif tag in _CLOSES:
            closes, fence = _CLOSES[tag]
        else:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name in fence:
                return
            if name in closes:
                while len(self.stack) > at:
                    self._close()

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                while len(self.stack) > at:
                    self._close()
                return

    def handle_data(self, data: str) -> None:
        self.pieces.append(data)

    def _close(self) -> None:
        tag, ord_, start, selectors, href, first_link = self.stack.pop()
        self.paragraphs -= tag == "p"
        # a link of its own counts as inside
        inside = selectors and (href is not None or len(self.links) > first_link)
        heading = tag == "h1" and self.h1 is None
        if href is None and not inside and not heading:
            return
        text = "".join(self.pieces[start:])
        if href is not None:
            self.links.append((ord_, href, text))
        if heading:
            self.h1 = text
        if inside:
            hrefs = [href for _, href, _ in self.links[first_link:]]
            for rank in selectors:
                self.contexts.append((rank, ord_, text, hrefs))


def _listed(counts: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, *accumulate(counts)], pa.int32()), values)


def _columns(values: list[tuple], **types: pa.DataType) -> dict[str, pa.Array]:
    columns = zip(*values) if values else [()] * len(types)
    return {name: pa.array(column, kind) for (name, kind), column in zip(types.items(), columns)}


def _outline_batch(ids: pa.Array, pages: list[_Outline]) -> pa.RecordBatch:
    """Outlines as columns, without a Python object for each field of a link."""
    links = _columns(
        [link for page in pages for link in sorted(page.links)],
        ord=pa.int32(), href=pa.string(), label=pa.string(),
    )
    found = [context for page in pages for context in page.contexts]
    contexts = _columns(
        [context[:3] for context in found], selector=pa.int32(), ord=pa.int32(), text=pa.string()
    )
    hrefs = pa.array([href for context in found for href in context[3]], pa.string())
    contexts["hrefs"] = _listed([len(context[3]) for context in found], hrefs)
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([page.h1 for page in pages], pa.string()),
            pa.array([page.description for page in pages], pa.string()),
            _listed([len(page.links) for page in pages], pa.StructArray.from_arrays([*links.values()], [*links])),
            _listed(
                [len(page.contexts) for page in pages],
                pa.StructArray.from_arrays([*contexts.values()], [*contexts]),
            ),
        ],
        ["page_id", "h1", "description", "links", "contexts"],
    )


def _outlines(with_contexts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # few pages at a time: their texts are held as Python objects
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                rows, pages = batch.slice(start, PAGES_AT_ONCE), []
                for html in rows.column("html").to_pylist():
                    pages.append(page := _Outline(with_contexts))
                    page.read(html or "")
                yield _outline_batch(rows.column("page_id"), pages)

    return run


def page_outlines(pages: DataFrame, contexts: bool = True) -> DataFrame:
    """Links, contexts, first heading and description of each page, one parse per page.
    ``contexts=False`` leaves the contexts empty and does no work for them."""
    rows = pages.select(F.col("page_id").cast("bigint"), "html")
    return rows.mapInArrow(_outlines(contexts), OUTLINE)


LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def html_text(html: Column) -> Column:
    """Text of an HTML fragment: tags dropped, the common entities decoded, blanks collapsed."""
    text = F.regexp_replace(html, "<[^>]*>", "")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return collapse(text)


def page_links(pages: DataFrame) -> DataFrame:
    """Links of each page in document order, without leaving the JVM."""
    found = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(LINK), 1).alias("href"),
        F.regexp_extract_all("html", F.lit(LINK), 2).alias("label"),
    )
    keys = [name for name in pages.columns if name != "html"]
    links = pages.select(*keys, F.posexplode(found).alias("pos", "link"))
    return links.select(
        *keys, (F.col("pos") + 1).alias("ord"),
        F.col("link.href").alias("href"), html_text(F.col("link.label")).alias("label"),
    )


def page_attributes(pages: DataFrame) -> DataFrame:
    """First heading, title and description of each page, null where blank."""

    def first(pattern: str) -> Column:
        text = html_text(F.regexp_extract("html", pattern, 1))
        return F.when(text != "", text)

    keys = [name for name in pages.columns if name != "html"]
    return pages.select(
        *keys,
        first(r"(?is)<h1[^>]*>(.*?)</h1>").alias("h1"),
        first(r"(?is)<title[^>]*>(.*?)</title>").alias("title"),
        first(r"(?is)<meta\s+name=[\"']description[\"']\s+content=[\"']([^\"']*)[\"']").alias(
            "description"
        ),
    )
