"""HTML extraction by tree scoring.

Blocks of text (paragraphs and the like) pass points for their length and their commas to the
elements around them: all to the parent, half to its parent, less further up. What an element
has gathered is discounted by its link density, the part of its text that stands in links. The
best element is the container of the main text; its siblings stay if they score well or read
like prose, and so do headings right before what stays. Within what is kept, elements that are
named or built like menus, adverts, notices, forms or comments are left out.

Names can mislead: a wrapper of the whole page may be called "layout has-sidebar", and some pages
lie in one form. So a name that tells of a state or of something missing counts for nothing, and
if hardly any of the page's text would remain without forms and elements whose names also hold
other words, the one of them that holds most of it stays.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from gridtide.llm.rows import column, whole_row

# fixed values: HTML's own lists of elements
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
DROPPED = frozenset(
    "head script style noscript template iframe textarea title nav footer aside button "
    "select option input object embed applet canvas svg math audio video map menu dialog".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
    "toolbar".split()
)
#: words of class and id that name other things than the main text
OTHER = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar side aside related "
    "recommended widget footer masthead topbar cookie cookies consent gdpr notice popup modal "
    "overlay newsletter subscribe signup login share sharing social comment comments comentarios "
    "commentaires kommentare disqus replies reply respond form search skip toolbar copyright".split()
)
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
#: first words of a name that say that something is or isn't there, last words that tell a state
WITH = frozenset("has have no not non is with without".split())
STATES = frozenset("open opened closed enabled disabled on off active visible hidden by".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: what must be left of a page's text without what is dropped by an unclear name
MIN_LEFT = 0.1
TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S
)
SPACE = re.compile(r"\s+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
MIN_BLOCK = 25


class Element:
    __slots__ = (
        "tag", "attributes", "parent", "children", "points", "inside", "size", "linked", "drop", "stays",
    )

    def __init__(self, tag: str, attributes: str, parent: "Element | None"):
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list = []
        self.points, self.inside, self.size, self.linked = 0.0, 0, 0, 0
        self.drop = self.stays = False


def _closable(stack: list[Element], tags, until) -> int | None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            return i
        if stack[i].tag in until:
            return None
    return None


def parse(text: str) -> Element:
    """The tree of a page; text lies between elements as strings. Unclosed and stray tags are
    mended as browsers mend them in the common cases."""
    root = Element("#root", "", None)
    stack = [root]
    at = 0
    for match in iter(lambda: TAG.search(text, at), None):
        if match.start() > at:
            stack[-1].children.append(text[at: match.start()])
        at = match.end()
        name = match[2] or match[5]
        if not name:
            continue
        tag, closing = name.lower(), match[1] or match[4]
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("td", "th", "table") and tag not in BLOCKS:
                    break
            else:
                if tag == "p":  # the end of a paragraph that isn't open is an empty one
                    stack[-1].children.append(Element("p", "", stack[-1]))
            continue
        if tag in CLOSES_P:
            i = _closable(stack, {"p"}, {"button", "td", "th", "table", "object", "li", "div",
                                         "article", "section", "blockquote", "main"})
            if i:
                del stack[i:]
        if tag in SIBLINGS:
            i = _closable(stack, *SIBLINGS[tag])
            if i:
                # the outermost of the elements that end here
                while i > 1 and stack[i - 1].tag in SIBLINGS[tag][0]:
                    i -= 1
                del stack[i:]
        element = Element(tag, match[3] or "", stack[-1])
        stack[-1].children.append(element)
        if tag in VOID or element.attributes.endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(text, at)
            stop = end.start() if end else len(text)
            close = text.find(">", stop) if end else len(text)
            at = len(text) if close < 0 else min(close + 1, len(text))
            continue
        stack.append(element)
    if at < len(text):
        stack[-1].children.append(text[at:])
    return root


def _attributes(element: Element) -> dict[str, str]:
    return {
        m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(element.attributes)
    }


def _named_other(names: str) -> tuple[bool, bool]:
    """Whether classes and ids name something else than the main text, clearly or among other
    words."""
    unclear = False
    for name in names.split():
        words = [word.lower() for word in NAME.findall(name)]
        if not words or words[0] in WITH or len(words) > 1 and words[-1] in STATES:
            continue
        if "by" in words[1:-1]:  # side-by-side
            continue
        if all(word in OTHER for word in words):
            return True, False
        unclear = unclear or any(word in OTHER for word in words)
    return False, unclear


def _other(element: Element, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is built or clearly named like something else than the main text, and
    whether it may be something else: a form, an unclear name."""
    if element.tag in DROPPED:
        return True, False
    if element.tag == "header" and not in_article:
        return True, False
    if element.tag == "form":
        return False, True
    if not element.attributes.strip():
        return False, False
    found = _attributes(element)
    if element.tag in ("html", "body", "article", "main"):
        return False, False
    if "hidden" in found or found.get("aria-hidden") == "true":
        return True, False
    if HIDDEN_STYLE.search(found.get("style", "")):
        return True, False
    role = found.get("role", "").lower()
    if role in ROLES:
        return role != "form", role == "form"
    return _named_other(found.get("class", "") + " " + found.get("id", ""))


def _blocks(element: Element, marked: bool) -> list[str]:
    """Texts of the blocks under an element, in order; those marked to drop are left out."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        joined = SPACE.sub(" ", entities.unescape("".join(run))).strip()
        if joined:
            out.append(joined)
        run.clear()

    todo: list = [element]
    while todo:
        item = todo.pop()
        if item is None:
            close()
        elif isinstance(item, str):
            run.append(item)
        elif not (marked and item.drop):
            if item.tag == "br":
                run.append(" ")
            elif item.tag in BLOCKS:
                close()
                todo.append(None)
            todo.extend(reversed(item.children))
    close()
    return out


def _score(root: Element) -> tuple[list[Element], list[Element], float]:
    """Marks what to drop, gives points: elements with points in page order, elements dropped for
    unclear reasons, and the size of the page's text outside links, those included."""
    todo = [(root, False, False, None, False)]
    found: list[Element] = []
    named: list[Element] = []
    order: list[Element] = []
    while todo:
        element, in_article, in_link, block, inside = todo.pop()
        element.points, element.inside = 0.0, 0
        element.size = element.linked = 0
        built, unclear = _other(element, in_article) if element.parent is not None else (False, False)
        element.drop = built or unclear and not element.stays
        if built:
            continue
        order.append(element)
        if element.drop and not inside:
            named.append(element)
        inside = inside or element.drop
        if element.tag in BLOCKS:
            block = element
        in_article = in_article or element.tag in ("article", "main")
        in_link = in_link or element.tag == "a"
        own = "".join(c for c in element.children if isinstance(c, str))
        own = SPACE.sub(" ", entities.unescape(own)).strip() if own.strip() else ""
        if own:
            size, commas = len(own), sum(own.count(c) for c in ",،，、")
            points = (1 + commas + min(size / 100, 3)) if size >= MIN_BLOCK else 0.0
            element.inside = 0 if in_link else size
            if not inside:
                element.size = size
                element.linked = size if in_link else 0
            holder = block if block is not None and block.parent is not None else element
            holder = holder.parent if holder.tag in ("p", "pre", "td", "li", "blockquote", "h1",
                                                     "h2", "h3", "h4", "h5", "h6") else holder
            share = 1.0
            for _ in range(5):
                if inside or holder is None or holder.parent is None or not points:
                    break
                if not holder.points:
                    found.append(holder)
                holder.points += points * share
                holder, share = holder.parent, share / 2 if share == 1.0 else share / 1.5
        todo.extend(
            (c, in_article, in_link, block, inside) for c in reversed(element.children)
            if not isinstance(c, str)
        )
    for element in reversed(order):  # children before their parents
        above = element.parent
        if above is not None:
            above.inside += element.inside
            above.size += element.size
            above.linked += element.linked
    return found, named, root.inside


def _density(element: Element) -> float:
    return element.linked / element.size if element.size else 0.0


def extract(text: str | None) -> str:
    """The main text of a page: its blocks joined by \\n; empty if there is none."""
    root = parse(text or "")
    scored, named, whole = _score(root)
    while named and sum(e.inside for e in named) > (1 - MIN_LEFT) * whole:
        largest = max(named, key=lambda e: e.inside)
        if 2 * largest.inside < whole:
            break
        largest.stays = True
        scored, named, whole = _score(root)
    if not scored:
        # no block is long enough to score: all that is not marked otherwise
        return "\n".join(_blocks(root, True))

    def value(element: Element) -> float:
        # an element that says what it is needs no search
        own = 25 if element.tag == "article" else 15 if element.tag == "main" else 0
        return (element.points + own) * (1 - _density(element))

    best = max(scored, key=value)
    # an article is taken whole, also if most points lie deep in it
    above = best.parent
    while above is not None:
        if above.tag in ("article", "main") and best.tag != "article":
            best = above
        above = above.parent
    kept = [best]
    if best.parent is not None and best.tag not in ("body", "html"):
        limit = max(10.0, value(best) * 0.2)
        kept, headings = [], []
        for item in best.parent.children:
            if not isinstance(item, Element) or item.drop:
                continue
            if item.tag in HEADINGS:
                headings.append(item)
                continue
            prose = item.tag == "p" and item.size > 80 and _density(item) < 0.25
            same = item.tag == best.tag or best.tag == "div"
            if item is best or prose or item.points and same and value(item) >= limit:
                kept += [*headings, item]
            headings = []
    return "\n".join(block for item in kept for block in _blocks(item, True))


def _extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0),
             pa.array([extract(page) for page in batch.column(1).to_pylist()], type=pa.string())],
            names=["row", "main_text"],
        )


def extract_main_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """``row`` (struct of the input's columns) and main_text.

    A null or empty page has an empty text. Each row is treated by itself, so repeated rows and
    rows without id need nothing more; pages of any length are read whole; no rows give none.
    """
    rows = pages.select(
        whole_row(pages).alias("row"), column(pages, html_column).cast("string").alias("html")
    )
    return rows.mapInArrow(_extract_rows, T.StructType([rows.schema["row"]]).add("main_text", "string"))
