"""Pages as tables of nodes, so that selectors, ancestor walks and flattening are filters, joins and aggregates.

A row for each element and each text (tag `#text`), numbered in page order from 0 (`pre`), with the number
after its subtree (`post`), its parent and its depth: node d lies at or below node a if a.pre <= d.pre < a.post. Void
elements are closed at once; `p`, `li`, `tr`, `td`, `dt`, `dd` and `option` are closed where HTML implies it.
Comments, declarations, and the contents of script and style, are dropped. How else a malformed page is repaired
differs between HTML libraries; here an end tag closes the nearest open element of its name, or nothing; a sign that
starts no tag is text, as is all from a tag on that doesn't end; a quote that isn't closed is no quote.

A page is read once from left to right, and each tag costs the same however deep it lies: what is open is known by
name. So time and memory follow the page's length, whatever it holds.

A character reference without its semicolon, as where a text was cut after it was escaped, is decoded as browsers do
(`&amp` is `&`), or stays as it is written (closed_references).

Every page of the input gets a number of its own (`row`), so a page id that occurs twice is two pages, each with
its own nodes. A null page has a root and nothing else. The nodes of a page lie together, in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workers import bounded_batches, give_back

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes an open element of these names, unless one of the others lies between.
CLOSES = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
} | {t: (("p",), ("button", "table")) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
HIDDEN = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style")}
SCHEMA = "pre int, post int, parent int, depth int, tag string, attrs map<string,string>, text string"
#: Nodes that leave a worker at once and characters of the pages that they are from, or those of one page if it has more.
NODES, CHARS = 20_000, 2 << 20

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)?(\s*=\s*)?")
_BARE = re.compile(r"[^\s>]*")
_CLOSED = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|([a-zA-Z][a-zA-Z0-9]*));")


def closed_references(text: str) -> str:
    """With character references decoded that are known and end in a semicolon."""
    return _CLOSED.sub(lambda m: unescape(m.group()) if m.group(1) is None or m.group()[1:] in html5 else m.group(), text) if "&" in text else text


class _Nodes:
    """Columns of the nodes of some pages, and what is open in the last one."""

    def __init__(self, decode: Callable[[str], str] = unescape):
        self.decode = decode
        self.pre, self.post, self.parent, self.depth, self.tag, self.text = ([] for _ in range(6))
        self.attr_ends, self.attr_names, self.attr_values = [0], [], []

    def __len__(self) -> int:
        return len(self.pre)

    def page(self, page: str | None) -> int:
        """Adds a page; returns how many nodes it has."""
        self.first, self.open, self.named, self.pieces = len(self.pre), [], {}, []
        self._add("#root", ())
        self._enter("#root")
        if page:
            self._read(page)
        self._say()
        self._leave(0)
        return len(self.pre) - self.first

    def _add(self, tag: str, attrs: object, text: str | None = None) -> None:
        n = len(self.pre) - self.first
        self.pre.append(n)
        self.post.append(n + 1)
        self.parent.append(self.open[-1] if self.open else None)
        self.depth.append(len(self.open))
        self.tag.append(tag)
        self.text.append(text)
        if attrs:
            found = dict(attrs)  # of a name that is there twice the last
            self.attr_names += found.keys()
            self.attr_values += found.values()
        self.attr_ends.append(len(self.attr_names))

    def _enter(self, tag: str) -> None:
        """The node added last is open; named has the places of open elements by name."""
        self.named.setdefault(tag, []).append(len(self.open))
        self.open.append(self.pre[-1])

    def _leave(self, upto: int) -> None:
        """Closes open elements from the last down to place upto."""
        n = len(self.pre) - self.first
        while len(self.open) > upto:
            at = self.first + self.open.pop()
            self.post[at] = n
            self.named[self.tag[at]].pop()

    def _nearest(self, tags: tuple[str, ...]) -> int:
        found = -1
        for t in tags:
            if (places := self.named.get(t)) and places[-1] > found:
                found = places[-1]
        return found

    def _say(self) -> None:
        """Text that has come together is one node."""
        if self.pieces:
            self._add("#text", (), "".join(self.pieces))
            self.pieces = []

    def _read(self, page: str) -> None:
        at, end, last = 0, len(page), page.rfind(">")
        self.unquoted: set[str] = set()  # quotes that no longer occur
        while at < end:
            start = page.find("<", at)
            if start < 0 or start > last:  # no tag can end any more
                self.pieces.append(self.decode(page[at:]))
                return
            if start > at:
                self.pieces.append(self.decode(page[at:start]))
            sign = page[start + 1 : start + 2]
            if sign in ("!", "?") or (sign == "/" and not _NAME.match(page, start + 2)):
                comment = page.startswith("<!--", start)
                at = page.find("-->" if comment else ">", start + 2)
                at = end if at < 0 else at + (3 if comment else 1)
            elif sign == "/":
                m = _NAME.match(page, start + 2)
                self._say()
                if (place := self._nearest((m.group().lower(),))) > 0:
                    self._leave(place)
                at = page.find(">", m.end()) + 1  # there is one, as start is before the last
            elif m := _NAME.match(page, start + 1):
                at = m.end()
                stop, attrs, alone = (at + 1, (), False) if page[at : at + 1] == ">" else self._attributes(page, at)
                if stop < 0:
                    self.pieces.append(self.decode(page[start:]))
                    return
                at = self._tag(page, m.group().lower(), attrs, alone, stop)
            else:
                self.pieces.append("<")
                at = start + 1

    def _attributes(self, page: str, at: int) -> tuple[int, list[tuple[str, str]], bool]:
        """Where the tag has ended (-1: it doesn't), its attributes, and whether it closes itself."""
        attrs: list[tuple[str, str]] = []
        while True:
            m = _ATTRIBUTE.match(page, at)
            name, equals = m.group(1), m.group(2)
            if not name and not equals:
                at = m.end()
                return (at + 1, attrs, page[at - 1] == "/") if page[at : at + 1] == ">" else (-1, attrs, False)
            at, value = m.end(), ""
            if equals:
                quote = page[at : at + 1]
                close = page.find(quote, at + 1) if quote in ('"', "'") and quote not in self.unquoted else -1
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                else:
                    if quote in ('"', "'"):
                        self.unquoted.add(quote)
                    m = _BARE.match(page, at)
                    value, at = m.group(), m.end()
            if name:
                attrs.append((name.lower(), self.decode(value)))

    def _tag(self, page: str, tag: str, attrs: object, alone: bool, at: int) -> int:
        """Adds an element that starts; returns where reading goes on."""
        if self.pieces:
            self._say()
        if tag in CLOSES:
            own, stop = CLOSES[tag]
            if (place := self._nearest(own)) > 0 and place > self._nearest(stop):
                self._leave(place)
        self._add(tag, attrs)
        if tag in VOID or alone:
            return at
        if tag in HIDDEN:
            close = HIDDEN[tag].search(page, at)
            gone = page.find(">", close.end()) if close else -1
            return gone + 1 if gone >= 0 else len(page)
        self._enter(tag)
        return at

    def columns(self) -> list[pa.Array]:
        attrs = pa.MapArray.from_arrays(pa.array(self.attr_ends, pa.int32()), pa.array(self.attr_names, pa.string()), pa.array(self.attr_values, pa.string()))
        return [pa.array(x, pa.int32()) for x in (self.pre, self.post, self.parent, self.depth)] + [pa.array(self.tag, pa.string()), attrs, pa.array(self.text, pa.string())]


def nodes_of(page: str | None, decode: Callable[[str], str] = unescape) -> pa.RecordBatch:
    """The nodes of one page."""
    nodes = _Nodes(decode)
    nodes.page(page)
    return pa.RecordBatch.from_arrays(nodes.columns(), names=[c.split()[0] for c in SCHEMA.split(", ")])


def html_nodes(pages: DataFrame, html: str = "html", key: str = "page_id", carried: tuple[str, ...] = (), decode: Callable[[str], str] = unescape) -> DataFrame:
    """page (the key), row, the carried columns and the node columns: a row for each node of each page. decode is what character references become (unescape, closed_references). Select and filter pages before; nothing is pushed below this."""
    kinds = dict(pages.select(F.col(key).alias("page"), *carried).dtypes)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    bounded_batches(pages.sparkSession)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at, rows, nodes, chars = [], [], _Nodes(decode), 0

            def frame() -> pa.RecordBatch:
                kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in kinds]  # noqa: B023
                return pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.int64()), *nodes.columns()], names=[*kinds, "row", *names])  # noqa: B023

            for i, html in enumerate(batch.column("_html")):
                page = html.as_py()
                n = nodes.page(page)
                chars += len(page or "")
                at += [i] * n
                rows += [row] * n
                row += 1
                if len(nodes) >= NODES or chars >= CHARS:
                    yield frame()
                    at, rows, nodes, chars = [], [], _Nodes(decode), 0
                    give_back()
            if len(nodes):
                yield frame()

    given = pages.select(F.col(key).alias("page"), *carried, F.col(html).alias("_html"))
    return given.mapInArrow(explode, ", ".join(f"`{c}` {t}" for c, t in kinds.items()) + f", row long, {SCHEMA}")
