"""One forward pass over a page of HTML: tags, text, open elements, tables.

Every sign is read a bounded number of times, however broken the page is: a comment, a
script or a tag that never ends takes the rest of the page with it, as in a browser.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

# Fixed values of HTML: elements that end the text before them, those that hold no text of the
# page, those that can't hold anything, and how deep browsers nest elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "legend li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
RAW = ("script", "style")
EMPTY = frozenset(["hr"])
DEPTH = 512
WHITE = " \t\n\f\r"
#: The kind of element that text inside these is.
KINDS = {"title": "title", "li": "list_item", "td": "table_cell", "th": "table_cell", "pre": "preformatted", **{f"h{n}": "section_header" for n in range(1, 7)}}
#: What an opening tag ends: the open elements up to one of the first group, if it comes before any of the second.
ENDS = {
    "li": (("li",), ("ul", "ol")),
    "dd": (("dd", "dt"), ("dl",)),
    "dt": (("dd", "dt"), ("dl",)),
    "option": (("option",), ("form",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table",)),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}

_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_STOP = re.compile("[\"'>]")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}


def _tag_end(page: str, at: int) -> int:
    """Where the tag ends; -1 if it doesn't. A quote behind an equals sign goes to its twin."""
    while True:
        found = _STOP.search(page, at)
        if found is None:
            return -1
        if found[0] == ">":
            return found.start()
        at = found.end()
        if page[max(0, found.start() - 64) : found.start()].rstrip(WHITE).endswith("="):
            at = page.find(found[0], at) + 1
            if not at:
                return -1


def events(page: str) -> Iterator[tuple[str, str]]:
    """(kind, value): ``text`` as written, ``open`` and ``close`` with a tag's name in lower case."""
    at, size = 0, len(page)
    while at < size:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:]
            return
        if low > at:
            yield "text", page[at:low]
        tag = _NAME.match(page, low + 1)
        if tag:
            end = _tag_end(page, tag.end())
            if end < 0:
                return
            name, at = tag[2].lower(), end + 1
            yield ("close" if tag[1] else "open"), name
            if name in RAW and not tag[1]:
                stop = _RAW_END[name].search(page, at)
                if stop is None:
                    return
                at = stop.start()
        elif page.startswith("<!--", low):
            end = page.find("-->", low + 2)
            at = size if end < 0 else end + 3
        elif page[low + 1 : low + 2] in ("!", "?", "/"):
            end = page.find(">", low + 2)
            at = size if end < 0 else end + 1
        else:
            yield "text", "<"
            at = low + 1


class Elements:
    """Open elements of a page, and the visible text between block tags as (kind, text, path of open elements)."""

    def __init__(self, page: str) -> None:
        self.open: list[str] = []
        self.found: list[tuple[str, str, tuple[str, ...]]] = []
        self.held: list[str] = []
        #: Cells of all tables: (table, row, column, is a header, text); a cell's text is what stands in it, but for tables of its own.
        self.cells: list[tuple[int, int, int, bool, str]] = []
        self.tables: list[list] = []  # open tables: number, row, column, texts of the open cell
        self.n_tables = 0
        for kind, value in events(page):
            if kind == "text":
                self.held.append(value)
            elif value == "br":
                self.held.append("\n")
            elif value in BLOCKS:
                self._flush()
                (self._opened if kind == "open" else self._closed)(value)
        self._flush()
        while self.open:
            self._pop()

    def _flush(self) -> None:
        text = html.unescape("".join(self.held)).strip(WHITE)
        self.held.clear()
        if not text.strip():
            return
        kind = next((KINDS[name] for name in reversed(self.open) if name in KINDS), "text")
        self.found.append((kind, text, tuple(self.open)))
        if self.tables and self.tables[-1][3] is not None:
            self.tables[-1][3].append(text)

    def _opened(self, name: str) -> None:
        if self.open and (self.open[-1] == "p" or self.open[-1] in KINDS and KINDS[self.open[-1]] == KINDS.get(name) == "section_header"):
            self._pop()
        if name in ENDS:
            ended, fence = ENDS[name]
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k] in fence:
                    break
                if self.open[k] in ended:
                    while len(self.open) > k:
                        self._pop()
                    break
        if name in EMPTY or len(self.open) >= DEPTH:
            return
        self.open.append(name)
        if name == "table":
            self.tables.append([self.n_tables, -1, -1, None])
            self.n_tables += 1
        elif self.tables and name == "tr":
            self.tables[-1][1:3] = self.tables[-1][1] + 1, -1
        elif self.tables and name in ("td", "th"):
            table = self.tables[-1]
            table[1] = max(table[1], 0)
            table[2:] = table[2] + 1, []

    def _closed(self, name: str) -> None:
        if name in self.open:  # DEPTH at most
            while self.open[-1] != name:
                self._pop()
            self._pop()

    def _pop(self) -> None:
        name = self.open.pop()
        if not self.tables:
            return
        table = self.tables[-1]
        if name in ("td", "th") and table[3] is not None:
            self.cells.append((table[0], table[1], table[2], name == "th", "\n".join(table[3])))
            table[3] = None
        elif name == "table":
            self.tables.pop()  # its cells are their own; the cell around it holds what stands beside it
