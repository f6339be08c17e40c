"""Web pages that lie in a table: cells of their HTML tables and the text of their elements.

Each page is read inside one task; nothing is shuffled. The parser is the standard library's.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
# An element of a key's kind ends when one of its values starts.
ENDED_BY = {
    "p": {"p", "div", "table", "ul", "ol", "article", "footer"},
    "li": {"li"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
    "option": {"option"},
}
# The bounds of spans in the HTML standard.
MOST_SPANNED = {"colspan": 1000, "rowspan": 65534}
ROWS_AT_ONCE = 5_000


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.text = tag, attrs, []


class _Walker(HTMLParser):
    """Keeps the stack of open elements; records every wanted one with its whole inner text."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.open, self.found = wanted, [], []

    def handle_starttag(self, tag, attrs):
        while self.open and tag in ENDED_BY.get(self.open[-1].tag, ()):
            self.open.pop()
        node = _Node(tag, dict(attrs))
        if tag in self.wanted:
            self.found.append((node, list(self.open)))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.open and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        if any(node.tag == tag for node in self.open):
            while self.open.pop().tag != tag:
                pass

    def handle_data(self, data):
        for node in self.open:
            if node.tag in self.wanted:
                node.text.append(data)


def _walk(html: str, wanted: set[str]) -> list[tuple[_Node, list[_Node]]]:
    walker = _Walker(wanted)
    walker.feed(html)
    walker.close()
    return walker.found


def _text(node: _Node) -> str:
    return "".join(node.text)


def _below(path: list[str], ancestors: list[_Node]) -> bool:
    """Whether the innermost ancestors are ``path``: tag names, or ``#id``."""
    tail = ancestors[len(ancestors) - len(path) :]
    return len(tail) == len(path) and all(
        node.attrs.get("id") == step[1:] if step[0] == "#" else node.tag == step
        for step, node in zip(path, tail)
    )


def _span(node: _Node, name: str) -> int:
    """A cell's span; the HTML standard reads columns beyond its bound as the bound."""
    value = node.attrs.get(name) or "1"
    if not (value.isascii() and value.isdigit()):
        return 1
    return min(max(1, int(value[:9])), MOST_SPANNED[name])


def _tables(html: str, path: list[str]) -> Iterator[tuple[int, int, bool, list[str | None]]]:
    """(table, row, all-header, cells); spans repeat their text and short rows end in nulls."""
    tables: dict[int, list[list[_Node]]] = {}
    for node, ancestors in _walk(html, {"table", "tr", "td", "th"}):
        if node.tag == "table":
            if _below(path, ancestors):
                tables[id(node)] = []
            continue
        owner = next((id(a) for a in reversed(ancestors) if a.tag == "table"), None)
        if owner in tables:
            if node.tag == "tr":
                tables[owner].append([])
            elif tables[owner]:
                tables[owner][-1].append(node)
    for number, rows in enumerate(tables.values()):
        grid: dict[tuple[int, int], str] = {}
        for r, row in enumerate(rows):
            c = 0
            for cell in row:
                while (r, c) in grid:
                    c += 1
                for dr in range(min(_span(cell, "rowspan"), len(rows) - r)):
                    for dc in range(_span(cell, "colspan")):
                        grid[r + dr, c + dc] = _text(cell).strip()
        width = 1 + max((c for _, c in grid), default=-1)
        for r, row in enumerate(rows):
            header = bool(row) and all(cell.tag == "th" for cell in row)
            yield number, r, header, [grid.get((r, c)) for c in range(width)]


def html_tables(
    pages: DataFrame, key: str, html: str = "html", which: int | None = None, path: list[str] | None = None
) -> DataFrame:
    """Rows of the tables of each page: ``(key, table_no, row_no, cells)``.

    ``which`` picks one table per page, from the end when negative. ``path`` keeps only tables right
    below these elements, outermost first. A first row of header cells is left out.
    """
    steps = list(path or [])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_key, page in zip(batch[key], batch[html]):
                cells = list(_tables(page or "", steps))
                last = max((table for table, *_ in cells), default=-1)
                keep = None if which is None else which if which >= 0 else last + 1 + which
                rows += [
                    (page_key, table, row, values)
                    for table, row, header, values in cells
                    if keep in (None, table) and not (header and row == 0)
                ]
                if len(rows) >= ROWS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=[key, "table_no", "row_no", "cells"])
                    rows = []
            yield pd.DataFrame(rows, columns=[key, "table_no", "row_no", "cells"])

    key_type = pages.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, table_no int, row_no int, cells array<string>"
    return pages.select(key, html).mapInPandas(parse, schema)


def html_text(pages: DataFrame, key: str, tag: str, html: str = "html", index: int | None = None) -> DataFrame:
    """Inner text of every ``tag`` element in page order: ``(key, pos, text)``, ``pos`` from 1.

    ``index`` keeps one position per page.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_key, page in zip(batch[key], batch[html]):
                rows += [
                    (page_key, pos, _text(node))
                    for pos, (node, _) in enumerate(_walk(page or "", {tag}), start=1)
                    if index in (None, pos)
                ]
                if len(rows) >= ROWS_AT_ONCE:
                    yield pd.DataFrame(rows, columns=[key, "pos", "text"])
                    rows = []
            yield pd.DataFrame(rows, columns=[key, "pos", "text"])

    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(parse, f"`{key}` {key_type}, pos int, text string")


def name_cells(rows: DataFrame, names: list[str]) -> DataFrame:
    """Turn the ``cells`` array into named columns by position."""
    others = [c for c in rows.columns if c != "cells"]
    return rows.select(*others, *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
