"""Tables out of HTML pages.

Pages are independent, so this is one ``mapInPandas`` over a table of pages: one output row
per table row, with its cells as an array. Parsing happens page by page inside the task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

ROWS_SCHEMA = "table_id string, table_idx int, row_idx int, is_header boolean, cells array<string>"


class _Cells(HTMLParser):
    """Raw cells (text, columns spanned, rows spanned, heading) of every table of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[tuple[str | None, list[list[list]]]] = []
        self.open: list[list[list[list]]] = []
        self.inside: list[bool] = []

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "table":
            rows: list[list[list]] = []
            self.tables.append((given.get("id"), rows))
            self.open.append(rows)
            self.inside.append(False)
        elif self.open and tag == "tr":
            self.open[-1].append([])
            self.inside[-1] = False
        elif self.open and tag in ("td", "th"):
            if not self.open[-1]:
                self.open[-1].append([])
            self.open[-1][-1].append(["", _span(given, "colspan"), _span(given, "rowspan"), tag == "th"])
            self.inside[-1] = True
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag == "table":
            self.open.pop()
            self.inside.pop()
        elif tag in ("td", "th", "tr"):
            self.inside[-1] = False

    def handle_data(self, data):
        if self.open and self.inside[-1]:
            self.open[-1][-1][-1][0] += data


def _span(attrs: dict[str, str | None], name: str) -> int:
    text = attrs.get(name) or "1"
    return max(int(text), 1) if text.isdigit() else 1


def _grid(rows: list[list[list]]) -> list[tuple[bool, list[str]]]:
    """Rows of plain texts, spanning cells repeated in every place they cover."""
    covered: dict[tuple[int, int], str] = {}
    out = []
    for r, cells in enumerate(rows):
        place = 0
        for text, across, down, _ in cells:
            while (r, place) in covered:
                place += 1
            words = " ".join(text.split())
            for dr in range(min(down, len(rows) - r)):
                for dc in range(across):
                    covered[(r + dr, place + dc)] = words
            place += across
        width = 1 + max((c for row, c in covered if row == r), default=-1)
        heading = bool(cells) and all(cell[3] for cell in cells)
        out.append((heading, [covered.get((r, c), "") for c in range(width)]))
        covered = {k: v for k, v in covered.items() if k[0] > r}
    return out


def html_rows(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Every table row of every page: page id, table id, table and row number (from 1), cells."""
    id_type = dict(pages.dtypes)[page_id]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for key, text in zip(batch[page_id], batch[html]):
                if text is None or "<table" not in text.lower():
                    continue
                parser = _Cells()
                parser.feed(text)
                parser.close()
                for number, (ident, rows) in enumerate(parser.tables, 1):
                    for line, (heading, cells) in enumerate(_grid(rows), 1):
                        found.append((key, ident, number, line, heading, cells))
            names = [page_id, "table_id", "table_idx", "row_idx", "is_header", "cells"]
            yield pd.DataFrame(found, columns=names)

    return pages.select(page_id, html).mapInPandas(parse, f"`{page_id}` {id_type}, {ROWS_SCHEMA}")


def table_columns(rows: DataFrame, which: Column, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Body rows of the chosen table with its cells as named columns; missing cells are NULL."""
    return rows.where(which & ~F.col("is_header")).select(
        *keys, *[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )
