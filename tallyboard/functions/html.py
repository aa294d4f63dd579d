"""Rows of cells out of HTML, for use inside ``mapInPandas``."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd

CELL_ROWS = "page_id bigint, tag string, row_no int, cells array<string>"


class _Rows(HTMLParser):
    """Collects the text of every cell of every row found inside a container element."""

    def __init__(self, container: str, row: str, cell: str):
        super().__init__(convert_charrefs=True)
        self.container, self.row, self.cell = container, row, cell
        self.depth = 0
        self.rows: list[list[str]] = []
        self.open_row: list[str] | None = None
        self.open_cell: list[str] | None = None

    def close_row(self):
        self.close_cell()
        if self.open_row is not None and any(self.open_row):
            self.rows.append(self.open_row)
        self.open_row = None

    def close_cell(self):
        if self.open_cell is not None and self.open_row is not None:
            self.open_row.append("".join(self.open_cell))
        self.open_cell = None

    def handle_starttag(self, tag, attrs):
        if tag == self.container:
            self.depth += 1
        elif self.depth and tag == self.row:
            self.close_row()
            self.open_row = []
        elif self.open_row is not None and tag == self.cell:
            self.close_cell()
            self.open_cell = []

    def handle_endtag(self, tag):
        if tag == self.cell:
            self.close_cell()
        elif tag == self.row:
            self.close_row()
        elif tag == self.container and self.depth:
            self.close_row()
            self.depth -= 1

    def handle_data(self, data):
        if self.open_cell is not None:
            self.open_cell.append(data)


def extract_rows(html: str, container: str, row: str, cell: str) -> list[list[str]]:
    parser = _Rows(container, row, cell)
    parser.feed(html or "")
    parser.close()
    parser.close_row()
    return parser.rows


def row_mapper(container: str = "tbody", row: str = "tr", cell: str = "td"):
    """A ``mapInPandas`` function over ``(page_id, tag, html)``; rows with no text are dropped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (page_id, tag, number, cells)
                for page_id, tag, html in batch[["page_id", "tag", "html"]].itertuples(index=False)
                for number, cells in enumerate(extract_rows(html, container, row, cell))
            ]
            yield pd.DataFrame(out, columns=["page_id", "tag", "row_no", "cells"])

    return run
