"""Tables and comments inside landed web pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.scale import col

# Fixed value: the HTML standard reads larger column spans as this one.
MAX_COLSPAN = 1000


def html_comments(pages: DataFrame, containing: str | None = None) -> DataFrame:
    """(page_id, comment_no, comment) for every comment of every page."""
    found = F.regexp_extract_all("html", F.lit(r"(?s)<!--(.*?)-->"), F.lit(1))
    rows = pages.select("page_id", F.posexplode(found).alias("comment_no", "comment"))
    return rows if containing is None else rows.filter(F.contains("comment", F.lit(containing)))


class _TableReader(HTMLParser):
    """Cells of the first table (with the given id, when one is named) and the comments seen on the way."""

    def __init__(self, table_id: str | None):
        super().__init__(convert_charrefs=True)
        self.table_id = table_id
        self.cells: list[tuple[int, int, bool, int, int, list[str]]] = []
        self.rows, self.depth, self.done, self.in_cell = -1, 0, False, False
        self.comments: list[tuple[bool, str]] = []
        self.div_depth, self.wrapper = 0, 0

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag == "div":
            self.div_depth += 1
            if self.table_id and not self.wrapper and attrs.get("id") == f"all_{self.table_id}":
                self.wrapper = self.div_depth
        if self.done:
            return
        if tag == "table":
            if self.depth or not self.table_id or attrs.get("id") == self.table_id:
                self.depth += 1
        elif self.depth == 1 and tag == "tr":
            self.rows, self.in_cell = self.rows + 1, False
        elif self.depth == 1 and tag in ("td", "th"):
            span = [int(attrs[k]) if (attrs.get(k) or "").isdigit() else 1 for k in ("rowspan", "colspan")]
            self.cells.append((max(self.rows, 0), len(self.cells), tag == "th", *span, []))
            self.in_cell = True

    def handle_endtag(self, tag):
        if tag == "div":
            if self.wrapper == self.div_depth:
                self.wrapper = -1
            self.div_depth -= 1
        if tag == "table" and self.depth:
            self.depth -= 1
            self.done = self.done or self.depth == 0
        elif tag in ("td", "th", "tr") and self.depth == 1:
            self.in_cell = False

    def handle_data(self, data):
        if self.in_cell and not self.done:
            self.cells[-1][5].append(data)

    def handle_comment(self, data):
        self.comments.append((self.wrapper > 0, data))

    def placed(self) -> Iterator[tuple[int, int, int, int, bool, str]]:
        """Each cell once, with the row and column of its first place and its spans. Rows end where the table does."""
        spanning: list[tuple[int, int, int]] = []  # first column, end column, end row of cells that reach further down
        row, at = -1, 0
        for cell_row, _, head, down, across, text in self.cells:
            if cell_row != row:
                row, at = cell_row, 0
                spanning = sorted(s for s in spanning if s[2] > row)
            for first, end, _ in spanning:
                if first <= at < end:
                    at = end
            last = max(row + 1, min(row + down, self.rows + 1))
            across = min(max(across, 1), MAX_COLSPAN)
            yield row, at, last - row, across, head, " ".join("".join(text).split())
            if last > row + 1:
                spanning.append((at, at + across, last))
            at += across


def _read(html: str, table_id: str) -> list[tuple[int, int, int, int, bool, str]]:
    page = _TableReader(table_id)
    page.feed(html)
    page.close()
    if not page.cells:
        # Not in the page itself: a comment in its wrapper first, then any comment that names it.
        named = [text for _, text in sorted(page.comments, key=lambda c: not c[0]) if table_id in text]
        if not named:
            return []
        page = _TableReader(None)
        page.feed(named[0])
        page.close()
    return list(page.placed())


def html_tables(pages: DataFrame, table_id: str) -> DataFrame:
    """Cells of the named table of each page: (page_id, row_no, col_no, is_header, value)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(i, *cell) for i, html in zip(batch["page_id"], batch["html"]) for cell in _read(html or "", table_id)]
            yield pd.DataFrame(rows, columns=["page_id", "row", "col", "down", "across", "is_header", "value"])

    # Pages that never name the table need no parsing.
    named = pages.select(F.col("page_id").cast("long"), "html").filter(F.contains("html", F.lit(table_id)))
    placed = named.mapInPandas(read, "page_id long, row int, col int, down int, across int, is_header boolean, value string")
    # A cell leaves the worker once; the places it spans are unfolded here.
    rows = placed.withColumn("row_no", F.explode(F.sequence(F.col("row"), F.col("row") + F.col("down") - 1)))
    cells = rows.withColumn("col_no", F.explode(F.sequence(F.col("col"), F.col("col") + F.col("across") - 1)))
    return cells.select("page_id", "row_no", "col_no", "is_header", "value")


def pages_without_table(pages: DataFrame, cells: DataFrame) -> DataFrame:
    return pages.join(cells.select("page_id").distinct(), "page_id", "left_anti")


def table_rows(cells: DataFrame, names: Sequence[str], keys: Sequence[str] = ("page_id", "row_no")) -> DataFrame:
    """One row per table row under positional names; header rows are kept as data."""
    picks = [F.max(F.when(F.col("col_no") == i, F.col("value"))).alias(n) for i, n in enumerate(names)]
    return cells.groupBy(*[col(k) for k in keys]).agg(*picks)
