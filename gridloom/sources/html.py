"""Tables and embedded objects of HTML pages, parsed page by page in Arrow batches with the standard library."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.relational import prefer_side


class TableReader(HTMLParser):
    """Rows of all tables of a page, also of tables inside comments; cells carry their text and first link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str], list[str]]] = []
        self.table = -1
        self._counted: dict[int, int] = {}
        self._cells: list[str] | None = None
        self._links: list[str] = []
        self._text: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "table":
            self.table += 1
        elif tag == "tr":
            self._cells, self._links = [], []
        elif tag in ("td", "th") and self._cells is not None:
            self._close_cell()
            self._text = []
            self._links.append("")
        elif tag == "a" and self._text is not None and self._links and not self._links[-1]:
            self._links[-1] = dict(attrs).get("href") or ""

    def handle_data(self, data: str) -> None:
        if self._text is not None:
            self._text.append(data)

    def handle_comment(self, data: str) -> None:
        if "<table" in data:
            inner = TableReader()
            inner.table = self.table
            inner.feed(data)
            inner.close()
            self.rows += inner.rows
            self.table = inner.table

    def _close_cell(self) -> None:
        if self._text is not None and self._cells is not None:
            self._cells.append(" ".join("".join(self._text).split()))
            self._text = None

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self._close_cell()
        elif tag == "tr" and self._cells is not None:
            self._close_cell()
            if self._cells:
                self.rows.append((self.table, self._counted.get(self.table, 0), self._cells, self._links))
                self._counted[self.table] = self._counted.get(self.table, 0) + 1
            self._cells = None


def embedded_object(page: str, name: str) -> str | None:
    """JSON text of the object that follows ``name`` in a page, null if there is none or it isn't JSON."""
    _, found, after = page.partition(name)
    opening = after.find("{") if found else -1
    if opening < 0:
        return None
    try:
        _, end = json.JSONDecoder().raw_decode(after, opening)
    except ValueError:
        return None
    return after[opening:end]


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row_no, cells, links) of every table row; a page without tables gives none."""
    rows = pages.where(F.col(html).isNotNull()).select(F.col(key).alias("k"), F.col(html).alias("h"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for k, page in zip(batch["k"], batch["h"], strict=True):
                reader = TableReader()
                reader.feed(page)
                reader.close()
                found += [(k, *row) for row in reader.rows]
            yield pd.DataFrame(found, columns=["k", "table_no", "row_no", "cells", "links"])

    kind = dict(rows.dtypes)["k"]
    out = rows.mapInPandas(read, f"k {kind}, table_no int, row_no int, cells array<string>, links array<string>")
    return out.withColumnRenamed("k", key)


def embedded_objects(pages: DataFrame, key: str, html: str, name: str) -> DataFrame:
    """(key, object): the embedded object's JSON text per page, null where it is missing or broken."""
    rows = pages.select(F.col(key).alias("k"), F.coalesce(F.col(html), F.lit("")).alias("h"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(k, embedded_object(page, name)) for k, page in zip(batch["k"], batch["h"], strict=True)]
            yield pd.DataFrame(found, columns=["k", "object"])

    kind = dict(rows.dtypes)["k"]
    return rows.mapInPandas(read, f"k {kind}, object string").withColumnRenamed("k", key)


def linked_amounts(rows: DataFrame, key: str) -> DataFrame:
    """(key, table_no, name, amount) of table rows: the first cell with a link and the first cell that is an amount of money.

    Rows without either, such as totals, are left out; of a name listed twice in a table the last row counts.
    """
    pairs = F.arrays_zip(F.col("cells").alias("cell"), F.col("links").alias("link"))
    named = F.get(F.filter(pairs, lambda p: (p["link"] != "") & (p["cell"] != "")), F.lit(0))["cell"]
    amount = F.get(F.filter("cells", lambda c: c.startswith("$")), F.lit(0))
    found = rows.select(key, "table_no", "row_no", named.alias("name"), amount.alias("amount")).where("name IS NOT NULL AND amount IS NOT NULL")
    return found.groupBy(key, "table_no", "name").agg(F.max_by("amount", "row_no").alias("amount"))


def first_listed(tables: Sequence[tuple[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """All rows of the first table and those of each later table whose key no earlier one has, with ``listed_in``."""
    found = None
    for label, rows in tables:
        marked = rows.withColumn("listed_in", F.lit(label))
        found = marked if found is None else prefer_side(found, marked, keys)
    if found is None:
        raise ValueError("no tables")
    return found
