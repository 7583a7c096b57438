"""Registry pages: HTML tables to raw records, header names, page discovery, page URLs."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlode.functions.text import filled, fold, nfkc, normalize
from gridlode.functions.values import power, registry_date

# Fields by what their header text contains, in the order in which they are tried.
HEADERS = (
    ("tu_number", ("номер ту",)),
    ("tu_date", ("дата видачі ту", "дата видачи ту")),
    ("contract_number", ("№ договору", "no договору", "номер договору")),
    ("contract_date", ("дата договору",)),
    ("installation_type", ("тип електроустановки",)),
    ("commissioning_stages", ("черги введення потужності",)),
    ("connection_point_raw", ("точка забезпечення потужності",)),
    ("voltage_raw", ("напруга в точці приєднання",)),
    ("requested_power_kw", ("потужність замовлена до приєднання",)),
    ("connection_type", ("тип приєднання",)),
    ("rem", ("назва територіальної одиниці оср",)),
    ("payment_date", ("дата надходження коштів",)),
)


class TableReader(HTMLParser):
    """Rows of a page's first table: (in thead, cell texts), nested rows as rows of their own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.done, self.head = 0, False, 0
        self.rows: list[tuple[bool, list[list[str]]]] = []
        self.open: list[int] = []  # rows that are open, innermost last
        self.cell: list[list[str]] = []  # cells that are open

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth:
            if tag == "thead" and self.depth == 1:
                self.head += 1
            elif tag == "tr":
                self.rows.append((self.head > 0, []))
                self.open.append(len(self.rows) - 1)
            elif tag in ("td", "th") and self.open:
                self.rows[self.open[-1]][1].append([])
                self.cell.append(self.rows[self.open[-1]][1][-1])

    def handle_endtag(self, tag: str) -> None:
        if self.done or not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            self.done = self.depth == 0
        elif tag == "thead":
            self.head = max(0, self.head - 1)
        elif tag == "tr" and self.open:
            self.open.pop()
        elif tag in ("td", "th") and self.cell:
            self.cell.pop()

    def handle_data(self, data: str) -> None:
        text = data.strip()
        if text and not self.done:
            for cell in self.cell:
                cell.append(text)


def table_rows(html: str | None) -> tuple[list[str], list[tuple[int, list[str]]]]:
    """Header texts, and (index, cell texts) of each body row that has cells; indexes count all body rows."""
    reader = TableReader()
    reader.feed(html or "")
    reader.close()
    if not reader.rows:
        return [], []
    head = next((n for n, (inside, _) in enumerate(reader.rows) if inside), 0)
    texts = [[" ".join(parts) for parts in cells] for _, cells in reader.rows]
    body = [cells for n, cells in enumerate(texts) if n != head]
    return texts[head], [(n, cells) for n, cells in enumerate(body, 1) if cells]


_CELLS = pa.list_(pa.string())
_ROWS = pa.list_(pa.struct([("source_row_index", pa.int32()), ("cells", _CELLS)]))
_TABLES = "source_url string, source_page int, fetched_at timestamp, header array<string>, rows array<struct<source_row_index:int, cells:array<string>>>"


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages to their header, once each, and rows."""
    for batch in batches:
        found = [table_rows(html.as_py()) for html in batch.column(3)]
        rows = [[{"source_row_index": n, "cells": cells} for n, cells in rows] for _, rows in found]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([h for h, _ in found], _CELLS), pa.array(rows, _ROWS)], names=["source_url", "source_page", "fetched_at", "header", "rows"])


def _key(low: Column) -> Column:
    out = None
    for key, markers in HEADERS:
        for marker in markers:
            found = F.contains(low, F.lit(marker))
            out = F.when(found, key) if out is None else out.when(found, key)
    return out


def header_key(text: Column) -> Column:
    """The field that a header text names, else null."""
    return _key(F.lower(normalize(text)))


def table_records(pages: DataFrame, source: str) -> DataFrame:
    """Raw records of pages (html, source_url, source_page, fetched_at).

    Cells in excess of the headers shift the fields to the right. The last of
    two headers for a field counts. An empty cell is null. Header texts, cells
    and dates are normalized in one pass over the joined cells.
    """
    sep = "\u001f"
    read = pages.select(F.col("source_url").cast("string").alias("source_url"), F.col("source_page").cast("int").alias("source_page"), F.col("fetched_at").cast("timestamp").alias("fetched_at"), "html")
    read = read.mapInArrow(_tables, _TABLES).withColumn("header", F.split(nfkc(F.array_join("header", sep)), sep))
    keys = F.transform(F.transform("header", lambda h: F.lower(fold(h))), lambda h: F.coalesce(_key(h), F.lit("")))
    rows = read.withColumn("keys", keys).select("source_url", "source_page", "fetched_at", "keys", F.size("header").alias("headers"), F.explode("rows").alias("r")).select("*", "r.*")
    # one Python visit for all of a row's text: unit separators keep the cells apart
    rows = rows.withColumn("cells", F.transform(F.split(nfkc(F.array_join("cells", sep)), sep), fold)).withColumn("shift", F.greatest(F.lit(0), F.size("cells") - F.col("headers")))
    place = {key: F.size("keys") - F.array_position(F.reverse("keys"), F.lit(key)) for key, _ in HEADERS}

    def cell(key: str) -> Column:
        there = F.array_contains("keys", F.lit(key))
        return F.when(there, filled(F.get("cells", (place[key] + F.col("shift")).cast("int"))))

    plain = [k for k, _ in HEADERS if k not in ("tu_date", "requested_power_kw")]
    return rows.select(
        F.lit(source).alias("source"), "source_url", F.col("source_page").cast("int").alias("source_page"), "source_row_index", "fetched_at",
        *(cell(k).alias(k) for k in plain), registry_date(cell("tu_date")).alias("tu_date"), power(cell("requested_power_kw")).alias("requested_power_kw"),
    )


_LINK = r"(?is)<a\s[^>]*?href\s*=\s*[\"'][^\"']*[?&](?:amp;)?page=(\d+)"
_LABEL = r"(?is)<a\s[^>]*?href\s*=[^>]*>\s*(\d+)\s*</a>"


def last_linked(html: str, fallback: int = 1) -> int:
    """last_page() of one page that is at hand."""
    return max([fallback, *(int(n) for p in (_LINK, _LABEL) for n in re.findall(p, html))])


def last_page(html: Column, fallback: int = 1) -> Column:
    """The largest page number that a page links to, by address or by label."""
    links = F.regexp_extract_all(html, F.lit(_LINK), 1)
    labels = F.regexp_extract_all(html, F.lit(_LABEL), 1)
    found = F.transform(F.concat(links, labels), lambda x: x.try_cast("bigint"))
    return F.greatest(F.lit(fallback).cast("bigint"), F.array_max(F.array_compact(found)))


def page_url(base: str, page: int) -> str:
    """base with its query's page set; other parameters stay, the last of a name."""
    parts = urlsplit(base)
    query = dict(parse_qsl(parts.query, keep_blank_values=True)) | {"page": str(page)}
    return urlunsplit(parts._replace(query=urlencode(query)))


