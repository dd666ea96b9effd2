"""Workbook feeds: XLSX bytes to raw feed rows, one workbook per task slot, many in parallel.

Spark has no reader for this format, so the archive is opened inside `mapInPandas` with the standard library; rows leave
in chunks as they are read."""
from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from datetime import date, timedelta
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough.functions.text import standard_header
from sellthrough.sources.layout import ambiguous, column_positions, empty_feed, from_cells

HEADER_SEARCH_ROWS = 10
CHUNK_ROWS = 5000
NO_HEADER = f"none of the first {HEADER_SEARCH_ROWS} rows is a header with a week"
# Built-in number formats that show a date.
DATE_FORMATS = {14, 15, 16, 17, 22, *range(27, 37), *range(50, 59)}
SHEET_ROWS = "source_file string, names array<string>, cells array<string>, header_error string"


def _tag(element) -> str:
    return element.tag.rpartition("}")[2]


def _part(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show a date."""
    styles = _part(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter() if _tag(f) == "numFmt"}
    found = set()
    for cell_formats in (e for e in styles if _tag(e) == "cellXfs"):
        for i, xf in enumerate(cell_formats):
            fmt = int(xf.get("numFmtId", 0))
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get(fmt, "")).lower()
            if fmt in DATE_FORMATS or re.search(r"[ymd]", code):
                found.add(i)
    return found


def _column(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    """Path of the first sheet's part, and whether day numbers count from 1904."""
    workbook, rels = _part(book, "xl/workbook.xml"), _part(book, "xl/_rels/workbook.xml.rels")
    from_1904 = any(_tag(e) == "workbookPr" and e.get("date1904") in ("1", "true") for e in workbook.iter())
    sheet = next(e for e in workbook.iter() if _tag(e) == "sheet")
    rel_id = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    target = next(r.get("Target") for r in rels if r.get("Id") == rel_id)
    return (target.lstrip("/") if target.startswith("/") else f"xl/{target}"), from_1904


def _cell_text(cell, shared: list[str], date_styles: set[int], epoch: date) -> str:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter() if _tag(t) == "t")
    value = next((v.text for v in cell if _tag(v) == "v"), None)
    if value is None or kind == "e":
        return ""
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "d":
        return value[:10]
    if kind != "n":
        return value
    number = float(value)
    if int(cell.get("s", 0)) in date_styles:
        return (epoch + timedelta(days=int(number))).isoformat()
    return str(int(number)) if number == int(number) else str(number)


def _sheet_rows(content: bytes) -> Iterator[tuple[int, list[str]]]:
    """(row number from 1, cells by position); blank cells are ''."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = _part(book, "xl/sharedStrings.xml")
        shared = [] if strings is None else [
            "".join(t.text or "" for t in si.iter() if _tag(t) == "t") for si in strings]
        date_styles = _date_styles(book)
        sheet, from_1904 = _first_sheet(book)
        epoch = date(1904, 1, 1) if from_1904 else date(1899, 12, 30)
        row_no = 0
        with book.open(sheet) as xml:
            for _, row in ElementTree.iterparse(xml):
                if _tag(row) != "row":
                    continue
                row_no = int(row.get("r", row_no + 1))
                cells: list[str] = []
                for cell in (c for c in row if _tag(c) == "c"):
                    at = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                    cells.extend([""] * (at - len(cells)))
                    cells.append(_cell_text(cell, shared, date_styles, epoch))
                yield row_no, cells
                row.clear()


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(path, names, chunk, error=None):
        return pd.DataFrame({"source_file": [path] * len(chunk), "names": [names] * len(chunk), "cells": chunk,
                             "header_error": [error] * len(chunk)})

    for batch in batches:
        for path, content in zip(batch["source_file"], batch["content"]):
            names, chunk, broken = None, [], None
            rows = _sheet_rows(content)
            while True:
                try:
                    row_no, cells = next(rows)
                except StopIteration:
                    break
                except (zipfile.BadZipFile, ElementTree.ParseError, zlib.error, RuntimeError, LookupError, TypeError, ValueError, AttributeError,
                        NotImplementedError, EOFError) as error:
                    broken = f"{type(error).__name__}: {error}"     # the file's fault, whatever is wrong inside
                    break
                if names is None:
                    if row_no > HEADER_SEARCH_ROWS:
                        break
                    candidate = list(map(standard_header, cells))
                    if "week_date" in candidate:
                        names = candidate
                    continue
                # Cells beside the table are notes.
                chunk.append((cells + [""] * (len(names) - len(cells)))[:len(names)])
                if len(chunk) == CHUNK_ROWS:
                    yield frame(path, names, chunk)
                    chunk = []
            if broken:
                yield frame(path, [], [[]], f"the workbook cannot be read: {broken}")
            elif names is None:
                yield frame(path, [], [[]], NO_HEADER)
            elif chunk:
                yield frame(path, names, chunk)


def decode_workbooks(books: DataFrame) -> DataFrame:
    """(source_file, content binary) to raw feed rows."""
    rows = books.select("source_file", "content").mapInPandas(_decode, SHEET_ROWS)
    return from_cells(rows.withColumns({
        "layout_error": F.coalesce("header_error", ambiguous(F.col("names"))), "positions": column_positions(F.col("names"))}))


def read_workbook_feed(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return empty_feed(spark)
    books = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return decode_workbooks(books.select(F.col("_metadata.file_path").alias("source_file"), "content"))
