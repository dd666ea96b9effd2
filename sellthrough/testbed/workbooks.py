"""Sell rows as XLSX bytes, for the workbook reader's query and tests. One workbook per Arrow batch, so its size is
bounded by the batch and their number grows with the rows."""
from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import date
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

HEADER = ("Week Date", "Retailer", "Client", "Store", "Style", "Color", "Size", "Sales $", "Inventory Units")
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook_bytes(rows: list[tuple]) -> bytes:
    """Rows of str, int, float or date (None = no cell) as a one-sheet workbook."""
    strings: dict[str, int] = {}

    def cell(value, at: str) -> str:
        if value is None:
            return ""
        if isinstance(value, date):
            return f'<c r="{at}" s="1"><v>{(value - date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, str):
            return f'<c r="{at}" t="s"><v>{strings.setdefault(value, len(strings))}</v></c>'
        return f'<c r="{at}"><v>{value!r}</v></c>'

    lines = "".join(f'<row r="{i}">' + "".join(cell(v, f"{chr(65 + j)}{i}") for j, v in enumerate(row)) + "</row>"
                    for i, row in enumerate(rows, 1))
    parts = {
        "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_REL}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {_NS}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {_NS}><sheetData>{lines}</sheetData></worksheet>",
        "xl/sharedStrings.xml": f"<sst {_NS}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return out.getvalue()


def _encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for no, batch in enumerate(batches):
        if len(batch):
            rows = [("Weekly sell-through",), HEADER, *batch.itertuples(index=False, name=None)]
            yield pd.DataFrame({"source_file": [f"book{no}.xlsx"], "content": [workbook_bytes(rows)]})


def encode_workbooks(rows: DataFrame) -> DataFrame:
    """(source_file, content): sell rows in the sku workbook layout, a title row above the header."""
    cells = rows.select("week_date", "retailer_id", "client_id", F.col("store").cast("string").alias("store"), "style",
                        "color", "size", F.col("sales").cast("double").alias("sales"), "inventory")
    return cells.mapInPandas(_encode, "source_file string, content binary")


def write_workbooks(rows: DataFrame, folder: str) -> list[str]:
    """Sell rows as workbook files below a shared folder, written by the executors: their paths. A repeated task writes its files again."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        place = folder if "://" in folder else "file://" + folder.removeprefix("file:")
        files, path = fs.FileSystem.from_uri(place)
        files.create_dir(path)
        task = TaskContext.get().partitionId()
        for batch in batches:
            names = []
            for name, content in zip(batch["source_file"], batch["content"]):
                names.append(f"task{task}_{name}")
                with files.open_output_stream(f"{path}/{names[-1]}") as out:
                    out.write(content)
            yield pd.DataFrame({"name": names})

    return sorted(f"{folder}/{r.name}" for r in encode_workbooks(rows).mapInPandas(write, "name string").collect())
