"""Workbooks as rows of cells, read on the executors straight from the zipped XML.

One workbook is one task's work, as its file is one record; rows leave in batches.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
SCHEMA = "path string, sheet string, sheet_no int, row_no int, cells array<string>"


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(e) -> str:
    return "".join(t.text or "" for t in e.iter(f"{_NS}t"))


def sheets(content: bytes) -> Iterator[tuple[str, int, Iterator[tuple[int, list[str | None]]]]]:
    """(name, number, rows) of every sheet; rows are (row number from 1, cells)."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared = [_text(e) for e in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in book.namelist() else []
    targets = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}

    def rows(name: str) -> Iterator[tuple[int, list[str | None]]]:
        at = 0
        for _, e in ElementTree.iterparse(book.open(name)):
            if e.tag != f"{_NS}row":
                continue
            at, cells = int(e.get("r") or at + 1), []
            for c in e.iter(f"{_NS}c"):
                i, kind, v = _column(c.get("r")) if c.get("r") else len(cells), c.get("t"), c.find(f"{_NS}v")
                value = _text(c) if kind == "inlineStr" else None if v is None or v.text is None else shared[int(v.text)] if kind == "s" else v.text
                cells += [None] * (i + 1 - len(cells))
                cells[i] = value
            yield at, cells
            e.clear()

    for no, s in enumerate(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet")):
        target = targets[s.get(_REL)]
        yield s.get("name"), no, rows(target if target.startswith("xl/") else f"xl/{target}")


def read_workbooks(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, sheet, sheet_no, row_no, cells) of all .xlsx files under root; unreadable files are skipped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    for name, no, rows in sheets(content):
                        held: list[tuple] = []
                        for r in rows:
                            held.append((path, name, no, *r))
                            if len(held) == 5_000:
                                yield pd.DataFrame(held, columns=["path", "sheet", "sheet_no", "row_no", "cells"])
                                held = []
                        if held:
                            yield pd.DataFrame(held, columns=["path", "sheet", "sheet_no", "row_no", "cells"])
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, ValueError):
                    continue

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", str(recursive).lower()).load(root)
    return files.select("path", "content").mapInPandas(run, SCHEMA)


_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
#: Rows that a sheet can hold.
MOST_ROWS = 1_048_576
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff\ud800-\udfff]")


def _letters(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


class _Book:
    """A workbook of one sheet, written row by row; it appears under its name when it is complete."""

    def __init__(self, path: str, sheet: str) -> None:
        self.path, self.tmp, self.rows = path, f"{path}.{uuid.uuid4().hex}", 0
        self.zip = zipfile.ZipFile(self.tmp, "w", zipfile.ZIP_DEFLATED)
        book = f'<workbook xmlns="{_NS[1:-1]}" xmlns:r="{_REL[1:].split("}")[0]}"><sheets><sheet name={quoteattr(sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>'
        for name, text in {**_PARTS, "xl/workbook.xml": book}.items():
            self.zip.writestr(name, text)
        self.out = self.zip.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.out.write(f'<worksheet xmlns="{_NS[1:-1]}"><sheetData>'.encode())

    def add(self, row_no: int, cells: list[str | None]) -> None:
        self.rows += 1
        if row_no > MOST_ROWS:
            raise ValueError(f"{self.path}: a sheet holds {MOST_ROWS} rows")
        said = (f'<c r="{_letters(i)}{row_no}" t="inlineStr"><is><t xml:space="preserve">{escape(_ILLEGAL.sub("", v), {chr(13): "&#13;"})}</t></is></c>' for i, v in enumerate(cells) if v is not None)
        self.out.write(f'<row r="{row_no}">{"".join(said)}</row>'.encode())

    def close(self) -> None:
        self.out.write(b"</sheetData></worksheet>")
        self.out.close()
        self.zip.close()
        os.replace(self.tmp, self.path)


def write_workbooks(rows: DataFrame, folder: str, sheet: str = "Sheet1") -> DataFrame:
    """(book, n_rows) of the workbooks written to a folder that all executors share; rows(book, row_no, cells).

    A workbook is one file, so one task writes it, row by row as they come sorted; larger tables are
    given as several books. A task that runs again writes the same file.
    """
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, book = None, None
        for b in batches:
            for n, no, cells in zip(b["book"], b["row_no"], b["cells"]):
                if n != name:
                    if book:
                        book.close()
                        yield pd.DataFrame({"book": [name], "n_rows": [book.rows]})
                    name, book = n, _Book(os.path.join(folder, f"{n}.xlsx"), sheet)
                book.add(int(no), list(cells))
        if book:
            book.close()
            yield pd.DataFrame({"book": [name], "n_rows": [book.rows]})

    ordered = rows.select(F.col("book").cast("string").alias("book"), F.col("row_no").cast("long").alias("row_no"), "cells").repartition("book").sortWithinPartitions("book", "row_no")
    return ordered.mapInPandas(run, "book string, n_rows long")


def with_header(rows: DataFrame, required: list[str], candidates: tuple[int, ...] = (2, 1), least: int | None = None) -> DataFrame:
    """(path, sheet, row_no, fields map): data rows under the first candidate row that names `least` of the required columns.

    Sheets for which no candidate does fall back to the last one; sheets without any of them are left out.
    """
    least = len(required) if least is None else least
    want = F.array(*map(F.lit, required))
    heads = rows.where(F.col("row_no").isin(*candidates)).withColumn("n", F.size(F.array_intersect(F.transform("cells", lambda c: F.trim(F.coalesce(c, F.lit("")))), want)))
    order = F.when(F.col("n") >= least, -F.array_position(F.array(*map(F.lit, candidates)), F.col("row_no"))).otherwise(F.when(F.col("row_no") == candidates[-1], -100).otherwise(-1000))
    head = heads.groupBy("path", "sheet").agg(F.max_by(F.struct("row_no", "cells", "n"), order).alias("h")).where("h.n > 0")
    data = rows.join(head, ["path", "sheet"]).where(F.col("row_no") > F.col("h.row_no"))
    pair = F.arrays_zip(F.transform("h.cells", lambda c: F.trim(F.coalesce(c, F.lit("")))).alias("k"), F.col("cells").alias("v"))
    named = F.filter(pair, lambda e, i: F.coalesce(e["k"] != "", F.lit(False)) & ~F.exists(F.filter(pair, lambda x, j: j > i), lambda x: x["k"] == e["k"]))
    return data.select("path", "sheet", "row_no", F.map_from_entries(F.transform(named, lambda e: F.struct(e["k"], e["v"]))).alias("fields"))
