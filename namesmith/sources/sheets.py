"""XLSX workbooks as a source and a sink, by the standard library: a workbook is a zip archive of XML parts.

Reading is distributed by file: Spark lists the workbooks and brings their bytes, so any path that Spark reads will do, and
a sheet is parsed row by row. Writing is for deliverables: rows come to the driver one partition at a time, are streamed
into the archive and never held as a whole, and go on to a further sheet where one is full.
"""

from __future__ import annotations

import io
import os
import re
import tempfile
import warnings
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import _hadoop, ship

#: Rows of a sheet, by the format.
SHEET_ROWS = 1_048_576
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def _column(reference: str) -> int:
    """0 for A1, 27 for AB7."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _texts(element) -> str:
    """The text of a string item; phonetic hints aside."""
    return "".join(t.text or "" for part in element for t in ([part] if part.tag == f"{_MAIN}t" else part.iter(f"{_MAIN}t")) if part.tag != f"{_MAIN}rPh")


def sheet_rows(data: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Cells of every row of a sheet (the first if no name is given) as text; empty cells are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = next((links[s.get(_REL)] for s in sheets if sheet is None or s.get("name") == sheet), None)
        if target is None:
            raise ValueError(f"no sheet {sheet}")
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                for _, e in ElementTree.iterparse(part):
                    if e.tag == f"{_MAIN}si":
                        shared.append(_texts(e))
                        e.clear()
        with book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as part:
            for _, e in ElementTree.iterparse(part):
                if e.tag != f"{_MAIN}row":
                    continue
                cells: list[str | None] = []
                for c in e.iter(f"{_MAIN}c"):
                    at = _column(c.get("r") or "") if c.get("r") else len(cells)
                    cells += [None] * (at + 1 - len(cells))
                    value, kind = c.find(f"{_MAIN}v"), c.get("t")
                    if kind == "inlineStr":
                        inner = c.find(f"{_MAIN}is")
                        cells[at] = None if inner is None else _texts(inner)
                    elif value is not None and value.text is not None:
                        cells[at] = shared[int(value.text)] if kind == "s" else {"1": "True", "0": "False"}[value.text] if kind == "b" else value.text
                yield cells
                e.clear()


def read_xlsx(spark: SparkSession, path: str, header: str = "nombre_original", sheet: str | None = None) -> DataFrame:
    """``(archivo, fila, texto)``: the first column below its header, empty cells as empty texts; another header is an error."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = sheet_rows(data.as_py(), sheet)
                first = next(rows, [])
                if not first or first[0] != header:
                    raise ValueError(f"column {header} expected, found {first}")
                out: list[str] = []
                at = 0
                for cells in rows:
                    out.append((cells[0] if cells else None) or "")
                    if len(out) == 10000:
                        yield _rows(name, at, out)
                        at, out = at + len(out), []
                if out:
                    yield _rows(name, at, out)

    def _rows(name, at, out):
        return pa.RecordBatch.from_pydict({"archivo": pa.array([name] * len(out)), "fila": pa.array(range(at, at + len(out)), pa.int64()), "texto": pa.array(out, pa.string())})

    files = ship(spark).read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "archivo string, fila long, texto string")


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_ILLEGAL.sub("", str(value)))}</t></is></c>'


def write_workbook(rows: Iterator, columns: list[str], file, sheet: str, limit: int = SHEET_ROWS) -> int:
    """Streams rows into a workbook, header first, frozen and with a filter; how many rows it wrote."""
    names, n = [], 0
    rows = iter(rows)
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as book:
        more = True
        pending = None
        while more:
            names.append(sheet if not names else f"{sheet}_{len(names) + 1}")
            with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w", force_zip64=True) as part:
                put = lambda x: part.write(x.encode("utf-8", "replace"))  # noqa: B023, E731
                put('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><sheetData>')
                put("<row>" + "".join(map(_cell, columns)) + "</row>")
                held, more = 1, False
                for row in ([pending] if pending is not None else []):
                    put("<row>" + "".join(map(_cell, row)) + "</row>")
                    held, n = held + 1, n + 1
                pending = None
                for row in rows:
                    if held == limit:
                        pending, more = row, True
                        break
                    put("<row>" + "".join(map(_cell, row)) + "</row>")
                    held, n = held + 1, n + 1
                last = ""
                k = len(columns)
                while k:
                    k, r = divmod(k - 1, 26)
                    last = chr(65 + r) + last
                put(f'</sheetData><autoFilter ref="A1:{last}{held}"/></worksheet>')
        part_name = lambda k: f"/xl/worksheets/sheet{k}.xml"
        book.writestr("xl/workbook.xml", '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{escape(x)}" sheetId="{k}" r:id="rId{k}"/>' for k, x in enumerate(names, 1)) + "</sheets></workbook>")
        book.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1)) + "</Relationships>")
        book.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("[Content_Types].xml", '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(f'<Override PartName="{part_name(k)}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1)) + "</Types>")
    return n


def write_xlsx(df: DataFrame, path: str, sheet: str = "resultado", limit: int = SHEET_ROWS) -> int | None:
    """One workbook at a path of any file system; rows written, or null and a warning if the target is locked."""
    with tempfile.NamedTemporaryFile(suffix=".xlsx", delete=False) as file:
        n = write_workbook(df.toLocalIterator(), df.columns, file, sheet, limit)
    try:
        system, target = _hadoop(df.sparkSession, path)
        system.copyFromLocalFile(True, True, df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path("file://" + file.name), target)
    except Exception as e:
        if os.path.exists(file.name):
            os.unlink(file.name)
        if "AccessControl" in str(e) or "Permission denied" in str(e) or "AlreadyBeingCreated" in str(e):
            warnings.warn(f"{path} is locked and stays as it was", stacklevel=2)
            return None
        raise
    return n
