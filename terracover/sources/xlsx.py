"""Spreadsheet source (S1): `spark.read.format("xlsx")`, every cell as text, with the row number `_rid`.

A sheet is one compressed XML stream. Planning goes once over it and notes where rows begin; a task unpacks the stream up
to its own range of rows and parses that range only, and then goes once over the shared strings, of which it keeps
those that its cells name. `_rid` is the row below the header, counted from 0, with the workbook's number in the
bits above 32. Options: path (files or folders by comma, all with the header of the first), headerRow (zero-based, default
9), sheet (zero-based, default 0), rows (of a range, default 20,000).
`df.write.format("xlsx")` writes a folder of workbooks with so many lines before the header, MAX_ROWS rows each at most;
values are written as text, a null as no cell.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .stores import PartsWriter, file_system, listed
from .zipcsv import _Forward

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_ROW = re.compile(rb"<(?:\w+:)?row(?=[\s/>])")
STEP = 1 << 20
MAX_ROWS = 1_000_000


def column_number(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


class Workbook:
    def __init__(self, path: str):
        fs, own = file_system(path)
        self.file = fs.open_input_file(own)
        self.zip = zipfile.ZipFile(self.file)

    def __enter__(self) -> Workbook:
        return self

    def __exit__(self, *_) -> None:
        self.zip.close()
        self.file.close()

    def sheet(self, number: int):
        names = [n for n in self.zip.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
        return self.zip.open(sorted(names, key=lambda n: int(re.search(r"\d+", n)[0]))[number])

    def row_places(self, sheet: int, every: int) -> list[tuple[int, int]]:
        """(byte, rows before it) of the first row and of each so-many-th after it."""
        out, at, tail, seen = [], 0, b"", 0
        with self.sheet(sheet) as f:
            while chunk := f.read(STEP):
                text = tail + chunk
                keep = max(0, len(text) - 64)  # a tag that the chunk's end cuts is found with the next
                last = text.rfind(b"<", keep)
                end = last if last >= 0 else len(text)
                for m in _ROW.finditer(text, 0, end):
                    if seen % every == 0:
                        out.append((at + m.start(), seen))
                    seen += 1
                at, tail = at + end, text[end:]
        return out

    def rows(self, sheet: int, start: int = 0, stop: int | None = None, before: int = 0, first: int = 0) -> Iterator[tuple[int, list]]:
        """(number, cells) of the rows that begin in [start, stop) bytes. A cell is text, None, or the number of a shared string.

        first: where the sheet's first row begins; what stands before it opens the elements around the rows.
        """
        parser = ElementTree.XMLPullParser(["end"])
        with self.sheet(sheet) as f:
            if start:
                parser.feed(f.read(first))
                left = start - first
                while left > 0 and (skipped := len(f.read(min(STEP, left)))):
                    left -= skipped
            at, number = start, before - 1
            while True:
                chunk = f.read(STEP if stop is None else min(STEP, stop - at))
                if chunk:
                    parser.feed(chunk)
                    at += len(chunk)
                for _, e in parser.read_events():
                    if e.tag == _NS + "row":
                        number = int(e.get("r", number + 2)) - 1
                        yield number, self._cells(e)
                        e.clear()
                if not chunk or stop is not None and at >= stop:
                    return

    @staticmethod
    def _cells(row) -> list:
        values: list = []
        for c in row.iter(_NS + "c"):
            k = column_number(c.get("r")) if c.get("r") else len(values)
            values += [None] * (k + 1 - len(values))
            v, kind = c.find(_NS + "v"), c.get("t")
            if kind == "inlineStr":
                values[k] = "".join(t.text or "" for t in c.iter(_NS + "t"))
            elif v is not None and v.text is not None:
                values[k] = int(v.text) if kind == "s" else v.text
        return values

    def shared(self, wanted: set[int]) -> dict[int, str]:
        """The shared strings of these numbers."""
        if not wanted or "xl/sharedStrings.xml" not in self.zip.namelist():
            return {}
        out, k = {}, 0
        for _, e in ElementTree.iterparse(self.zip.open("xl/sharedStrings.xml")):
            if e.tag == _NS + "si":
                if k in wanted:
                    out[k] = "".join(t.text or "" for t in e.iter(_NS + "t"))
                k += 1
                e.clear()
        return out


def header_of(path: str, row: int, sheet: int) -> list[str]:
    with Workbook(path) as book:
        for number, values in book.rows(sheet):
            if number == row:
                known = book.shared({v for v in values if isinstance(v, int)})
                return [re.sub(r"\s+", " ", known[v] if isinstance(v, int) else v or "").strip() or f"_c{j}" for j, v in enumerate(values)]
            if number > row:
                break
    raise ValueError(f"{path} has no row {row}")


class XlsxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _settings(self) -> tuple[list[str], int, int, int]:
        options = {k.lower(): v for k, v in self.options.items()}
        paths = listed(options["path"], ".xlsx")
        if not paths:
            raise ValueError(f"{options['path']} holds no workbook")
        return paths, int(options.get("headerrow", 9)), int(options.get("sheet", 0)), int(options.get("rows", 20_000))

    def schema(self) -> str:
        paths, row, sheet, _ = self._settings()
        return ", ".join(f"`{c}` string" for c in header_of(paths[0], row, sheet)) + ", _rid long"

    def reader(self, schema) -> XlsxReader:
        return XlsxReader(*self._settings(), len(schema.fields) - 1)

    def writer(self, schema, overwrite: bool) -> XlsxWriter:
        options = {k.lower(): v for k, v in self.options.items()}
        return XlsxWriter(options["path"], schema, overwrite, int(options.get("headerrow", 9)))


class Range(InputPartition):
    def __init__(self, book: int, start: int, stop: int | None, before: int, first: int):
        self.book, self.start, self.stop, self.before, self.first = book, start, stop, before, first


class XlsxReader(DataSourceReader):
    def __init__(self, paths: list[str], row: int, sheet: int, every: int, width: int):
        self.paths, self.row, self.sheet, self.every, self.width = paths, row, sheet, every, width

    def partitions(self) -> list[Range]:
        out = []
        for k, path in enumerate(self.paths):
            with Workbook(path) as book:
                places = book.row_places(self.sheet, self.every)
            stops = [*(p for p, _ in places[1:]), None]
            out += [Range(k, start, stop, before, places[0][0]) for (start, before), stop in zip(places, stops, strict=True)]
        return out

    def read(self, partition: Range):
        with Workbook(self.paths[partition.book]) as book:
            own = [(n, v) for n, v in book.rows(self.sheet, partition.start, partition.stop, partition.before, partition.first) if n > self.row and any(x is not None for x in v)]
            known = book.shared({x for _, v in own for x in v if isinstance(x, int)})
        for n, v in own:
            cells = [known[x] if isinstance(x, int) else x for x in v]
            yield (*(cells + [None] * self.width)[: self.width], (partition.book << 32) + n - self.row - 1)


_PARTS = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="1" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}


class XlsxWriter(PartsWriter):
    suffix = ".xlsx"

    def __init__(self, path: str, schema, overwrite: bool, lines: int):
        super().__init__(path, schema, overwrite)
        self.lines = lines

    def parts(self, batches: Iterator[pa.RecordBatch], open_file) -> None:
        rows = ([None if v is None else str(v) for v in row.values()] for b in batches for row in b.to_pylist())
        row = next(rows, None)
        while True:
            with open_file() as file, zipfile.ZipFile(_Forward(file), "w", zipfile.ZIP_DEFLATED) as z:
                for name, text in _PARTS.items():
                    z.writestr(name, text)
                with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as raw, io.TextIOWrapper(raw, "utf-8") as out:
                    out.write('<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                    number = self.lines + 1
                    out.write(self._row(number, self.schema.fieldNames()))
                    while row is not None and number <= MAX_ROWS:
                        number += 1
                        out.write(self._row(number, row))
                        row = next(rows, None)
                    out.write("</sheetData></worksheet>")
            if row is None:
                return

    @staticmethod
    def _row(number: int, values: list) -> str:
        cells = "".join("<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in values)
        return f'<row r="{number}">{cells}</row>'
