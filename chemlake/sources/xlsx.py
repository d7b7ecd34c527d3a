"""Workbooks as a Spark data source: spark.read.format("xlsx"), df.write.format("xlsx").

Every column is text, under the header's names. One file is one partition when read; each task writes a workbook of its
own, of MOST_ROWS at most. Files appear when the whole write is done, and only then do the ones that they replace go.
Paths are folders of a file system that driver and executors share under one name.
Options: path; sheet (name or number; the first sheet where the name is missing and fallback is true).
"""

from __future__ import annotations

import glob
import itertools
import json
import os
import re
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

# Names of the parts of a workbook.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: Rows of a sheet, its header among them.
MOST_ROWS = 1_048_576
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _files(path: str) -> list[str]:
    return sorted(glob.glob(f"{path}/*.xlsx")) if os.path.isdir(path) else sorted(glob.glob(path))


def _sheet_part(book: zipfile.ZipFile, sheet: str, fallback: bool) -> str:
    sheets = [(s.get("name"), s.get(RELATION)) for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")]
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    chosen = next((r for n, r in sheets if n == sheet), None)
    if chosen is None and sheet.isdigit() and int(sheet) < len(sheets):
        chosen = sheets[int(sheet)][1]
    if chosen is None:
        if not fallback:
            raise ValueError(f"no sheet {sheet!r}")
        chosen = sheets[0][1]
    return "xl/" + targets[chosen].removeprefix("/xl/")


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def read_rows(path: str, sheet: str = "0", fallback: bool = True) -> Iterator[list[str | None]]:
    """Rows of a sheet as texts."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{MAIN}t")) for s in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]
        with book.open(_sheet_part(book, sheet, fallback)) as part:
            for _, row in ElementTree.iterparse(part):
                if row.tag != f"{MAIN}row":
                    continue
                values: list[str | None] = []
                for cell in row.iter(f"{MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(values)
                    values += [None] * (at + 1 - len(values))
                    text = cell.find(f"{MAIN}v")
                    if cell.get("t") == "inlineStr":
                        values[at] = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                    elif text is not None and text.text is not None:
                        values[at] = shared[int(text.text)] if cell.get("t") == "s" else text.text
                yield values
                row.clear()


# The parts of a workbook beside its sheets.
_TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{}</Types>'
_SHEET_TYPE = '<Override PartName="/xl/worksheets/sheet{}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
_RELATIONS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
_RELATION = '<Relationship Id="rId{}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{}" Target="{}"/>'
_BOOK = '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{}</sheets></workbook>'


def write_sheets(path: str, sheets: Iterable[tuple[str, Sequence[str], Iterable]]) -> None:
    """A workbook of sheets (name, header, rows), one after another; it appears under its name when it is whole. More rows than a sheet holds are an error."""
    draft, names = f"{path}.{uuid.uuid4().hex}.part", []
    line = lambda values: "<row>" + "".join("<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for v in values) + "</row>"
    with zipfile.ZipFile(draft, "w", zipfile.ZIP_DEFLATED) as book:
        for name, header, rows in sheets:
            names.append(name)
            with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w") as part:
                part.write(b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                part.write(line(header).encode())
                for k, row in enumerate(rows, 2):
                    if k > MOST_ROWS:
                        raise ValueError(f"a sheet holds {MOST_ROWS} rows: write more partitions")
                    part.write(line(row).encode())
                part.write(b"</sheetData></worksheet>")
        numbered = list(enumerate(names, 1))
        book.writestr("[Content_Types].xml", _TYPES.format("".join(_SHEET_TYPE.format(k) for k, _ in numbered)))
        book.writestr("_rels/.rels", _RELATIONS.format(_RELATION.format(1, "officeDocument", "xl/workbook.xml")))
        book.writestr("xl/_rels/workbook.xml.rels", _RELATIONS.format("".join(_RELATION.format(k, "worksheet", f"worksheets/sheet{k}.xml") for k, _ in numbered)))
        book.writestr("xl/workbook.xml", _BOOK.format("".join(f'<sheet name="{escape(name)}" sheetId="{k}" r:id="rId{k}"/>' for k, name in numbered)))
    os.replace(draft, path)


def write_rows(path: str, sheet: str, header: list[str], rows) -> None:
    """A workbook of one sheet."""
    write_sheets(path, [(sheet, header, rows)])


def write_workbook(tables: Mapping[str, DataFrame], path: str) -> None:
    """One workbook of several tables, a sheet each under its name, at a new or empty folder; it appears when all of it is written.

    A workbook is one file, so one task writes it; rows of a sheet beyond MOST_ROWS are an error.  Every value is a text.
    """
    register(next(iter(tables.values())).sparkSession)
    sheets = [(name, df.columns) for name, df in tables.items()]
    wide = max((len(columns) for _, columns in sheets), default=0)
    texts = lambda df: [F.col(f"`{c}`").cast("string") for c in df.columns] + [F.lit(None).cast("string")] * (wide - len(df.columns))
    parts = [df.select(F.lit(k).alias("sheet"), F.monotonically_increasing_id().alias("row"), F.array(*texts(df)).alias("cells")) for k, df in enumerate(tables.values())]
    rows = reduce(DataFrame.unionByName, parts)
    rows.repartition(1).sortWithinPartitions("sheet", "row").write.format("xlsx").option("sheets", json.dumps(sheets)).mode("append").save(path)


@dataclass
class _File(InputPartition):
    path: str


class XlsxReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.options = schema.names, dict(options)

    def partitions(self):
        return [_File(f) for f in _files(self.options["path"])]

    def read(self, partition):
        rows = read_rows(partition.path, self.options.get("sheet", "0"), self.options.get("fallback", "true").lower() == "true")
        header = [(h or "").strip() for h in next(rows, [])]
        places = [header.index(n) if n in header else None for n in self.names]
        for row in rows:
            yield tuple(row[p] if p is not None and p < len(row) else None for p in places)


@dataclass
class _Written(WriterCommitMessage):
    draft: str


def _split(sheets: list, iterator) -> Iterator[tuple[str, list[str], Iterable]]:
    """Rows (sheet, row, cells) in order of their sheets as (name, header, rows) of every sheet, also of those without rows."""
    groups = itertools.groupby(iterator, key=lambda r: r[0])
    number, rows = next(groups, (None, ()))
    for k, (name, header) in enumerate(sheets):
        if number != k:
            yield name, header, ()
            continue
        yield name, header, (r[2][: len(header)] for r in rows)
        number, rows = next(groups, (None, ()))


class XlsxWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.names, self.options = schema.names, dict(options)
        os.makedirs(self.options["path"], exist_ok=True)
        self.replaced = _files(self.options["path"]) if overwrite else []

    def write(self, iterator):
        draft = f"{self.options['path']}/part-{uuid.uuid4().hex}.xlsx.draft"
        if "sheets" in self.options:
            write_sheets(draft, _split(json.loads(self.options["sheets"]), iterator))
        else:
            write_rows(draft, self.options.get("sheet", "Sheet1"), self.names, (tuple(r) for r in iterator))
        return _Written(draft)

    def commit(self, messages):
        for m in messages:
            if m:
                os.replace(m.draft, m.draft.removesuffix(".draft"))
        for f in self.replaced:
            os.remove(f)

    def abort(self, messages):
        for m in messages:
            if m and os.path.exists(m.draft):
                os.remove(m.draft)


class XlsxSource(DataSource):
    @classmethod
    def name(cls):
        return "xlsx"

    def schema(self):
        files = _files(self.options["path"])
        if not files:
            raise FileNotFoundError(self.options["path"])
        header = next(read_rows(files[0], self.options.get("sheet", "0"), self.options.get("fallback", "true").lower() == "true"), [])
        return StructType([StructField((h or f"_c{i}").strip(), StringType()) for i, h in enumerate(header)])

    def reader(self, schema):
        return XlsxReader(schema, self.options)

    def writer(self, schema, overwrite):
        return XlsxWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxSource)
