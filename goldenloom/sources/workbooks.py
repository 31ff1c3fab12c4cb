"""Spreadsheet workbooks (.xlsx), both ways, without other libraries: a zip of XML parts.

Reading goes through Spark's binary file source, so a path may be anywhere Spark reads; a task streams through a file's
rows. Writing makes the parts in one task as a stream of pieces, which the driver passes on to the file."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenloom.sources import files

# The format's names, and how many rows a sheet holds.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
MOST_ROWS = 1_048_576
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><sheets><sheet name="%s" sheetId="1" r:id="rId1"/></sheets></workbook>',
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="rId1" Type="{LINKS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
}
PIECE = 1 << 20
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")

_SPECIAL = re.compile(r"[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_CODED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def _coded(text: str) -> str:
    """Characters that XML can't hold, by their number, as the format has it."""
    return escape(_SPECIAL.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def _plain(text: str) -> str:
    return _CODED.sub(lambda m: chr(int(m[1], 16)), text)


def column_letters(k: int) -> str:
    """A for 0, Z for 25, AA for 26."""
    out = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


def column_number(reference: str) -> int:
    n = 0
    for x in reference:
        if not x.isalpha():
            break
        n = 26 * n + ord(x) - 64
    return n - 1


def _strings(book: zipfile.ZipFile) -> list[str]:
    """The shared strings; formatted parts of one are joined, readings left out."""
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, item in ElementTree.iterparse(f):
            if item.tag == f"{{{MAIN}}}si":
                out.append(_plain("".join(t.text or "" for x in item if x.tag != f"{{{MAIN}}}rPh" for t in x.iter(f"{{{MAIN}}}t"))))
                item.clear()
    return out


def _part(book: zipfile.ZipFile, sheet: str | int) -> str:
    """The name of a sheet's part, by the sheet's name or its place from 0."""
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).findall(f"{{{MAIN}}}sheets/{{{MAIN}}}sheet")
    found = [s for k, s in enumerate(sheets) if sheet in (k, s.get("name"))]
    if not found:
        raise ValueError(f"no sheet {sheet!r}")
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == found[0].get(f"{{{LINKS}}}id"):
            target = link.get("Target")
            return target[1:] if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"sheet {sheet!r} has no part")


def sheet_rows(content: bytes, sheet: str | int = 0) -> Iterator[list[str | None]]:
    """The sheet's rows as texts, null for cells without a value; rows left out of the file are empty lists."""
    book = zipfile.ZipFile(io.BytesIO(content))
    shared, part, at = _strings(book), _part(book, sheet), 0
    tag = lambda name: f"{{{MAIN}}}{name}"
    with book.open(part) as f:
        for _, row in ElementTree.iterparse(f):
            if row.tag != tag("row"):
                continue
            number = int(row.get("r", at + 1))
            while at + 1 < number:
                yield []
                at += 1
            out: list[str | None] = []
            for cell in row.findall(tag("c")):
                place = column_number(cell.get("r")) if cell.get("r") else len(out)
                out += [None] * (place + 1 - len(out))
                kind, value = cell.get("t", "n"), cell.find(tag("v"))
                if kind == "inlineStr":
                    inline = cell.find(tag("is"))
                    out[place] = _plain("".join(t.text or "" for t in inline.iter(tag("t")))) if inline is not None else None
                elif value is not None and kind == "s":
                    out[place] = shared[int(value.text)]
                elif value is not None:
                    out[place] = {"0": "false", "1": "true"}.get(value.text, value.text) if kind == "b" else _plain(value.text or "")
            row.clear()
            yield out
            at += 1


def read_workbook(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """The rows of a sheet of all workbooks under `path`, as strings, by the names in the first file's first row (a blank
    name is called col1 and so on by its place, a repeated one gets its place). Numbers stand as in the file, dates as the
    day numbers that a sheet has. Other files' columns go by name; rows without any value are left out."""
    found = spark.read.format("binaryFile").load(path)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([_names(next(sheet_rows(content.as_py(), sheet), []))], pa.list_(pa.string()))], ["path", "names"])

    first = found.select("path", "content").mapInArrow(heads, "path string, names array<string>").agg(F.min_by("names", "path")).first()[0]
    if not first:
        raise ValueError(f"no columns in {path}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                lines = sheet_rows(content.as_py(), sheet)
                own = {n: k for k, n in enumerate(_names(next(lines, [])))}
                places, held = [own.get(n) for n in first], []
                for line in lines:
                    if any(x is not None for x in line):
                        held.append([line[k] if k is not None and k < len(line) else None for k in places])
                    if len(held) == 5000:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    def batch(held: list[list[str | None]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held)], inner)

    inner = [f"c{k}" for k in range(len(first))]
    return found.select("content").mapInArrow(rows, ", ".join(f"{n} string" for n in inner)).toDF(*first)


def _names(head: list[str | None]) -> list[str]:
    out: list[str] = []
    for k, name in enumerate(head):
        name = name if name and name.strip() else f"col{k + 1}"
        out.append(name if name not in out else f"{name}_{k + 1}")
    return out


class _Pieces(io.RawIOBase):
    """A file that hands on what is written."""

    def __init__(self):
        self.held, self.size = [], 0

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.held.append(bytes(data))
        self.size += len(data)
        return len(data)

    def take(self) -> bytes:
        out, self.held, self.size = b"".join(self.held), [], 0
        return out


def write_workbook(df: DataFrame, path: str, sheet: str = "Sheet1") -> None:
    """df as one workbook of one sheet at `path`, names in the first row; numbers stay numbers, other values are texts, a
    null has no cell. More rows than a sheet holds raise before anything is written. The rows are made in parallel
    first; one task packs them, and only pieces of a megabyte pass through the driver."""
    spark, names = df.sparkSession, df.columns
    made = files.stored(df.select(*(F.col(f"`{n}`").cast(k if k in NUMBERS else "string").alias(f"c{j}") for j, (n, k) in enumerate(df.dtypes))))
    numeric = [k in NUMBERS for _, k in made.dtypes]
    if made.count() >= MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS - 1} rows")
    parts = PARTS | {"xl/workbook.xml": PARTS["xl/workbook.xml"] % _coded(sheet).replace('"', "&quot;")}
    letters = [column_letters(k) for k in range(len(names))]

    def row(n: int, values: list, as_text: bool = False) -> str:
        cells = []
        for k, v in enumerate(values):
            if v is not None and numeric[k] and not as_text and v == v and abs(v) != float("inf"):
                cells.append(f'<c r="{letters[k]}{n}"><v>{v!r}</v></c>')
            elif v is not None:
                cells.append(f'<c r="{letters[k]}{n}" t="inlineStr"><is><t xml:space="preserve">{_coded(str(v))}</t></is></c>')
        return f'<row r="{n}">{"".join(cells)}</row>'

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number, n = _Pieces(), 0, 2

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([out.take()], pa.binary())], ["n", "piece"])

        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
            for name, text in parts.items():
                book.writestr(name, HEAD + text)
            with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
                f.write(f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>{row(1, names, True)}'.encode())
                for b in batches:
                    columns = [c.to_pylist() for c in b.columns]
                    for values in zip(*columns):
                        f.write(row(n, values).encode("utf-8", "replace"))
                        n += 1
                        if out.size > PIECE:
                            yield piece()
                            number += 1
                f.write(b"</sheetData></worksheet>")
        yield piece()

    pieces = made.coalesce(1).mapInArrow(pack, "n long, piece binary")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        for r in pieces.toLocalIterator():  # one partition, in order
            out.write(bytearray(r["piece"]))
    finally:
        out.close()
