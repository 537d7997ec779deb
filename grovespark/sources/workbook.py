"""Spreadsheet files: a check of the container, and the rows of the first sheet as a Spark data source.

Workbooks are small (MAX_BYTES bounds them); each file is one partition of the source.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MAX_BYTES, MAX_ENTRIES, MAX_UNPACKED, MAX_RATIO = 32 << 20, 2_000, 256 << 20, 200
_REQUIRED = ("[Content_Types].xml", "xl/workbook.xml")
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_SAFE = re.compile(r"[A-Za-z0-9_\[\]. /-]+")


def container_error(data: bytes) -> str | None:
    """Why a spreadsheet container is refused; None if it is not."""
    if len(data) > MAX_BYTES:
        return "TOO_LARGE"
    try:
        entries = zipfile.ZipFile(io.BytesIO(data)).infolist()
    except (zipfile.BadZipFile, ValueError, NotImplementedError):
        return "NOT_A_ZIP"
    names = [e.filename for e in entries]
    if len(entries) > MAX_ENTRIES:
        return "TOO_MANY_ENTRIES"
    if any(not _SAFE.fullmatch(n) or n.startswith("/") or ".." in n.split("/") for n in names):
        return "UNSAFE_NAME"
    if len({n.lower() for n in names}) < len(names):
        return "DUPLICATE_NAME"
    if any(e.flag_bits & 1 for e in entries):
        return "ENCRYPTED"
    spans = sorted((e.header_offset, e.header_offset + 30 + len(e.filename) + e.compress_size) for e in entries)
    if any(b > a for (_, b), (a, _) in zip(spans, spans[1:])):
        return "OVERLAP"
    if sum(e.file_size for e in entries) > MAX_UNPACKED or any(e.file_size > MAX_RATIO * max(e.compress_size, 1) for e in entries):
        return "RATIO"
    return None if all(n in names for n in _REQUIRED) else "PART_MISSING"


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def sheet_rows(data: bytes):
    """(row number, cells) of the first sheet; empty cells are None."""
    if why := container_error(data):
        raise ValueError(why)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        sheet = min((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
        for _, row in ElementTree.iterparse(z.open(sheet)):
            if row.tag != f"{_MAIN}row":
                continue
            cells: list[str | None] = []
            for c in row:
                at = _column(c.get("r")) if c.get("r") else len(cells)
                cells += [None] * (at + 1 - len(cells))
                value = c.find(f"{_MAIN}v")
                text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t")) if c.get("t") == "inlineStr" else None if value is None else value.text
                cells[at] = shared[int(text)] if c.get("t") == "s" and text is not None else text
            yield int(row.get("r")), cells
            row.clear()


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in options["paths"].split("\n") if p]

    def partitions(self):
        return [_File(p) for p in self.paths]

    def read(self, partition):
        from pyarrow.fs import FileSystem

        fs, path = FileSystem.from_uri(partition.path) if "://" in partition.path else (None, partition.path)
        if fs is None:
            with open(path, "rb") as f:
                data = f.read()
        else:
            with fs.open_input_file(path) as f:
                data = f.read()
        for number, cells in sheet_rows(data):
            yield partition.path, number, cells


class Workbook(DataSource):
    """spark.read.format("workbook").option("paths", newline-joined paths): rows (path, row_number, cells)."""

    @classmethod
    def name(cls):
        return "workbook"

    def schema(self):
        return "path string, row_number int, cells array<string>"

    def reader(self, schema):
        return _Reader(self.options)


def read_workbooks(spark: SparkSession, *paths: str):
    spark.dataSource.register(Workbook)
    return spark.read.format("workbook").option("paths", "\n".join(paths)).load()
