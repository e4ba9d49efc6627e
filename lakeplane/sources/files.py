"""Files: CSV, text with any delimiter, and worksheets; every column is text, so that row hashes are stable."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from lakeplane.naming import physical_names, sanitised
from lakeplane.operators.shape import drop_empty_columns
from lakeplane.sources.registry import Source, connector, options

SNIFF_BYTES = 64 << 10
_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}


def sniff(spark: SparkSession, path: str) -> str:
    """The delimiter of a text file, from its head; a comma if none stands out."""
    head = spark.read.text(path).limit(50).collect()
    sample = "\n".join(r[0] for r in head)[:SNIFF_BYTES]
    try:
        return csv.Sniffer().sniff(sample, delimiters=",;\t|").delimiter
    except csv.Error:
        return ","


# --- worksheets


def _column(ref: str) -> int:
    n = 0
    for ch in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


def sheet_names(data: bytes) -> list[str]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return [s.get("name") for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iterfind(".//m:sheet", _NS)]


def sheet_rows(data: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of a sheet as texts; cells that are left out are null."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        ids = {s.get("name"): s.get(f"{{{_NS['r']}}}id") for s in book.iterfind(".//m:sheet", _NS)}
        if sheet not in ids:
            raise ValueError(f"the workbook has no sheet {sheet!r}; it has {list(ids)}")
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iterfind(".//m:t", _NS)) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
        target = links[ids[sheet]].lstrip("/")
        with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
            for _, element in ElementTree.iterparse(f):
                if element.tag != f"{{{_NS['m']}}}row":
                    continue
                row: list[str | None] = []
                for i, cell in enumerate(element.iterfind("m:c", _NS)):
                    at = _column(cell.get("r")) if cell.get("r") else i
                    row += [None] * (at + 1 - len(row))
                    value = cell.find("m:v", _NS)
                    if cell.get("t") == "inlineStr":
                        row[at] = "".join(t.text or "" for t in cell.iterfind(".//m:t", _NS))
                    elif value is not None and value.text is not None:
                        row[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
                yield row
                element.clear()


class _SheetReader(DataSourceReader):
    def __init__(self, path: str, sheet: str, width: int):
        self.path, self.sheet, self.width = path, sheet, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.sheet)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            rows = sheet_rows(f.read(), self.sheet)
        next(rows, None)
        for row in rows:
            if any(v is not None for v in row):
                yield tuple((row + [None] * self.width)[: self.width])


class WorkbookSource(DataSource):
    """``format("workbook")``: one sheet of an xlsx file on a path that all machines see."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _header(self) -> list[str]:
        with open(self._path(), "rb") as f:
            return [h if h is not None else "" for h in next(sheet_rows(f.read(), self.options["sheet"]), [])]

    def _path(self) -> str:
        return self.options["path"].removeprefix("file:")

    def schema(self) -> str:
        # a position instead of a name: headers may be empty, repeated or full of signs
        return ", ".join(f"_{i} string" for i in range(len(self._header()))) or "_empty string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _SheetReader(self._path(), self.options["sheet"], len(schema))


def read_sheet(spark: SparkSession, path: str, sheet: str) -> tuple[DataFrame, list[str]]:
    spark.dataSource.register(WorkbookSource)
    with open(path.removeprefix("file:"), "rb") as f:
        header = [h if h is not None else "" for h in next(sheet_rows(f.read(), sheet), [])]
    return spark.read.format("workbook").option("sheet", sheet).load(path), header


def read_delimited(spark: SparkSession, path: str, sep: str) -> tuple[DataFrame, list[str]]:
    """Rows under positional names, and the header as it stands in the file."""
    first = spark.read.text(path).first()
    header = next(csv.reader([first[0]], delimiter=sep)) if first else []
    schema = ", ".join(f"_{i} string" for i in range(len(header))) or "_empty string"
    return spark.read.schema(schema).csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True, enforceSchema=True), header


def land(df: DataFrame, header: list[str]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """(rows without empty columns under sanitised names, (silver name, original header) of each column)."""
    kept = drop_empty_columns(df)
    originals = [header[int(c[1:])] for c in kept.columns] if kept.columns != ["_empty"] else []
    if not originals:
        return df.sparkSession.createDataFrame([], "_empty string"), []
    names = sanitised(originals)
    return kept.toDF(*names), list(zip(physical_names(names), originals))


def read_file(spark: SparkSession, source: Source) -> tuple[DataFrame, list[tuple[str, str]]]:
    opts = options(source)
    path, kind = str(opts.get("path") or opts.get("file_abfss")), str(opts.get("format") or "csv").lower()
    if kind == "xlsx":
        return land(*read_sheet(spark, path, str(opts["sheet"])))
    if kind == "xls":
        raise RuntimeError("the old binary workbook format isn't read; save the file as xlsx")
    sep = opts.get("sep") or (sniff(spark, path) if kind == "txt" else ",")
    return land(*read_delimited(spark, path, str(sep)))


@connector("file", "dropbox")
def file_source(spark: SparkSession, source: Source) -> DataFrame:
    return read_file(spark, source)[0]


@connector("onprem", "staged")
def staged(spark: SparkSession, source: Source) -> DataFrame:
    """A table that another process has landed at ``path``."""
    path = str(options(source).get("path") or "")
    try:
        return spark.read.parquet(path)
    except Exception as e:
        raise FileNotFoundError(f"object {source.get('object_id')!r}: nothing was staged at {path!r}") from e
