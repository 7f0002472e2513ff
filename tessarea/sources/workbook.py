"""Sheets of Office Open XML workbooks: a task for each sheet, its rows streamed out of the zip container."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tessarea.operators.expect import ExpectationError
from tessarea.sources.store import listed, opened

# Namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


class Sheet(InputPartition):
    def __init__(self, path: str, name: str, member: str):
        super().__init__(None)
        self.path, self.name, self.member = path, name, member


def sheets_of(path: str) -> list[Sheet]:
    with zipfile.ZipFile(opened(path)) as book:
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        found = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{MAIN}sheet")
        target = lambda s: links[s.get(RELATION)]
        return [Sheet(path, s.get("name"), target(s).lstrip("/") if target(s).startswith("/") else f"xl/{target(s)}") for s in found]


def column_of(reference: str) -> int:
    """A1 and the like: the column from 0."""
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(letter) - 64
    return n - 1


def _streamed(file, tag: str) -> Iterator[ElementTree.Element]:
    """Elements as they end; what has been read is let go."""
    steps = ElementTree.iterparse(file, ("start", "end"))
    _, root = next(steps)
    for event, element in steps:
        if event == "end" and element.tag == tag:
            yield element
            root.clear()


def _text(element: ElementTree.Element) -> str:
    """A string with its runs, without phonetic guides."""
    return "".join(t.text or "" for k in element if k.tag in (f"{MAIN}t", f"{MAIN}r") for t in ([k] if k.tag == f"{MAIN}t" else k.iter(f"{MAIN}t")))


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.only = options["path"], options.get("sheet")

    def partitions(self) -> list[InputPartition]:
        return [s for p in listed(self.path, ".xlsx") for s in sheets_of(p) if self.only in (None, s.name)]

    def read(self, partition: Sheet) -> Iterator[tuple]:
        if partition is None:
            return
        with zipfile.ZipFile(opened(partition.path)) as book:
            shared: list[str] = []
            if "xl/sharedStrings.xml" in book.namelist():
                with book.open("xl/sharedStrings.xml") as f:
                    shared = [_text(s) for s in _streamed(f, f"{MAIN}si")]
            with book.open(partition.member) as f:
                for n, row in enumerate(_streamed(f, f"{MAIN}row"), 1):
                    cells: dict[int, str | None] = {}
                    for k, c in enumerate(row.iter(f"{MAIN}c")):
                        kind, value, inline = c.get("t"), c.find(f"{MAIN}v"), c.find(f"{MAIN}is")
                        raw = value.text if value is not None else None
                        at = column_of(c.get("r")) if c.get("r") else k
                        cells[at] = _text(inline) if inline is not None else shared[int(raw)] if kind == "s" and raw is not None else {"1": "true", "0": "false"}.get(raw, raw) if kind == "b" else raw
                    yield partition.path, partition.name, int(row.get("r") or n), [cells.get(i) for i in range(max(cells, default=-1) + 1)]


class WorkbookSource(DataSource):
    """Options: path (a workbook, a folder or a pattern), sheet (all if not given). Numbers are as written in the file, dates as numbers of days."""

    @classmethod
    def name(cls) -> str:
        return "tessarea_workbook"

    def schema(self) -> str:
        return "path string, sheet string, row int, cells array<string>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)


def read_workbook(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """path, sheet, row (from 1, as numbered in the sheet) and cells of every row that the file has."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format(WorkbookSource.name()).options(path=path, **({"sheet": sheet} if sheet else {})).load()


def under_headers(rows: DataFrame, words: Sequence[str], least: int) -> DataFrame:
    """path, sheet, row, and a map of the header's names to the cells, of the rows under each sheet's first row with ``least`` of the words (no matter the case).

    A sheet without such a row is an error that names it, not left out. Rows without any filled cell are left out; a name that comes
    again gets its place behind it."""
    text = F.lower(F.array_join("cells", "\u0001"))
    hits = sum((text.contains(w.lower()).cast("int") for w in words), F.lit(0))
    heads = rows.groupBy("path", "sheet").agg(F.min(F.when(hits >= least, F.struct("row", "cells"))).alias("head"))
    lost = heads.filter("head IS NULL").limit(5).collect()
    if lost:
        raise ExpectationError(f"no header with {least} of {list(words)} in {[(r.path, r.sheet) for r in lost]}")
    plain = F.transform("head.cells", lambda c: F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"\s+", " "))
    heads = heads.select("path", "sheet", F.col("head.row").alias("_at"), plain.alias("_plain"))
    named = F.transform("_plain", lambda c, i: F.when(c == "", F.concat(F.lit("column "), (i + 1).cast("string"))).when(F.array_position("_plain", c) < i + 1, F.concat(c, F.lit(" "), (i + 1).cast("string"))).otherwise(c))
    heads = heads.select("path", "sheet", "_at", named.alias("_names"))
    filled = F.exists("cells", lambda c: F.trim(F.coalesce(c, F.lit(""))) != "")
    under = rows.filter(filled).join(heads, ["path", "sheet"]).filter(F.col("row") > F.col("_at"))
    values = F.transform("_names", lambda n, i: F.get("cells", i))
    return under.select("path", "sheet", "row", F.map_from_arrays("_names", values).alias("cells"))


def workbook_table(spark: SparkSession, path: str, words: Sequence[str], least: int, columns: Sequence[str], sheet: str | None = None) -> DataFrame:
    """path, sheet, row and the named columns as strings, from under each sheet's header; a column that a sheet lacks is NULL there."""
    found = under_headers(read_workbook(spark, path, sheet), words, least)
    return found.select("path", "sheet", "row", *[F.trim(F.try_element_at("cells", F.lit(c))).alias(c) for c in columns])
