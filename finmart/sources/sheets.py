"""Workbook sheets as data: workbook bytes -> one row per cell -> shaped tables."""

from __future__ import annotations

import io
import re
import sys
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.operators.joins import lookup

CELLS = "file string, sheet string, sheet_index int, row int, col string, value string"
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PKG = "{http://schemas.openxmlformats.org/package/2006/relationships}"


def _plain(node) -> str:
    return "".join(t.text or "" for t in node.iter(_MAIN + "t"))


def _ended(xml, tag: str) -> Iterator:
    """Each element of the tag as it ends; what was read is let go, so a part never lies whole in memory."""
    above = []
    for event, node in ElementTree.iterparse(xml, ("start", "end")):
        if event == "start":
            above.append(node)
            continue
        above.pop()
        if node.tag == _MAIN + tag:
            yield node
            above[-1].clear()


def _workbook_cells(content: bytes) -> Iterator[tuple]:
    """(sheet name, sheet index, row, column letters, text) for every filled cell; the shared texts are read first."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as xml:
                shared = [_plain(n) for n in _ended(xml, "si")]
        rels = {r.get("Id"): r.get("Target")
                for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(_PKG + "Relationship")}
        sheets = ElementTree.fromstring(z.read("xl/workbook.xml")).iter(_MAIN + "sheet")
        for index, sheet in enumerate(sheets):
            target = rels[sheet.get(_REL + "id")]
            part = target.lstrip("/") if target.startswith("/") else "xl/" + target
            with z.open(part) as xml:
                for node in _ended(xml, "row"):
                    for cell in node.iter(_MAIN + "c"):
                        col, row = re.match(r"([A-Z]+)(\d+)", cell.get("r")).groups()
                        if cell.get("t") == "inlineStr":
                            text = _plain(cell)
                        else:
                            text = cell.findtext(_MAIN + "v")
                            if text is not None and cell.get("t") == "s":
                                text = shared[int(text)]
                        if text not in (None, ""):
                            yield sheet.get("name"), index, int(row), col, text


def _parse(carry: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [*carry, "file", "sheet", "sheet_index", "row", "col", "value"]
        for pdf in batches:
            for path, content, *carried in zip(pdf["path"], pdf["content"], *(pdf[c] for c in carry)):
                rows = []
                for cell in _workbook_cells(content):
                    rows.append((*carried, path, *cell))
                    if len(rows) == 50_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)
    return run


def _damage(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                for _ in _workbook_cells(content):
                    pass
            except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError, AttributeError, zlib.error) as error:
                yield pd.DataFrame({"file": [path], "motivo": [f"{type(error).__name__}: {error}"]})


def workbook_cells(workbooks: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Cells of the workbooks in a frame of ``path`` and ``content`` (bytes); a workbook is one row.

    ``carry`` names further columns of the workbook that go with each of its cells. A damaged workbook ends the job;
    :func:`unreadable_workbooks` tells which ones are.
    """
    kinds = dict(workbooks.dtypes)
    told = "".join(f"`{c}` {kinds[c]}, " for c in carry) + CELLS
    return workbooks.select("path", "content", *(F.col(f"`{c}`") for c in carry)).mapInPandas(_parse([*carry]), told)


def unreadable_workbooks(workbooks: DataFrame) -> DataFrame:
    """``file`` and ``motivo`` of the workbooks that cannot be read to their end."""
    return workbooks.select("path", "content").mapInPandas(_damage, "file string, motivo string")


def workbook_files(spark: SparkSession, path, pattern: str = "*.xlsx") -> DataFrame:
    """Workbooks of a folder as bytes; folders named ``column=value`` are columns."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def read_workbooks(spark: SparkSession, path, pattern: str = "*.xlsx", carry: tuple[str, ...] = ()) -> DataFrame:
    return workbook_cells(workbook_files(spark, path, pattern), carry)


def _of_sheet(cells: DataFrame, sheet: str | int | None) -> DataFrame:
    if sheet is None:
        return cells
    return cells.where(F.col("sheet" if isinstance(sheet, str) else "sheet_index") == sheet)


def _body(cells: DataFrame, skip: int, footer: int) -> DataFrame:
    body = cells.where(F.col("row") > skip)
    if footer:
        last = cells.groupBy("file", "sheet").agg((F.max("row") - footer).alias("last_row"))
        body = lookup(body, last, ["file", "sheet"], "inner").where(F.col("row") <= F.col("last_row"))
    return body


def shape_sheet(cells: DataFrame, columns: dict[str, str], sheet: str | int | None = None, skip: int = 0,
                footer: int = 0) -> DataFrame:
    """Cell table to rows: skip ``skip`` top rows and ``footer`` last ones, keep the lettered columns.

    ``columns`` maps column letters to names; ``sheet`` is a name or a 0-based index. Keeps ``file``, ``sheet``
    and ``row``. Values stay text.
    """
    body = _body(_of_sheet(cells, sheet), skip, footer)
    picked = body.where(F.col("col").isin(list(columns))).groupBy("file", "sheet", "row")
    return picked.agg(*(F.max(F.when(F.col("col") == letter, F.col("value"))).alias(n) for letter, n in columns.items()))


def shape_sheets(cells: DataFrame, layouts: DataFrame, names: list[str], by: str, sheet: str | int | None = None,
                 skip: int = 0, footer: int = 0) -> DataFrame:
    """Like :func:`shape_sheet` for workbooks whose columns stand at other letters each: one pass over all cells.

    ``layouts`` has a row for each column ``by`` (carried by the cells), ``col`` (letters) and ``nome``. Cells of a
    workbook without a layout are left out.
    """
    body = _body(_of_sheet(cells, sheet), skip, footer)
    named = lookup(body, layouts.select(by, "col", "nome"), [by, "col"], "inner")
    return named.groupBy(by, "file", "sheet", "row").agg(
        *(F.max(F.when(F.col("nome") == n, F.col("value"))).alias(n) for n in names))


def header_names(cells: DataFrame, letters: list[str] | None = None, row: int = 1) -> dict[str, str]:
    """A row of a sheet as letters -> name, in the order of the sheet; all its workbooks must agree.

    A sheet has at most 16,384 columns, and one row a column comes to the driver.
    """
    at = cells.where(F.col("row") == row)
    if letters is not None:
        at = at.where(F.col("col").isin(letters))
    told = at.groupBy("col").agg(F.min("value").alias("least"), F.max("value").alias("most")).collect()
    apart = [r["col"] for r in told if r["least"] != r["most"]]
    if apart:
        raise ValueError(f"workbooks name the columns {sorted(apart)} differently")
    return {r["col"]: r["least"] for r in sorted(told, key=lambda r: (len(r["col"]), r["col"]))}


def sheet_table(cells: DataFrame, sheet: str | int | None = None, header: int = 1, footer: int = 0) -> DataFrame:
    """A sheet with a header row as a table of texts, named and ordered by its header."""
    of_sheet = _of_sheet(cells, sheet)
    names = header_names(of_sheet, row=header)
    return shape_sheet(of_sheet, names, skip=header, footer=footer).select(*(F.col(f"`{n}`") for n in names.values()))


# Executors need not have this package installed: what runs there travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
