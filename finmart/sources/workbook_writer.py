"""Rows to workbooks, for handing data back to spreadsheet users and for round trips in tests.

Spark cuts the rows into Arrow batches; a batch becomes one workbook, so no workbook outgrows
``spark.sql.execution.arrow.maxRecordsPerBatch`` rows.
"""

from __future__ import annotations

import hashlib
import io
import re
import sys
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# The package parts every workbook needs.
_TYPES = """<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">\
<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>\
<Default Extension="xml" ContentType="application/xml"/></Types>"""
_ROOT_RELS = """<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">\
<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>\
</Relationships>"""
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL_NS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


class _Dated(zipfile.ZipFile):
    """Parts carry no time of writing, so equal cells give equal bytes."""

    def writestr(self, name, data):
        super().writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED)


def column_letters(index: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA."""
    letters = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        letters = chr(ord("A") + rest) + letters
    return letters


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A workbook of text and number cells; a cell that is None is left out."""
    def cell(row: int, col: int, value) -> str:
        at = f"{column_letters(col)}{row}"
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f'<c r="{at}"><v>{value!r}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    out = io.BytesIO()
    with _Dated(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _TYPES)
        z.writestr("_rels/.rels", _ROOT_RELS)
        names, rels = [], []
        for i, (name, rows) in enumerate(sheets.items(), 1):
            names.append(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>')
            rels.append(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/'
                        f'relationships/worksheet" Target="worksheets/sheet{i}.xml"/>')
            body = "".join(
                f'<row r="{r}">' + "".join(cell(r, c, v) for c, v in enumerate(row) if v is not None) + "</row>"
                for r, row in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{i}.xml", f"<worksheet {_NS}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/workbook.xml", f"<workbook {_NS} {_REL_NS}><sheets>{''.join(names)}</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                   f'relationships">{"".join(rels)}</Relationships>')
    return out.getvalue()


def column_number(letters: str) -> int:
    """A -> 0, Z -> 25, AA -> 26."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter) - ord("A") + 1
    return number - 1


def to_workbooks(df: DataFrame, sheet: str, lead: list[list] | None = None) -> DataFrame:
    """One workbook per batch of rows: ``lead`` rows, then the column names, then the rows, all in one sheet."""
    names, lead_rows = df.columns, lead or []

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = pdf.astype(object).where(pdf.notna(), None).values.tolist()
            content = workbook_bytes({sheet: [*lead_rows, names, *rows]})
            # named by what it holds: a task that runs again names it alike
            yield pd.DataFrame({"path": [f"{sheet}-{hashlib.sha256(content).hexdigest()[:32]}.xlsx"], "content": [content]})

    return df.mapInPandas(pack, "path string, content binary")


def write_workbooks(cells: DataFrame, root: str) -> DataFrame:
    """Store each workbook of a cell table (``file`` is its path below ``root``): ``path`` and ``bytes`` of each.

    A workbook is one task's work. It is stored under another name and then moved, so no reader sees half of one, and a
    task that runs again stores the same bytes at the same place.
    """
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sheets: dict[str, list[list]] = {}
        for name, of_sheet in sorted(pdf.groupby("sheet"), key=lambda g: g[1]["sheet_index"].iloc[0]):
            grid = sheets.setdefault(name, [])
            for row, col, value in zip(of_sheet["row"], of_sheet["col"], of_sheet["value"]):
                grid += [[] for _ in range(row - len(grid))]
                at = column_number(col)
                grid[row - 1] += [None] * (at + 1 - len(grid[row - 1]))
                grid[row - 1][at] = value
        content = workbook_bytes(sheets)
        path = f"{root}/{key[0]}"
        place, name = fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", path))
        place.create_dir(name.rsplit("/", 1)[0])
        half = f"{name}.{uuid.uuid4().hex}"
        with place.open_output_stream(half) as out:
            out.write(content)
        place.move(half, name)
        return pd.DataFrame({"path": [path], "bytes": [len(content)]})

    return cells.select("file", "sheet", "sheet_index", "row", "col", "value").groupBy("file").applyInPandas(
        pack, "path string, bytes bigint")


# Executors need not have this package installed: what runs there travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
