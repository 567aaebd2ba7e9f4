"""Bank branches by state: the same sheet of yearly workbooks, each year with a layout of its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.numbers import to_number
from finmart.operators.columns import drop_first, quoted
from finmart.plans.fixed_values import BRANCH_COLUMNS, BRANCH_FOOTER, BRANCH_LETTERS, BRANCH_SKIP
from finmart.session import written
from finmart.sources.sheets import read_workbooks, shape_sheet, shape_sheets


def branch_layouts(spark: SparkSession, letters: dict[int, list[str]] = BRANCH_LETTERS,
                   columns: list[str] = BRANCH_COLUMNS) -> DataFrame:
    """The known layouts as data: ``ano``, ``col``, ``nome``."""
    return spark.createDataFrame([(year, col, name) for year, cols in letters.items() for col, name in zip(cols, columns)],
                                 "ano int, col string, nome string")


def branches(cells: DataFrame, layouts: DataFrame, sheet: str | int | None = "quadro 4",
             columns: list[str] = BRANCH_COLUMNS) -> DataFrame:
    """All years' sheets, from cells that carry ``ano``; counts that are not numbers become NULL."""
    rows = shape_sheets(cells, layouts, columns, "ano", sheet, BRANCH_SKIP, BRANCH_FOOTER)
    return rows.select(quoted(columns[0]), *(to_number(quoted(c)).alias(c) for c in columns[1:]), "ano")


def read_branches(spark: SparkSession, root: str, layouts: DataFrame | None = None, **how) -> DataFrame:
    """The workbooks below ``root/ano=<year>``, in one scan."""
    cells = written(read_workbooks(spark, root, carry=("ano",)), "cells")
    return branches(cells, branch_layouts(spark) if layouts is None else layouts, **how)


def branches_by_bank(cells: DataFrame, columns: dict[str, str], skip: int = 6) -> DataFrame:
    """The per-bank sheet of 2018: lead rows and the first column go."""
    rows = shape_sheet(cells, columns, 0, skip).drop("file", "sheet", "row")
    return drop_first(rows).where(reduce(lambda a, b: a | b, (F.col(f"`{c}`").isNotNull() for c in list(columns.values())[1:])))
