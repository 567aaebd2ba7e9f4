"""Payment channels: year columns per access channel, and six operation sheets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.names import lower_underscored, rename_by, snake
from finmart.functions.numbers import to_number
from finmart.operators.columns import prefix, quoted, tag
from finmart.session import written
from finmart.sources.sheets import read_workbooks, sheet_table


def access_channels(raw: DataFrame) -> DataFrame:
    """Clean names, years prefixed, the channel column named ``Canal_Acesso``."""
    return prefix(rename_by(raw, snake), "ano_", {"canal_de_acesso": "Canal_Acesso"})


def operations_sheet(raw: DataFrame, operation: str = "operacao") -> DataFrame:
    """First column to ``operation``, clean names, blank or unreadable counts to 0."""
    first, *years = raw.columns
    counts = raw.select(quoted(first), *(F.coalesce(to_number(quoted(y)), F.lit(0.0)).alias(y) for y in years))
    return rename_by(counts, lower_underscored).withColumnRenamed(lower_underscored(first), operation)


def operations_union(sheets: dict[str, DataFrame]) -> DataFrame:
    """All sheets under one roof, with the channel each came from."""
    parts = [tag(operations_sheet(raw), canal=channel) for channel, raw in sheets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_access_channels(spark: SparkSession, path: str, sheet: str | int | None = 0) -> DataFrame:
    """The workbook's sheet of channels by year, from the file on."""
    return access_channels(sheet_table(written(read_workbooks(spark, path), "cells"), sheet))


def read_operations(spark: SparkSession, path: str, channels: list[str]) -> DataFrame:
    """The workbook's sheets, one a channel in the order given; the workbook is read once."""
    cells = written(read_workbooks(spark, path), "cells")
    return operations_union({channel: sheet_table(cells, index) for index, channel in enumerate(channels)})
