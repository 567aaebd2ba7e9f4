"""Loans: a folder of CSV files per year to one table, and its profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from finmart.functions.numbers import text_to_numbers
from finmart.operators.aggregate import describe_columns
from finmart.operators.quality import null_profile
from finmart.sources.files import read_partitioned_csv, read_year_folders


def loans_union(spark: SparkSession, folders: dict[int, str], schema: T.StructType, amounts: list[str]) -> DataFrame:
    """All years, with ``ano``; amounts are decimal-comma text in the files. Write it partitioned by ``ano``."""
    return text_to_numbers(read_year_folders(spark, folders, schema), amounts)


def read_loans(spark: SparkSession, root: str, schema: T.StructType, amounts: list[str]) -> DataFrame:
    """The same from one root of folders ``ano=<year>``, in one scan."""
    return text_to_numbers(read_partitioned_csv(spark, root, schema), amounts)


def loans_profile(loans: DataFrame) -> DataFrame:
    """Statistics and NULLs of every column, one row per column."""
    nulls = null_profile(loans).select("coluna", "nulos")
    # both sides hold one row per column
    return describe_columns(loans).join(nulls, "coluna")
