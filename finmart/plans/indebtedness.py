"""Household indebtedness: dashes and decimal commas to numbers, ``MM/yy`` to a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finmart.functions.dates import month_slash_year
from finmart.functions.numbers import text_to_numbers
from finmart.operators.columns import rename_positional
from finmart.operators.filters import replace_exact
from finmart.plans.fixed_values import INDEBTEDNESS_PERCENTAGES, INDEBTEDNESS_RAW_NAMES
from finmart.sources.files import read_text_csv


def indebtedness(raw: DataFrame, percentages: list[str] = INDEBTEDNESS_PERCENTAGES) -> DataFrame:
    """A cell that is just a dash counts as zero; a date that cannot be read is NULL."""
    df = text_to_numbers(replace_exact(raw, {"-": "0.00"}, percentages), percentages)
    return df.withColumn("Data", month_slash_year("Data")).withColumnRenamed("Data", "Periodo")


def read_indebtedness(spark: SparkSession, path: str) -> DataFrame:
    """From the comma-separated file on, its percentages quoted."""
    return indebtedness(read_text_csv(spark, path))


def indebtedness_originals(raw: DataFrame) -> DataFrame:
    """The table as published, with its ten short names."""
    return rename_positional(raw, INDEBTEDNESS_RAW_NAMES)
