"""Institution registry: one listing per period, kept as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finmart.functions.dates import period_list
from finmart.operators.filters import drop_header_rows
from finmart.sources.layouts import REGISTRY, strings
from finmart.sources.odata import PeriodService


def fetch_registry(spark: SparkSession, url: str, start: str = "2019-03", end: str = "2021-10", pages: int = 1,
                   schema=None, **options: str) -> DataFrame:
    """The listings of all quarters from ``start`` to ``end``, requested in parallel, with their period."""
    schema = schema or strings("AnoMes", *REGISTRY.fieldNames())
    spark.dataSource.register(PeriodService)
    return (spark.read.format(PeriodService.name()).schema(schema)
            .options(url=url, periods=",".join(period_list(start, end)), pages=pages, **options).load())


def appended_listings(raw: DataFrame, key: str = "CodInst") -> DataFrame:
    """Listings appended into one CSV repeat the header; drop those lines."""
    return drop_header_rows(raw, key)
