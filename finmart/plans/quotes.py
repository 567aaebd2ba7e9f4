"""Exchange quotes: four yearly layouts to one table of 15 columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.functions.dates import date_from_parts
from finmart.functions.numbers import comma_number
from finmart.functions.text import trim_all
from finmart.operators.filters import canonicalise
from finmart.plans.fixed_values import BANK_TICKERS, BANK_TICKERS_2022, ISSUER_NAMES
from finmart.sources.layouts import QUOTE_COLUMNS, QUOTES_2019, QUOTES_2020, QUOTES_2022

PRICES = ["ABERTURA", "MAXIMO", "MINIMO", "MEDIO", "ULTIMO", "PREOFC", "PREOFV", "VOLTOT"]
COUNTS = ["TOTNEG", "QUATOT"]


def _typed(df: DataFrame, date: Column, cells: dict[str, Column], tickers: list[str]) -> DataFrame:
    """Pick and type the 15 columns; only listed tickers stay."""
    cells = cells | {"CODNEG": trim_all(cells["CODNEG"]), "NOMES": trim_all(cells["NOMES"])}
    cells |= {c: comma_number(cells[c]) for c in PRICES}
    cells |= {c: comma_number(cells[c]).try_cast("long") for c in COUNTS}
    cells["DISMES"] = comma_number(cells["DISMES"]).try_cast("int")
    rows = df.where(cells["CODNEG"].isin(tickers))
    return rows.select(date.alias("PERIODO"), *(cells[c].alias(c) for c in QUOTE_COLUMNS))


def quotes_positional(raw: DataFrame, layout: dict, tickers: list[str]) -> DataFrame:
    """A headerless year, columns ``_0``, ``_1``, ... as its layout places them."""
    at = [F.trim(F.col(f"_{i}")) for i in layout["date"]]
    date = F.try_to_date(at[0], "yyyyMMdd") if len(at) == 1 else date_from_parts(*at)
    return _typed(raw, date, {c: F.col(f"_{i}") for c, i in layout["at"].items()}, tickers)


def quotes_2021(raw: DataFrame, tickers: list[str] = BANK_TICKERS) -> DataFrame:
    """The year with a header and padded texts."""
    date = date_from_parts(*(F.trim(F.col(c)) for c in ("ANO", "MES", "DIA")))
    return _typed(raw, date, {c: F.col(c) for c in QUOTE_COLUMNS}, tickers)


def issuer_names(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Issuer-name variants to the one name used everywhere."""
    rows = list((ISSUER_NAMES if names is None else names).items())
    return canonicalise(df, "NOMES", df.sparkSession.createDataFrame(rows, "variant string, canonical string"))


def quotes_union(y2019: DataFrame, y2020: DataFrame, y2021: DataFrame, y2022: DataFrame,
                 tickers: list[str] = BANK_TICKERS, tickers_2022: list[str] = BANK_TICKERS_2022,
                 names: dict[str, str] | None = None) -> DataFrame:
    years = [
        issuer_names(quotes_positional(y2022, QUOTES_2022, tickers_2022), names),
        quotes_2021(y2021, tickers),
        quotes_positional(y2020, QUOTES_2020, tickers),
        quotes_positional(y2019, QUOTES_2019, tickers),
    ]
    return reduce(DataFrame.unionByName, years)
