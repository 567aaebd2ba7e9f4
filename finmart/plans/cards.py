"""ATM terminals, debit cards and reward programmes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.dates import quarter_end, roman_to_int, year_end
from finmart.functions.numbers import ptbr_integer, ptbr_number
from finmart.operators.columns import prefix, quoted
from finmart.sources.files import read_text_csv


def atm_terminals(raw: DataFrame, state: str = "UF") -> DataFrame:
    """States by year: counts with thousands points to numbers, years prefixed."""
    counts = raw.withColumns({c: ptbr_integer(quoted(c)) for c in raw.columns if c != state})
    return prefix(counts, "ano_", {state: "ESTADO"})


def debit_cards(raw: DataFrame, amounts: list[str]) -> DataFrame:
    """Roman quarter to a number, ``Ano`` to the quarter's last day as text, pt-BR numbers to double."""
    quarter = roman_to_int("Trimestre")
    df = raw.withColumns({a: ptbr_number(quoted(a)) for a in amounts})
    return df.withColumns({"Ano": F.date_format(quarter_end("Ano", quarter), "yyyy-MM-dd"), "Trimestre": quarter})


def rewards(raw: DataFrame, amounts: list[str]) -> DataFrame:
    """``Ano`` to the last day of the year, pt-BR numbers to double."""
    return raw.withColumns({a: ptbr_number(quoted(a)) for a in amounts} | {"Ano": year_end("Ano")})


def read_atm_terminals(spark: SparkSession, path: str) -> DataFrame:
    """From the ``;`` file on, with whatever years it has."""
    return atm_terminals(read_text_csv(spark, path, ";"))


def read_debit_cards(spark: SparkSession, path: str) -> DataFrame:
    raw = read_text_csv(spark, path, ";")
    return debit_cards(raw.withColumn("Ano", F.col("Ano").try_cast("int")), [c for c in raw.columns if c not in ("Ano", "Trimestre")])


def read_rewards(spark: SparkSession, path: str) -> DataFrame:
    raw = read_text_csv(spark, path, ";")
    return rewards(raw.withColumn("Ano", F.col("Ano").try_cast("int")), [c for c in raw.columns if c != "Ano"])
