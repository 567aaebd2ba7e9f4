"""Court-ordered debts: a table per year, validated, harmonised and put together."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.dates import day_first
from finmart.functions.numbers import ptbr_number
from finmart.operators.columns import insert_after, quoted, union_by_name
from finmart.operators.quality import Expected, schema_failures
from finmart.sources.files import read_text_csv

BLANK_COLUMNS = [" ", " .1", " .2"]


def yearly_names(year: int) -> dict[str, str]:
    """Published names of a year -> its own clean names, in order."""
    return {
        "Ente devedor": "ente_devedor",
        "Esfera": "esfera",
        "Montante pendente pagamento": "montante_pend_pagamento",
        f"Montante pago em {year}": f"montante_pago_{year}",
        "Saldo apos pagamento": "saldo_pos_pagamento",
        f"Precatorios expedidos entre 2/07/{year - 1} e 1/07/{year}": f"prec_exp_2_07_{year - 1}_ate_1_7_{year}",
        f"Divida em 31/12/{year}": f"divida_31_12_{year}",
    }


def of_year(raw: DataFrame, year: int) -> DataFrame:
    """Drop the blank columns, rename, and read the pt-BR amounts."""
    names = yearly_names(year)
    df = raw.drop(*BLANK_COLUMNS).withColumnsRenamed(names)
    return df.withColumns({c: ptbr_number(quoted(c)) for c in list(names.values())[2:]})


def check(raw: DataFrame, year: int, key: list[str]) -> DataFrame:
    """Failure cases of a year's table, on the texts as published (amounts without thousands points)."""
    names = yearly_names(year)
    df = raw.drop(*BLANK_COLUMNS).withColumnsRenamed(names)
    amounts = [c for c in list(names.values())[2:] if c in df.columns]
    plain = {c: F.coalesce(ptbr_number(quoted(c)).cast("string"), quoted(c)) for c in amounts}
    expected = {c: Expected("string" if i < 2 else "double") for i, c in enumerate(names.values())}
    return schema_failures(df.withColumns(plain), expected, key)


def harmonised(df: DataFrame, year: int) -> DataFrame:
    """Year-free names, and the year's dates as columns beside what they date."""
    issued, debt = f"prec_exp_2_07_{year - 1}_ate_1_7_{year}", f"divida_31_12_{year}"
    df = insert_after(df, debt, "data_divida", day_first(f"31-12-{year}"))
    df = insert_after(df, issued, "fim_periodo_expedicao", day_first(f"01-07-{year}"))
    df = insert_after(df, issued, "ini_periodo_expedicao", day_first(f"02-07-{year - 1}"))
    return df.withColumnsRenamed({issued: "precatorios_expedidos", debt: "valor_divida",
                                  f"montante_pago_{year}": "montante_pago"})


def precatorios(raw: dict[int, DataFrame]) -> DataFrame:
    return union_by_name(*(harmonised(of_year(df, year), year) for year, df in raw.items()))


class Sorted(NamedTuple):
    """``accepted`` rows, harmonised; ``failed``: ``ano``, ``motivos`` (column: reason), ``linha`` (the row as published, JSON)."""

    accepted: DataFrame
    failed: DataFrame


def _judged(raw: DataFrame, year: int) -> DataFrame:
    """The published row with ``_motivos``: what each column of the year's schema has against it, an array in column order."""
    reasons = []
    for i, (published, clean) in enumerate(yearly_names(year).items()):
        if published not in raw.columns:
            reasons.append(F.lit(f"{clean}: column_in_dataframe"))
            continue
        reasons.append(F.when(quoted(published).isNull(), f"{clean}: not_nullable"))
        if i >= 2:
            reasons.append(F.when(quoted(published).isNotNull() & ptbr_number(quoted(published)).isNull(), f"{clean}: dtype('double')"))
    return raw.withColumn("_motivos", F.array_compact(F.array(*reasons)))


def sorted_out(raw: dict[int, DataFrame]) -> Sorted:
    """All years, each row either accepted or failed with its reasons; one evaluation of the checks for each output.

    A year that lacks a column has no accepted rows.
    """
    accepted, failed = [], []
    for year, df in raw.items():
        judged = _judged(df, year)
        whole = judged.withColumns({n: F.lit(None).cast("string") for n in yearly_names(year) if n not in df.columns})
        accepted.append(harmonised(of_year(whole.where(F.size("_motivos") == 0).drop("_motivos"), year), year))
        failed.append(judged.where(F.size("_motivos") > 0).select(
            F.lit(year).alias("ano"), F.col("_motivos").alias("motivos"), F.to_json(F.struct(*(quoted(c) for c in df.columns))).alias("linha")))
    return Sorted(union_by_name(*accepted), union_by_name(*failed))


def read_years(spark: SparkSession, paths: dict[int, str]) -> dict[int, DataFrame]:
    """The tab-separated file of each year, as published; columns without a name, which a reader numbers, are left out."""
    read = {year: read_text_csv(spark, path, "\t") for year, path in paths.items()}
    return {year: df.select(*(quoted(c) for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+|\s*\.\d+", c)))
            for year, df in read.items()}
