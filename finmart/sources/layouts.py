"""Declared schemas: nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def positions(n: int) -> T.StructType:
    """Headerless file: columns ``_0`` .. ``_{n-1}``, all text."""
    return strings(*(f"_{i}" for i in range(n)))


# The fields of the published feeds, in published order.
REPORT_VALUES = strings("TipoInstituicao", "CodInst", "AnoMes", "NomeRelatorio", "NumeroRelatorio",
                        "Grupo", "Conta", "NomeColuna", "DescricaoColuna", "Saldo")
REGISTRY = strings("CodInst", "NomeInstituicao", "SegmentoTb", "Atividade", "Uf", "Municipio", "Situacao")
QUOTE_COLUMNS = ["CODNEG", "NOMES", "ABERTURA", "MAXIMO", "MINIMO", "MEDIO", "ULTIMO", "PREOFC", "PREOFV",
                 "TOTNEG", "QUATOT", "VOLTOT", "CODISI", "DISMES"]

# For each yearly quote file, where the date parts (year, month, day) and the columns stand.
# A single date position means one yyyyMMdd field. Width is the number of fields of a headerless line.
QUOTES_2019 = {"width": 26, "date": [1],
               "at": dict(zip(QUOTE_COLUMNS, [3, 5, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 24, 25]))}
QUOTES_2020 = {"width": 28, "date": [1, 2, 3],
               "at": dict(zip(QUOTE_COLUMNS, [5, 7, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 26, 27]))}
QUOTES_2022 = {"width": 27, "date": [1, 2, 3],
               "at": dict(zip(QUOTE_COLUMNS, [5, 7, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 25, 26]))}
QUOTES_2021_HEADER = strings("TIPREG", "ANO", "MES", "DIA", "CODBDI", "CODNEG", "TPMERC", "NOMES", "ESPECI",
                             "PRAZOT", "MOEDA", "ABERTURA", "MAXIMO", "MINIMO", "MEDIO", "ULTIMO", "PREOFC",
                             "PREOFV", "TOTNEG", "QUATOT", "VOLTOT", "PREEXE", "INDOPC", "DATVEN", "FATCOT",
                             "PTOEXE", "CODISI", "DISMES")
