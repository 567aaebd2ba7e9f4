"""Credit portfolio: report values to one row per institution and period, then cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.functions.dates import month_end
from finmart.functions.numbers import nan_to_null, whole_number
from finmart.operators.aggregate import pivot_sum
from finmart.operators.columns import quoted
from finmart.operators.filters import keep_all_nonzero, keep_any_not_null, keep_not_null
from finmart.sources.layouts import strings

OPERATIONS = "Quantidade de operações ativas"
CLIENTS = "Quantidade de clientes com operações ativas"
SHORT = {OPERATIONS: "Qtd_de_operacoes_ativas", CLIENTS: "Qtd_de_clientes_com_operacoes_ativas"}

# The report fields the extract reads; documents hold more (layouts.REPORT_VALUES).
EXTRACTED = strings("CodInst", "AnoMes", "NomeColuna", "Saldo")


def credit_extract(report: DataFrame, names: list[str]) -> DataFrame:
    """Report rows (all text) to one row per institution and period, one column per report column of ``names``."""
    return pivot_sum(report, ["CodInst", "AnoMes"], "NomeColuna", "Saldo", names)


def credit_clean(portfolio: DataFrame) -> DataFrame:
    """Named institutions with operations and clients, counts as int, the period as month end."""
    df = nan_to_null(portfolio).withColumnsRenamed(SHORT | {"AnoMes": "Periodo"})
    df = df.withColumns({c: whole_number(quoted(c)) for c in SHORT.values()} | {"Periodo": month_end("Periodo")})
    counts = list(SHORT.values())
    df = keep_all_nonzero(keep_any_not_null(df, counts), counts)
    return keep_not_null(df, "NomeInstituicao")


def by_clients(portfolio: DataFrame) -> DataFrame:
    return portfolio.orderBy(F.desc(SHORT[CLIENTS]))
