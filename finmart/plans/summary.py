"""Financial summary: period to date, rounded measures, filled gaps, short names, no cooperatives."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finmart.functions.dates import month_start, year_month_text
from finmart.functions.numbers import nan_to_null, round_columns
from finmart.operators.aggregate import group_sums
from finmart.operators.filters import exclude_prefix, fill

LIABILITIES = "Passivo_Circulante_e_Exigível_a_Longo_Prazo_e_Resultados_de_Exercícios_Futuros"
MEASURES = ["Ativo_Total", "Captações", "Carteira_de_Crédito_Classificada", "Lucro_Líquido", LIABILITIES,
            "Patrimônio_Líquido"]
TEXTS = ["SegmentoTb", "Atividade", "Uf", "Municipio"]
SHORT = {"Carteira_de_Crédito_Classificada": "Cart_Cred_Classif", LIABILITIES: "PassCircExigLongPrzResExer_Fut"}
PLAIN = {"Lucro_Líquido": "Lucro_Liquido", "Patrimônio_Líquido": "Patrimonio_Liquido"}


def summary_filled(summary: DataFrame, measures: list[str] = MEASURES, texts: list[str] = TEXTS) -> DataFrame:
    df = nan_to_null(summary).withColumn("AnoMes", month_start(year_month_text("AnoMes")))
    return fill(round_columns(df, measures, 2), {m: 0.0 for m in measures} | {t: "Na" for t in texts})


def summary_clean(summary: DataFrame, measures: list[str] = MEASURES, texts: list[str] = TEXTS,
                  cooperative: str = "COOPERATIVA") -> DataFrame:
    df = summary_filled(summary, measures, texts).withColumnsRenamed(SHORT)
    return exclude_prefix(df, "NomeInstituicao", cooperative)


def summary_by_place(filled: DataFrame) -> DataFrame:
    """Profit, liabilities and equity per institution, state and town."""
    return group_sums(filled, ["NomeInstituicao", "Uf", "Municipio"], ["Lucro_Líquido", LIABILITIES, "Patrimônio_Líquido"])


def summary_view(clean: DataFrame, name: str) -> None:
    """Offer the cleaned summary to SQL, with unaccented measure names."""
    clean.withColumnsRenamed(PLAIN).createOrReplaceTempView(name)
