"""SQL questions over a summary view with NomeInstituicao, SegmentoTb, Atividade, Patrimonio_Liquido, Lucro_Liquido,
Cart_Cred_Classif and Ativo_Total."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

QUESTIONS = {
    # who earns most
    "largest_banks": """
        SELECT NomeInstituicao, max(Patrimonio_Liquido) AS patrimonio, round(sum(Lucro_Liquido), 2) AS lucro,
               max(Cart_Cred_Classif) AS carteira
        FROM {summary} GROUP BY NomeInstituicao ORDER BY lucro DESC, NomeInstituicao""",
    # the long tail, by credit portfolio
    "tail_banks": """
        SELECT NomeInstituicao, min(Patrimonio_Liquido) AS patrimonio, round(sum(Lucro_Liquido), 2) AS lucro,
               min(Cart_Cred_Classif) AS carteira
        FROM {summary} GROUP BY NomeInstituicao ORDER BY carteira, NomeInstituicao""",
    # who lost money
    "negative_profit": """
        SELECT NomeInstituicao, min(Patrimonio_Liquido) AS patrimonio, min(Lucro_Liquido) AS menor_lucro,
               max(Lucro_Liquido) AS maior_lucro
        FROM {summary} WHERE Lucro_Liquido < 0 GROUP BY NomeInstituicao ORDER BY menor_lucro, NomeInstituicao""",
    # profit on little equity
    "low_equity_profit": """
        SELECT NomeInstituicao, min(Patrimonio_Liquido) AS patrimonio, min(Lucro_Liquido) AS menor_lucro,
               max(Lucro_Liquido) AS maior_lucro
        FROM {summary} WHERE Lucro_Liquido > 0 GROUP BY NomeInstituicao ORDER BY menor_lucro, NomeInstituicao""",
    # credit, assets and best profit, by average profit (which is not shown)
    "by_average_profit": """
        SELECT NomeInstituicao, min(Cart_Cred_Classif) AS carteira, min(Ativo_Total) AS ativo,
               max(Lucro_Liquido) AS maior_lucro
        FROM {summary} WHERE Lucro_Liquido > 0 GROUP BY NomeInstituicao
        ORDER BY avg(Lucro_Liquido) DESC, NomeInstituicao""",
    # profitable rows, best first, without the profit
    "profitable": """
        SELECT NomeInstituicao, SegmentoTb, Atividade
        FROM {summary} WHERE Lucro_Liquido > 0 ORDER BY Lucro_Liquido DESC""",
}


def ask(spark: SparkSession, question: str, summary: DataFrame) -> DataFrame:
    return spark.sql(QUESTIONS[question], summary=summary)
