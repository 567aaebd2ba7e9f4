"""Income statement: registry join, cleaning and analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.functions.dates import iso_date
from finmart.functions.names import rename_by, without_spaces
from finmart.functions.numbers import nan_to_null
from finmart.operators.aggregate import describe_boxes
from finmart.operators.columns import numeric_columns, quoted
from finmart.operators.correlation import pearson, spearman
from finmart.operators.filters import exclude_containing, exclude_values, fill
from finmart.operators.joins import registry_join
from finmart.operators.ordering import row_index
from finmart.plans.fixed_values import (
    EXCLUDED_ACTIVITIES,
    EXCLUDED_ACTIVITY_PARTS,
    EXCLUDED_NAME_PARTS,
    EXCLUDED_SEGMENTS,
    INACTIVE,
    INCOME_DROPPED,
    INCOME_NAMES,
    NET_INCOME,
)


def income_join(statement: DataFrame, registry: DataFrame, keep_listings: bool = False) -> DataFrame:
    """Statements of registered institutions, with the institution's data."""
    return registry_join(statement, registry, how="inner", keep_listings=keep_listings)


def income_renamed(joined: DataFrame, names: dict[str, str] = INCOME_NAMES) -> DataFrame:
    return rename_by(joined, without_spaces).withColumnsRenamed(names).drop(*INCOME_DROPPED)


def income_filtered(df: DataFrame, segments=EXCLUDED_SEGMENTS, name_parts=EXCLUDED_NAME_PARTS,
                    activity_parts=EXCLUDED_ACTIVITY_PARTS, activities=EXCLUDED_ACTIVITIES) -> DataFrame:
    """Fill the gaps; leave out inactive institutions and what the analysis excludes."""
    df = nan_to_null(df)
    gaps = {"Atividade": "Não Informado", "SegmentoTb": "Não Informado", "Uf": "NaN"}
    gaps |= {c: 0 for c in numeric_columns(df)}
    df = exclude_values(fill(df, gaps), "Situacao", [INACTIVE])
    df = exclude_values(df, "SegmentoTb", segments)
    df = exclude_containing(df, "NomeInstituicao", name_parts)
    df = exclude_values(exclude_containing(df, "Atividade", activity_parts), "Atividade", activities)
    return df.withColumn("AnoMes", iso_date("AnoMes")).withColumns({"Ano": F.year("AnoMes"), "Mes": F.month("AnoMes")})


def income_clean(joined: DataFrame, measure: str = NET_INCOME, tie_break: list[str] | None = None, **rules) -> DataFrame:
    """Cleaned rows numbered from the highest ``measure`` down."""
    df = income_filtered(income_renamed(joined), **rules)
    order = [F.desc(f"`{measure}`"), *(quoted(c) for c in tie_break or ["CodInst", "AnoMes"])]
    return row_index(df, order)


def income_stats(clean: DataFrame, measure: str = NET_INCOME, periods: tuple[str, ...] = ("Mes", "Ano")) -> DataFrame:
    """Describe and box-plot numbers of a measure per month and per year, one row per period value."""
    # every row counts once per kind of period, so one pass serves all kinds
    kinds = F.array(*(F.struct(F.lit(p).alias("periodo"), F.col(p).alias("valor")) for p in periods))
    long = clean.select(F.explode(kinds).alias("p"), quoted(measure).alias("_v")).select("p.*", "_v")
    return describe_boxes(long, "_v", ["periodo", "valor"])


def income_correlations(clean: DataFrame, columns: list[str]) -> DataFrame:
    """``metodo``, ``a``, ``b``, ``r``: both correlation matrices of the cleaned statement."""
    told = [found(clean, columns).select(F.lit(name).alias("metodo"), "a", "b", "r")
            for name, found in (("pearson", pearson), ("spearman", spearman))]
    return told[0].unionByName(told[1])
