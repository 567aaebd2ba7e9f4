"""Null, duplicate, schema and column profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.functions.numbers import nan_to_null
from finmart.operators.aggregate import QUARTILE_NAMES, describe_numeric, text_key, texts_to_rows, top_values
from finmart.operators.columns import numeric_columns, quoted

# A duplicated row is written out again in runs of this many copies.
COPIES_PER_RUN = 10_000


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the NULLs of every column; NaN counts as NULL."""
    df = nan_to_null(df)
    return df.agg(*(F.count_if(quoted(c).isNull()).alias(c) for c in df.columns))


def null_profile(df: DataFrame) -> DataFrame:
    """(coluna, nulos, preenchidos, proporcao) for every column, in one pass; NaN counts as NULL."""
    df = nan_to_null(df)
    cells = [F.struct(F.lit(c).alias("coluna"), F.count_if(quoted(c).isNull()).alias("nulos"),
                      F.count(quoted(c)).alias("preenchidos"),
                      F.avg(quoted(c).isNull().cast("double")).alias("proporcao")) for c in df.columns]
    return df.agg(F.array(*cells).alias("_all")).selectExpr("inline(_all)")


def schema_info(df: DataFrame) -> DataFrame:
    """(posicao, coluna, tipo, preenchidos) for every column."""
    cells = [F.struct(F.lit(i).alias("posicao"), F.lit(n).alias("coluna"), F.lit(t).alias("tipo"),
                      F.count(quoted(n)).alias("preenchidos")) for i, (n, t) in enumerate(df.dtypes)]
    return df.agg(F.array(*cells).alias("_all")).selectExpr("inline(_all)")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.lit(len(df.columns)).alias("colunas"))


def distinct_counts(df: DataFrame) -> DataFrame:
    """(coluna, distintos): NULL is not a value; an all-NULL column has 0. Long texts are told apart by their digests."""
    cells = texts_to_rows(df, df.columns).select("coluna", text_key(F.col("valor")).alias("valor"))
    return cells.groupBy("coluna").agg(F.count_distinct("valor").alias("distintos"))


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with at most one distinct value."""
    return distinct_counts(df).where(F.col("distintos") <= 1)


def duplicate_count(df: DataFrame, name: str = "duplicadas") -> DataFrame:
    """How many rows repeat an earlier one."""
    groups = df.groupBy(*(quoted(c) for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Every repeat of a row beyond its first, all of them.

    Equal rows are counted before they move, and a row with many repeats is written out again in runs that
    are spread over the cluster, so no task handles all copies of one row.
    """
    cols = [quoted(c) for c in df.columns]
    extra = df.groupBy(*cols).agg((F.count(F.lit(1)) - 1).alias("_more")).where(F.col("_more") > 0)
    runs = extra.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_more") - 1) / COPIES_PER_RUN))))
    spread = runs.repartition(*cols, F.col("_run"))
    left = F.least(F.lit(COPIES_PER_RUN), F.col("_more") - F.col("_run") * COPIES_PER_RUN)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), left.cast("int")))).select(*cols)


def column_profile(df: DataFrame, **options) -> DataFrame:
    """One row per column: type, filled, missing, distinct, most frequent value, numbers' statistics and zeros."""
    df = nan_to_null(df)
    numeric = set(numeric_columns(df))
    cells = [F.struct(
        F.lit(n).alias("coluna"), F.lit(t).alias("tipo"), F.count(quoted(n)).alias("preenchidos"),
        F.count_if(quoted(n).isNull()).alias("nulos"),
        (F.count_if(quoted(n) == 0) if n in numeric else F.lit(None)).cast("long").alias("zeros"))
        for n, t in df.dtypes]
    base = df.agg(F.array(*cells).alias("_all")).selectExpr("inline(_all)")
    out = base.join(top_values(df, df.columns), "coluna", "left")  # every side holds one row per column
    if numeric:
        stats = describe_numeric(df, **options).select("coluna", "media", "desvio", "minimo", *QUARTILE_NAMES, "maximo")
        out = out.join(stats, "coluna", "left")
    return out.fillna(0, subset=["distintos"])


@dataclass(frozen=True)
class Expected:
    """What a column must be: ``kind`` is a Spark type name; text columns pass if the text parses as it."""

    kind: str
    nullable: bool = False
    required: bool = True


def _failures(df: DataFrame, expected: dict[str, Expected]) -> list[tuple[str, str, Column]]:
    """(column, check, is it broken on this row) for the columns the frame has."""
    out = []
    for name, rule in expected.items():
        if name not in df.columns:
            continue
        if not rule.nullable:
            out.append((name, "not_nullable", quoted(name).isNull()))
        if rule.kind != "string":
            out.append((name, f"dtype('{rule.kind}')",
                        quoted(name).isNotNull() & quoted(name).try_cast(rule.kind).isNull()))
    return out


def schema_failures(df: DataFrame, expected: dict[str, Expected], key: list[str]) -> DataFrame:
    """Every failure case: (key columns, coluna, verificacao, valor); nothing is raised.

    A required column that is missing gives one row with NULL keys.
    """
    cases = [F.when(bad, F.struct(F.lit(c).alias("coluna"), F.lit(check).alias("verificacao"),
                                  quoted(c).cast("string").alias("valor"))) for c, check, bad in _failures(df, expected)]
    found = df.select(*(quoted(k) for k in key), F.explode(F.array_compact(F.array(*cases))).alias("_f")).select(
        *(quoted(k) for k in key), "_f.*")
    for name, rule in expected.items():
        if rule.required and name not in df.columns:
            blank = df.sparkSession.range(1).select(*(F.lit(None).cast(df.schema[k].dataType).alias(k) for k in key))
            found = found.unionByName(blank.withColumns({
                "coluna": F.lit(name), "verificacao": F.lit("column_in_dataframe"), "valor": F.lit(None).cast("string")}))
    return found


def schema_summary(failures: DataFrame) -> DataFrame:
    return failures.groupBy("coluna", "verificacao").agg(F.count(F.lit(1)).alias("falhas"))
