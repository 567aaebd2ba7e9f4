"""Adaptive narrowing of column types, from one pass of statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.operators.columns import quoted
from finmart.operators.joins import lookup
from finmart.operators.ordering import row_index

# The signed integer types and their largest magnitude, smallest first.
INTEGER_TYPES = [("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31), ("bigint", 2**63)]
CATEGORY_SHARE = 0.5


def narrowing_plan(df: DataFrame, dates: list[str] | None = None, datetimes: list[str] | None = None) -> dict[str, str]:
    """Column -> target: a smaller type, ``category``, ``date`` or ``timestamp_ntz``; columns to be left alone are absent.

    Doubles become floats, integers the smallest type that holds their range, texts with few distinct values per
    row become categories. Arrays are left alone. One aggregate over the data.
    """
    dates, datetimes = dates or [], datetimes or []
    aggs = [F.count(F.lit(1)).alias("rows")]
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            aggs.append(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(f.name))
        elif isinstance(f.dataType, T.StringType) and f.name not in (*dates, *datetimes):
            aggs.append(F.approx_count_distinct(c).alias(f.name))
    stats = df.agg(*aggs).first()

    plan = {}
    for f in df.schema.fields:
        if f.name in dates:
            plan[f.name] = "date"
        elif f.name in datetimes:
            plan[f.name] = "timestamp_ntz"
        elif isinstance(f.dataType, T.DoubleType):
            plan[f.name] = "float"
        elif isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            lo, hi = stats[f.name]["lo"], stats[f.name]["hi"]
            if lo is not None:
                kind = next(t for t, top in INTEGER_TYPES if -top <= lo and hi < top)
                if kind != f.dataType.simpleString():
                    plan[f.name] = kind
        elif isinstance(f.dataType, T.StringType) and stats["rows"]:
            if stats[f.name] / stats["rows"] < CATEGORY_SHARE:
                plan[f.name] = "category"
    return plan


def code_table(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column with codes 0, 1, ... in value order."""
    values = df.where(quoted(column).isNotNull()).select(quoted(column)).distinct()
    return row_index(values, [quoted(column)], "codigo").select(quoted(column), F.col("codigo").cast("int").alias("codigo"))


def narrow(df: DataFrame, plan: dict[str, str]) -> DataFrame:
    """Apply a plan: casts, parsed dates, and ``<column>_codigo`` in place of a category column."""
    casts = {c: quoted(c).cast(t) for c, t in plan.items() if t not in ("category", "date", "timestamp_ntz")}
    casts |= {c: quoted(c).cast("string").try_cast("timestamp_ntz") for c, t in plan.items() if t == "timestamp_ntz"}
    casts |= {c: F.try_to_date(quoted(c).cast("string")) for c, t in plan.items() if t == "date"}
    out = df.withColumns(casts)
    for c in (c for c, t in plan.items() if t == "category"):
        codes = code_table(df, c).withColumnRenamed("codigo", f"{c}_codigo")
        out = lookup(out, codes, [c], "left").drop(c)
    return out
