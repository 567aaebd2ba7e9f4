"""Row filters, value replacement and null policy."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.operators.columns import quoted
from finmart.operators.joins import lookup


def keep_any_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(reduce(Column.__or__, (quoted(c).isNotNull() for c in columns)))


def keep_all_nonzero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where every column is neither zero nor NULL."""
    return df.where(reduce(Column.__and__, (quoted(c) != 0 for c in columns)))


def keep_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(reduce(Column.__and__, (quoted(c).isNotNull() for c in columns)))


def exclude_prefix(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose value does not start with ``text``; NULL values go too."""
    return df.where(~quoted(column).startswith(text))


def exclude_containing(df: DataFrame, column: str, parts: Iterable[str]) -> DataFrame:
    """Rows whose value holds none of the parts; NULL values stay."""
    hit = reduce(Column.__or__, (quoted(column).contains(p) for p in parts))
    return df.where(~F.coalesce(hit, F.lit(False)))


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose value is none of the given; NULL values stay."""
    return df.where(~F.coalesce(quoted(column).isin(list(values)), F.lit(False)))


def exclude_by_rules(df: DataFrame, rules: DataFrame, on: list[str]) -> DataFrame:
    """The same from a rule table: drop the rows that a rule names."""
    return lookup(df, rules.distinct(), on, "left_anti")


def keep_listed(df: DataFrame, listing: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in a listing of any length."""
    return lookup(df, listing.select(*on).distinct(), on, "left_semi")


def drop_header_rows(df: DataFrame, column: str) -> DataFrame:
    """Take out header lines that repeated-header appends left among the data."""
    return df.where(~F.coalesce(quoted(column) == F.lit(column), F.lit(False)))


def fill(df: DataFrame, values: dict) -> DataFrame:
    """NULL and NaN to a value, per column; a text value for a numeric column (or the reverse) is refused."""
    types = dict(df.dtypes)
    for column, value in values.items():
        is_text = types[column] == "string"
        if isinstance(value, str) != is_text:
            raise TypeError(f"cannot fill {types[column]} column {column} with {value!r}")
    floats = [c for c in values if types[c] in ("double", "float")]
    present = {c: F.when(~F.isnan(quoted(c)), quoted(c)) if c in floats else quoted(c) for c in values}
    return df.withColumns({c: F.coalesce(present[c], F.lit(v)) for c, v in values.items()})


def fill_all(df: DataFrame, value) -> DataFrame:
    """NULL to a value in every column the value's type suits."""
    return df.na.fill(value)


def replace_exact(df: DataFrame, values: dict[str, str], columns: list[str]) -> DataFrame:
    """Replace cells that equal a key as a whole."""
    return df.replace(values, subset=columns)


def canonicalise(df: DataFrame, column: str, mapping: DataFrame, variant: str = "variant",
                 canonical: str = "canonical") -> DataFrame:
    """Replace listed variants by their canonical value, from a mapping table of any length.

    A variant listed more than once takes the smallest of its canonical values.
    """
    names = mapping.groupBy(F.col(variant).alias("_variant")).agg(F.min(canonical).alias("_canonical"))
    keyed = df.withColumn("_variant", quoted(column))
    joined = lookup(keyed, names, ["_variant"], "left")
    return joined.withColumn(column, F.coalesce("_canonical", quoted(column))).drop("_variant", "_canonical")
