"""Number parsing and rounding. Bad text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ptbr_number(c) -> Column:
    """``1.234.567,89`` (thousands ``.``, decimal ``,``) to double."""
    text = F.replace(F.replace(F.trim(_c(c)), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return text.try_cast("double")


def ptbr_integer(c) -> Column:
    """``12.345`` (thousands ``.``) to long."""
    return F.replace(F.trim(_c(c)), F.lit("."), F.lit("")).try_cast("long")


def comma_to_dot(c) -> Column:
    return F.replace(_c(c), F.lit(","), F.lit("."))


def comma_number(c) -> Column:
    """``12,5`` or ``12.5`` to double."""
    return comma_to_dot(F.trim(_c(c))).try_cast("double")


def to_number(c) -> Column:
    return F.trim(_c(c).cast("string")).try_cast("double")


def whole_number(c) -> Column:
    """Integer part as long: text, ``'12.7'`` included, and doubles are cut toward zero, digit by digit.

    NaN, non-numbers and what no long can hold give NULL.
    """
    return F.trim(_c(c).cast("string")).try_cast("decimal(38,18)").try_cast("long")


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value and one zero: in any float column NaN becomes NULL, and -0.0 becomes 0.0."""
    floats = [f for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    own = {f.name: F.col(f"`{f.name}`") for f in floats}
    return df.withColumns({f.name: F.when(~F.isnan(own[f.name]), own[f.name] + F.lit(0).cast(f.dataType)) for f in floats})


def round_columns(df: DataFrame, columns: list[str], places: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), places) for c in columns})


def text_to_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Comma-decimal text columns to double, all in one projection."""
    return df.withColumns({c: comma_number(F.col(f"`{c}`")) for c in columns})
