"""Calendar columns: ``yyyyMM`` periods, date parts, quarters, midnight timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """``yyyy-MM`` text to the first day of the month."""
    return F.try_to_date(_c(c), "yyyy-MM")


def month_end(c) -> Column:
    """``yyyyMM`` (number or text) to the last day of the month."""
    return F.last_day(F.try_to_date(_c(c).cast("string"), "yyyyMM"))


def year_month_text(c) -> Column:
    """``yyyyMM`` (number or text) to ``yyyy-MM`` text."""
    text = _c(c).cast("string")
    return F.concat(text.substr(1, 4), F.lit("-"), text.substr(5, 2))


def reformat_date(c, source: str = "yyyyMMdd", target: str = "yyyy-MM-dd") -> Column:
    return F.date_format(F.try_to_date(_c(c).cast("string"), source), target)


def date_from_parts(year, month, day) -> Column:
    """Date from three columns, text or number, one or two digits; impossible dates give NULL."""
    return F.try_to_date(F.concat_ws("-", *(_c(p).cast("string") for p in (day, month, year))), "d-M-yyyy")


def iso_date(c) -> Column:
    """A date, a timestamp, or the text of either to its day; other text gives NULL."""
    text = _c(c).cast("string")
    return F.coalesce(F.try_to_date(text, "yyyy-MM-dd"),
                      F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d"), text.try_cast("timestamp_ntz").cast("date")))


def month_slash_year(c) -> Column:
    """``MM/yy`` to the first day of the month."""
    return F.try_to_date(F.concat(F.lit("01/"), _c(c)), "dd/MM/yy")


def day_first(text: str) -> Column:
    """A literal date written day-month-year."""
    return F.lit(dt.datetime.strptime(text, "%d-%m-%Y").date())


def year_end(year) -> Column:
    return F.make_date(_c(year).cast("int"), F.lit(12), F.lit(31))


def to_midnight(c) -> Column:
    """A date as a timestamp without zone at 00:00."""
    return _c(c).cast("date").cast("timestamp_ntz")


def day_trunc(c) -> Column:
    return F.date_trunc("DAY", _c(c))


def roman_to_int(c) -> Column:
    """A Roman numeral as int: a letter smaller than its right neighbour counts negative.

    Text with other characters, empty text and NULL give NULL.
    """
    text = F.upper(F.trim(_c(c)))
    worth = F.create_map(*(F.lit(x) for pair in
                           {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}.items()
                           for x in pair))
    digits = F.transform(F.filter(F.split(text, ""), lambda ch: ch != ""), lambda ch: worth[ch])
    # carry: (total, digit to the right), read from right to left
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("right"))

    def step(acc, digit):
        signed = F.when(digit < acc["right"], -digit).otherwise(digit)
        return F.struct((acc["total"] + signed).alias("total"), digit.alias("right"))

    value = F.aggregate(F.reverse(digits), start, step, lambda acc: acc["total"])
    return F.when(text.rlike("^[IVXLCDM]+$"), value)


def quarter_end(year, quarter) -> Column:
    """Last day of a quarter; a quarter outside 1..4 gives NULL."""
    q = _c(quarter).cast("int")
    return F.when(q.between(1, 4), F.last_day(F.make_date(_c(year).cast("int"), q * 3, F.lit(1))))


def period_list(start: str, end: str, months: int = 3) -> list[str]:
    """Every ``months``-th month from ``start`` through ``end`` (``yyyy-MM``), as ``yyyyMM``.

    A month counts when its last day is not after the first day of ``end``'s month.
    """
    y, m = map(int, start.split("-"))
    ey, em = map(int, end.split("-"))
    out = []
    while (y, m) < (ey, em):
        out.append(f"{y:04d}{m:02d}")
        y, m = y + (m - 1 + months) // 12, (m - 1 + months) % 12 + 1
    return out


def period_spine(df: DataFrame, date_column: str, months: int = 3, name: str = "AnoMes") -> DataFrame:
    """The quarterly periods spanned by a date column, one row each, as ``yyyyMM`` text."""
    span = df.agg(F.trunc(F.min(date_column), "month").alias("lo"),
                  F.trunc(F.max(date_column), "month").alias("hi"))
    step = F.expr(f"interval {months} month")
    return span.select(F.explode(F.sequence("lo", "hi", step)).alias("d")).select(
        F.date_format(F.last_day("d"), "yyyyMM").alias(name))
