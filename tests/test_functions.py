import datetime as dt

import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finmart.functions import dates, names, numbers
from finmart.functions.text import deaccent, trim_all


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]


def test_numbers(spark):
    texts = ["1.234.567,89", " 12 ", "-1,5", "abc", "", None]
    assert column(spark, texts, "string", numbers.ptbr_number("x")) == [1234567.89, 12.0, -1.5, None, None, None]
    assert column(spark, ["1.234", "7", "x"], "string", numbers.ptbr_integer("x")) == [1234, 7, None]
    assert column(spark, ["12.7", "-12.7", "abc", "3000000000", None], "string", numbers.whole_number("x")) == [12, -12, None, 3000000000, None]
    assert column(spark, [2.7, float("nan"), None], "double", numbers.whole_number("x")) == [2, None, None]
    assert column(spark, ["1,5", "2.5", "-"], "string", numbers.comma_number("x")) == [1.5, 2.5, None]


def test_ptbr_round_trip(spark):
    values = [round(v * 1.37, 2) for v in range(-5000, 5000, 37)]
    texts = [f"{v:,.2f}".translate(str.maketrans(",.", ".,")) for v in values]
    assert column(spark, texts, "string", numbers.ptbr_number("x")) == values


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "i int, `a.b` double")
    assert [r[1] for r in numbers.nan_to_null(df).orderBy("i").collect()] == [None, 1.5, None]


def test_dates(spark):
    day = dt.date
    assert column(spark, [201902, 202002, 201913], "int", dates.month_end("x")) == [day(2019, 2, 28), day(2020, 2, 29), None]
    assert column(spark, ["2019-03", "bad"], "string", dates.month_start("x")) == [day(2019, 3, 1), None]
    assert column(spark, ["20190305"], "string", dates.reformat_date("x")) == ["2019-03-05"]
    assert column(spark, ["03/21", "13/21", None], "string", dates.month_slash_year("x")) == [day(2021, 3, 1), None, None]
    parts = dates.date_from_parts(F.lit(2022), F.col("x"), F.lit("5"))
    assert column(spark, ["1", "12", "13"], "string", parts) == [day(2022, 1, 5), day(2022, 12, 5), None]
    assert column(spark, [1, 2, 3, 4, 5, None], "int", dates.quarter_end(F.lit(2020), "x")) == [
        day(2020, 3, 31), day(2020, 6, 30), day(2020, 9, 30), day(2020, 12, 31), None, None]
    assert column(spark, [day(2020, 2, 29)], "date", dates.to_midnight("x")) == [dt.datetime(2020, 2, 29)]


def test_day_first_is_not_month_first(spark):
    assert column(spark, [1], "int", dates.day_first("02-07-2018")) == [dt.date(2018, 7, 2)]


def roman(n):
    out = ""
    for value, letters in [(1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"),
                           (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")]:
        out += letters * (n // value)
        n %= value
    return out


def test_roman_numerals(spark):
    numbers_ = list(range(1, 4000))
    assert column(spark, [roman(n) for n in numbers_], "string", dates.roman_to_int("x")) == numbers_
    assert column(spark, ["iv", " II ", "Q", "", None], "string", dates.roman_to_int("x")) == [4, 2, None, None, None]


def test_period_list():
    assert dates.period_list("2019-03", "2021-10") == [
        "201903", "201906", "201909", "201912", "202003", "202006", "202009", "202012", "202103", "202106", "202109"]


@given(st.integers(2000, 2030), st.integers(1, 12), st.integers(0, 60), st.sampled_from([1, 2, 3, 6]))
def test_period_list_equals_pandas(year, month, ahead, step):
    start = pd.Period(year=year, month=month, freq="M")
    end = start + ahead
    expected = pd.date_range(str(start), str(end), freq=f"{step}ME").strftime("%Y%m").tolist()
    assert dates.period_list(str(start), str(end), step) == expected


def test_text(spark):
    assert column(spark, [" \t a b \n", None], "string", trim_all("x")) == ["a b", None]
    assert column(spark, ["Captações é Ü"], "string", deaccent("x")) == ["Captacoes e U"]


@pytest.mark.parametrize("clean, raw, name", [
    (names.first_line, "Lucro \n(j)=(g)", "Lucro "),
    (names.underscored, " Ativo Total ", "Ativo_Total"),
    (names.lower_underscored, "Telefone, celular e PDA", "telefone_celular_e_pda"),
    (names.without_spaces, "Lucro Líquido \n(j) = (g)", "LucroLíquido\n(j)=(g)"),
    (names.deaccented, "Lucro_Líquido", "Lucro_Liquido"),
    (names.snake, "Canal de Acesso", "canal_de_acesso"),
    (names.snake, "SegmentoTb (%)", "segmento_tb"),
])
def test_names(clean, raw, name):
    assert clean(raw) == name


def test_rename_by_keeps_names_apart(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a\n(x)", "a\n(y)", "b"])
    assert names.rename_by(df, names.first_line).columns == ["a", "a_1", "b"]
