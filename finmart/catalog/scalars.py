"""Scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.catalog.base import KEYS, Tables, query
from finmart.functions import dates, numbers
from finmart.functions.text import trim_all

K = ", ".join(KEYS)


def _text(c) -> Column:
    return c.cast("string")


@query(f"SELECT {K}, round(l_extendedprice, 2) AS valor FROM lineitem")
def ptbr_number(t: Tables) -> DataFrame:
    text = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    return t.lineitem.withColumn("texto", text).select(*KEYS, numbers.ptbr_number("texto").alias("valor"))


@query("""SELECT o_orderkey, CAST(trunc(o_totalprice * 100000) AS BIGINT) AS inteiro, CAST(o_custkey AS VARCHAR) AS texto,
                 CAST(NULL AS BIGINT) AS ruim FROM orders""")
def cast_types(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", numbers.whole_number(_text(F.col("o_totalprice") * 100000)).alias("inteiro"),
        _text(F.col("o_custkey")).alias("texto"), numbers.whole_number("o_orderpriority").alias("ruim"))


def _period(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").cast("int").alias("AnoMes"))


@query("SELECT o_orderkey, CAST(last_day(o_orderdate) AS VARCHAR) AS fim FROM orders")
def month_end(t: Tables) -> DataFrame:
    return _period(t).select("o_orderkey", _text(dates.month_end("AnoMes")).alias("fim"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS mes FROM orders")
def year_month_text(t: Tables) -> DataFrame:
    return _period(t).select("o_orderkey", dates.year_month_text("AnoMes").alias("mes"))


@query("SELECT o_orderkey, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS inicio FROM orders")
def month_start(t: Tables) -> DataFrame:
    return _period(t).select("o_orderkey", _text(dates.month_start(dates.year_month_text("AnoMes"))).alias("inicio"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS data FROM orders")
def reformat_date(t: Tables) -> DataFrame:
    raw = t.orders.withColumn("bruta", F.date_format("o_orderdate", "yyyyMMdd"))
    return raw.select("o_orderkey", dates.reformat_date("bruta").alias("data"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data FROM orders")
def date_from_parts(t: Tables) -> DataFrame:
    parts = t.orders.select("o_orderkey", F.year("o_orderdate").alias("a"), F.month("o_orderdate").alias("m"),
                            F.dayofmonth("o_orderdate").cast("string").alias("d"))
    return parts.select("o_orderkey", _text(dates.date_from_parts("a", "m", "d")).alias("data"))


@query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data,
                 CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS hora, CAST(NULL AS VARCHAR) AS ruim FROM orders""")
def parse_iso_date(t: Tables) -> DataFrame:
    raw = t.orders.withColumn("texto", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return raw.select("o_orderkey", _text(dates.iso_date("texto")).alias("data"),
                      _text(dates.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd 22:30:15"))).alias("hora"),
                      _text(dates.iso_date("o_orderpriority")).alias("ruim"))


@query("SELECT event_id, CAST(make_date(year(ts), 12, 31) AS VARCHAR) AS fim_ano FROM events")
def year_end_date(t: Tables) -> DataFrame:
    return t.events.select("event_id", _text(dates.year_end(F.year("ts"))).alias("fim_ano"))


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) || ' 00:00:00' AS dia FROM events")
def day_trunc(t: Tables) -> DataFrame:
    return t.events.select("event_id", _text(dates.day_trunc("ts")).alias("dia"))


@query("SELECT event_id, CAST(CAST(CAST(ts AS DATE) AS TIMESTAMP) AS VARCHAR) AS meia_noite FROM events")
def date_to_midnight(t: Tables) -> DataFrame:
    return t.events.select("event_id", _text(dates.to_midnight(F.to_date("ts"))).alias("meia_noite"))


@query("SELECT event_id, CAST(year(ts) AS INTEGER) AS ano, CAST(month(ts) AS INTEGER) AS mes FROM events")
def year_month_parts(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.year("ts").alias("ano"), F.month("ts").alias("mes"))


def _roman(number) -> Column:
    """Small numbers to Roman text, to be read back."""
    tens = F.element_at(F.array(*(F.lit(x) for x in ["", "X", "XX", "XXX", "XL", "L"])), F.floor(number / 10).cast("int") + 1)
    ones = F.element_at(F.array(*(F.lit(x) for x in ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"])),
                        (number % 10).cast("int") + 1)
    return F.concat(tens, ones)


@query("""SELECT p_partkey, p_size AS numero, CAST(NULL AS INTEGER) AS ruim FROM part""")
def roman_to_int(t: Tables) -> DataFrame:
    return t.part.withColumn("romano", _roman(F.col("p_size"))).select(
        "p_partkey", dates.roman_to_int("romano").alias("numero"), dates.roman_to_int("p_brand").alias("ruim"))


@query("""SELECT o_orderkey, strftime(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH), '%Y-%m-%d') AS fim
          FROM orders""")
def quarter_end(t: Tables) -> DataFrame:
    raw = t.orders.select("o_orderkey", F.year("o_orderdate").alias("ano"), _roman(F.quarter("o_orderdate")).alias("tri"))
    return raw.select("o_orderkey", F.date_format(
        dates.quarter_end("ano", dates.roman_to_int("tri")), "yyyy-MM-dd").alias("fim"))


@query(f"""SELECT {K}, round(l_extendedprice, 1) AS preco, round(l_extendedprice / 7, 2) AS parcela FROM lineitem""")
def round_measures(t: Tables) -> DataFrame:
    df = t.lineitem.select(*KEYS, F.col("l_extendedprice").alias("preco"), (F.col("l_extendedprice") / 7).alias("parcela"))
    return numbers.round_columns(numbers.round_columns(df, ["preco"], 1), ["parcela"], 2)


@query("SELECT p_partkey, p_name AS nome FROM part")
def trim_text(t: Tables) -> DataFrame:
    padded = t.part.withColumn("cheio", F.concat(F.lit(" \t"), "p_name", F.lit("  \n")))
    return padded.select("p_partkey", trim_all("cheio").alias("nome"))


@query("SELECT p_partkey, CAST(p_retailprice AS VARCHAR) AS preco FROM part")
def comma_to_dot(t: Tables) -> DataFrame:
    raw = t.part.withColumn("texto", F.translate(_text(F.col("p_retailprice")), ".", ","))
    return raw.select("p_partkey", numbers.comma_to_dot("texto").alias("preco"))


@query("SELECT p_partkey, p_retailprice AS preco, CAST(NULL AS DOUBLE) AS ruim FROM part")
def to_number(t: Tables) -> DataFrame:
    raw = t.part.withColumn("texto", F.concat(F.lit(" "), _text(F.col("p_retailprice"))))
    return raw.select("p_partkey", numbers.to_number("texto").alias("preco"), numbers.to_number("p_brand").alias("ruim"))


@query("""SELECT strftime(last_day(CAST(mes AS DATE)), '%Y%m') AS "AnoMes", coalesce(n, 0) AS pedidos
          FROM (SELECT unnest(generate_series(min(date_trunc('month', o_orderdate)), max(date_trunc('month', o_orderdate)),
                                              INTERVAL 3 MONTH)) AS mes FROM orders) s
          LEFT JOIN (SELECT strftime(o_orderdate, '%Y%m') AS am, count(*) AS n FROM orders GROUP BY 1) o
          ON am = strftime(mes, '%Y%m')""")
def period_spine(t: Tables) -> DataFrame:
    spine = dates.period_spine(t.orders, "o_orderdate")
    counts = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("AnoMes")).agg(F.count(F.lit(1)).alias("pedidos"))
    return spine.join(counts, "AnoMes", "left").fillna(0, subset=["pedidos"])
