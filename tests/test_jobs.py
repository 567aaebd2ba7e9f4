import datetime as dt

import pytest
from pyspark.sql import functions as F

from finmart.plans import branches, cards, channels, credit, income, indebtedness, precatorios, publish, quotes, summary
from finmart.plans.fixed_values import (
    BANK_TICKERS, BRANCH_COLUMNS, BRANCH_LETTERS, EXCLUDED_SEGMENTS, INCOME_NAMES, INDEBTEDNESS_PERCENTAGES,
    INDEBTEDNESS_RAW_NAMES, ISSUER_NAMES, NET_INCOME)
from finmart.sources.layouts import QUOTES_2019, QUOTES_2020, QUOTES_2021_HEADER, QUOTES_2022, REPORT_VALUES, positions, strings


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_fixed_values():
    assert len(BANK_TICKERS) == len(set(BANK_TICKERS)) == 46
    assert len(ISSUER_NAMES) == 40 and len(EXCLUDED_SEGMENTS) == 9 and len(INDEBTEDNESS_RAW_NAMES) == 10
    assert not set(ISSUER_NAMES) & set(ISSUER_NAMES.values())
    assert len(INCOME_NAMES) == 31


def test_credit(spark):
    def value(inst, period, name, amount):
        return ("2", inst, period, "r", "10", "g", "c", name, "d", amount)
    data = [value("1", "201903", "A", "12.7"), value("1", "201903", "A", "3"), value("1", "201903", "B", "abc"),
            value("1", "201906", "A", None), value("2", "201903", "B", "-5.9")]
    wide = credit.credit_extract(spark.createDataFrame(data, REPORT_VALUES), ["A", "B"])
    assert sorted(rows(wide, "CodInst", "AnoMes", "A", "B"), key=str) == [
        ("1", "201903", 15, None), ("1", "201906", None, None), ("2", "201903", None, -5)]

    nan = float("nan")
    portfolio = spark.createDataFrame(
        [("a", "N", 201903, 5.0, 2.0), ("b", "N", 201903, None, None), ("c", "N", 201903, 5.0, None), ("d", "N", 201903, 0.0, 2.0),
         ("e", "N", 201903, nan, 2.0), ("f", None, 201903, 5.0, 2.0), ("g", "M", 202002, 7.9, 1.2)],
        f"CodInst string, NomeInstituicao string, AnoMes int, `{credit.OPERATIONS}` double, `{credit.CLIENTS}` double")
    clean = credit.by_clients(credit.credit_clean(portfolio))
    assert rows(clean) == [("a", "N", dt.date(2019, 3, 31), 5, 2), ("g", "M", dt.date(2020, 2, 29), 7, 1)]


def test_summary(spark):
    columns = ", ".join(f"`{m}` double" for m in summary.MEASURES)
    data = [("BANCO", "S", None, None, "X", 201903, 1.005, 2.344, None, -0.125, 1.0, 1.0),
            ("COOPERATIVA Y", "S", "A", "SP", "X", 201906, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
            (None, "S", "A", "SP", "X", 201906, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(data, f"NomeInstituicao string, SegmentoTb string, Atividade string, Uf string, Municipio string, AnoMes int, {columns}")
    clean = summary.summary_clean(df)
    assert rows(clean, "NomeInstituicao", "Atividade", "Uf", "AnoMes", "`Captações`", "Cart_Cred_Classif", "`Lucro_Líquido`") == [
        ("BANCO", "Na", "Na", dt.date(2019, 3, 1), 2.34, 0.0, -0.13)]
    assert summary.summary_by_place(summary.summary_filled(df)).count() == 3
    summary.summary_view(clean, "resumo_teste")
    assert spark.sql("SELECT Lucro_Liquido FROM resumo_teste").first()[0] == -0.13


def quote_line(layout, date_parts, ticker, name, volume):
    cells = ["0"] * layout["width"]
    for place, part in zip(layout["date"], date_parts):
        cells[place] = part
    values = dict.fromkeys(layout["at"], "1.5") | {"CODNEG": ticker, "NOMES": name, "TOTNEG": "12", "QUATOT": "3400",
                                                  "VOLTOT": volume, "CODISI": "BR1", "DISMES": "101"}
    for column, place in layout["at"].items():
        cells[place] = values[column]
    return tuple(cells)


def test_quotes(spark):
    def raw(layout, *lines):
        return spark.createDataFrame([quote_line(layout, *line) for line in lines], positions(layout["width"]))

    y2019 = raw(QUOTES_2019, (["20190102"], "ITUB4", "ITAUUNIBANCO", "100.5"), (["20190102"], "PETR4", "PETROBRAS", "1"))
    y2020 = raw(QUOTES_2020, (["2020", "1", "2"], "BBAS3", "BRASIL", "7"))
    y2022 = raw(QUOTES_2022, (["2022", "12", "30"], "NASDAQ", "PINE        P", "100,25"), (["2022", "1", "3"], "BBDC4", "BRADESCO    O", "5"))
    header = dict.fromkeys(QUOTES_2021_HEADER.fieldNames(), "1") | {
        "ANO": "2021", "MES": "3", "DIA": "9", "CODNEG": "SANB11      ", "NOMES": "SANTANDER BR\t"}
    y2021 = spark.createDataFrame([tuple(header.values())], QUOTES_2021_HEADER)
    out = quotes.quotes_union(y2019, y2020, y2021, y2022)
    assert len(out.columns) == 15
    assert sorted(rows(out, "PERIODO", "CODNEG", "NOMES", "VOLTOT", "QUATOT")) == [
        (dt.date(2019, 1, 2), "ITUB4", "ITAUUNIBANCO", 100.5, 3400), (dt.date(2020, 1, 2), "BBAS3", "BRASIL", 7.0, 3400),
        (dt.date(2021, 3, 9), "SANB11", "SANTANDER BR", 1.0, 1), (dt.date(2022, 1, 3), "BBDC4", "BRADESCO", 5.0, 3400),
        (dt.date(2022, 12, 30), "NASDAQ", "PINE", 100.25, 3400)]


def test_income(spark):
    profit = "Lucro Líquido \n(j) = (g) + (h) + (i)"
    schema = f"CodInst string, NomeInstituicao string, SegmentoTb string, Atividade string, Uf string, Situacao string, AnoMes string, `{profit}` double"
    keep = ("1", "BANCO A", "Banco Múltiplo", None, None, "A", "2020-03-31", 5.0)
    data = [keep, ("2", "BANCO B", None, "Varejo", "SP", "A", "2020-06-30", None),
            ("3", "BANCO COOPERATIVO", "Banco Múltiplo", "Varejo", "SP", "A", "2020-03-31", 1.0),
            ("4", "X", "Banco Múltiplo", "Varejo", "SP", "I", "2020-03-31", 1.0),
            ("5", "X", "Banco Múltiplo", "Cambio", "SP", "A", "2020-03-31", 1.0),
            ("6", "X", "Banco Múltiplo", "Indústria - BNDES", "SP", "A", "2020-03-31", 1.0),
            *((f"s{i}", "X", s, "Varejo", "SP", "A", "2020-03-31", 1.0) for i, s in enumerate(EXCLUDED_SEGMENTS))]
    out = income.income_clean(spark.createDataFrame(data, schema))
    assert sorted(rows(out, "indice", "CodInst", "SegmentoTb", "Atividade", "Uf", f"`{NET_INCOME}`", "Ano", "Mes")) == [
        (0, "1", "Banco Múltiplo", "Não Informado", "NaN", 5.0, 2020, 3), (1, "2", "Não Informado", "Varejo", "SP", 0.0, 2020, 6)]


def test_branches_and_channels(spark):
    letters = BRANCH_LETTERS[2019]
    cells = [("f", "quadro 4", 3, r, "B", "nota") for r in [*range(1, 9), *range(11, 18)]]
    cells += [("f", "quadro 4", 3, 9, c, str(i)) for i, c in enumerate(letters)]
    cells += [("f", "quadro 4", 3, 10, "B", "SP"), ("f", "quadro 4", 3, 10, "C", "x"), ("f", "quadro 4", 3, 10, "ZZ", "other")]
    df = spark.createDataFrame(cells, "file string, sheet string, sheet_index int, row int, col string, value string")
    out = branches.branches(df.withColumn("ano", F.lit(2019)), branches.branch_layouts(spark))
    assert out.columns == [*BRANCH_COLUMNS, "ano"]
    assert sorted(rows(out), key=str) == [("0", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 2019), ("SP", *[None] * 6, 2019)]

    per_bank = spark.createDataFrame([("f", "s", 0, r, c, v) for r, c, v in [(1, "A", "t"), (7, "A", "1"), (7, "B", "Banco"), (8, "A", "2")]],
                                     "file string, sheet string, sheet_index int, row int, col string, value string")
    assert rows(branches.branches_by_bank(per_bank, {"A": "n", "B": "banco"})) == [("Banco",)]

    raw = spark.createDataFrame([("ATM", "5")], ["Canal de Acesso", "2019"])
    assert channels.access_channels(raw).columns == ["Canal_Acesso", "ano_2019"]
    sheet = spark.createDataFrame([("Saque", "5", None)], "`Telefone, celular e PDA` string, `2019` string, `2020` string")
    assert rows(channels.operations_union({"phone": sheet, "atm": sheet}))[0] == ("Saque", 5.0, 0.0, "phone")


def test_cards(spark):
    atm = cards.atm_terminals(spark.createDataFrame([("SP", "1.234", None)], "UF string, `2019` string, `2020` string"))
    assert atm.columns == ["ESTADO", "ano_2019", "ano_2020"] and rows(atm) == [("SP", 1234, None)]
    debit = cards.debit_cards(spark.createDataFrame([(2020, q, "12.345,67") for q in ("I", "II", "III", "IV")],
                                                    "Ano int, Trimestre string, Quantidade string"), ["Quantidade"])
    assert rows(debit) == [("2020-03-31", 1, 12345.67), ("2020-06-30", 2, 12345.67), ("2020-09-30", 3, 12345.67), ("2020-12-31", 4, 12345.67)]
    assert rows(cards.rewards(spark.createDataFrame([(2020, "1,5")], "Ano int, v string"), ["v"])) == [(dt.date(2020, 12, 31), 1.5)]


def test_precatorios(spark):
    def raw(year, *data):
        return spark.createDataFrame(data, strings(*precatorios.yearly_names(year), *precatorios.BLANK_COLUMNS))

    amounts = ("1.234,5", "2,0", "3", "4", "5")
    frames = {2019: raw(2019, ("Ente", "Estado", *amounts, None, None, None)), 2020: raw(2020, ("Outro", "Município", *amounts, "", "", ""))}
    out = precatorios.precatorios(frames)
    assert out.columns == ["ente_devedor", "esfera", "montante_pend_pagamento", "montante_pago", "saldo_pos_pagamento",
                           "precatorios_expedidos", "ini_periodo_expedicao", "fim_periodo_expedicao", "valor_divida", "data_divida"]
    assert ("Ente", "Estado", 1234.5, 2.0, 3.0, 4.0, dt.date(2018, 7, 2), dt.date(2019, 7, 1), 5.0, dt.date(2019, 12, 31)) in rows(out)

    bad = raw(2019, (None, "Estado", "x", *amounts[1:], None, None, None)).drop("Saldo apos pagamento")
    found = {r[1:] for r in rows(precatorios.check(bad.withColumn("k", F.lit("1")), 2019, ["k"]))}
    assert found == {("ente_devedor", "not_nullable", None), ("montante_pend_pagamento", "dtype('double')", "x"),
                     ("saldo_pos_pagamento", "column_in_dataframe", None)}


def test_precatorios_are_sorted_out(spark):
    def raw(year, *data):
        return spark.createDataFrame(data, strings(*precatorios.yearly_names(year)))
    good = ("A", "B", "1.000,5", "1", "2", "3", "4")
    told = precatorios.sorted_out({2019: raw(2019, good, (None, "B", "x", "1", "2", None, "4")),
                                   2020: raw(2020, good).drop("Esfera")})
    assert [r["montante_pend_pagamento"] for r in told.accepted.collect()] == [1000.5]
    failed = {r["ano"]: (r["motivos"], r["linha"]) for r in told.failed.collect()}
    assert failed[2019][0] == ["ente_devedor: not_nullable", "montante_pend_pagamento: dtype('double')",
                               "prec_exp_2_07_2018_ate_1_7_2019: not_nullable"]
    assert failed[2020][0] == ["esfera: column_in_dataframe"] and '"Ente devedor":"A"' in failed[2020][1]


def test_indebtedness(spark):
    cells = ["1,5", "-", "-1,5", *["0,25"] * 6]
    df = spark.createDataFrame([("03/21", *cells), (None, *cells)], strings("Data", *INDEBTEDNESS_PERCENTAGES))
    out = rows(indebtedness.indebtedness(df))
    assert out[0][:4] == (dt.date(2021, 3, 1), 1.5, 0.0, -1.5) and out[1][0] is None
    originals = indebtedness.indebtedness_originals(df)
    assert originals.columns == INDEBTEDNESS_RAW_NAMES


def test_original_names(spark):
    names = ["CodInst", "Resultado de Câmbio \n(a5)", "Resultado de Câmbio \n(b4)", "x", "y", "z"]
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], names)
    assert publish.income_original(df).columns == [
        "CodInst", "Receitas_de_Operações_de_Câmbio", "Despesas_de_Operações_de_Câmbio", "x", "y", "z"]
    long = spark.createDataFrame([(1,)], ["Passivo Circulante e Exigível a Longo Prazo e Resultados de Exercícios Futuros \n(h)"])
    assert publish.summary_original(long).columns == ["Passivo_Circ_Longo_Prazo_e_Result_Exer_Futuros"]


@pytest.mark.parametrize("period", ["Mes", "Ano"])
def test_income_stats_cover_all_rows(spark, period):
    df = spark.range(1000).select((F.col("id") % 12 + 1).alias("Mes"), (F.col("id") % 2 + 2020).alias("Ano"), F.col("id").cast("double").alias("v"))
    out = income.income_stats(df, "v").where(F.col("periodo") == period)
    assert out.agg(F.sum("n")).first()[0] == 1000
