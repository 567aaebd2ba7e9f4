"""The dataset jobs, run on the given tables dressed as the raw feeds."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.catalog.aggregates import PRIORITIES, stats_rounded
from finmart.catalog.base import KEYS, Tables, fact, nfact, query, regp, regq, rounded
from finmart.catalog.columns import YEARS
from finmart.catalog.io import headed_cells, paged, quarter_period
from finmart.operators.columns import quoted
from finmart.operators.joins import lookup, registry_join
from finmart.plans import branches as branch_job
from finmart.plans import (
    cards, channels, credit, income, indebtedness, loans, payments, precatorios, publish, quotes, registry, summary)
from finmart.plans.fixed_values import BRANCH_COLUMNS, BRANCH_FOOTER, BRANCH_LETTERS, BRANCH_SKIP, INDEBTEDNESS_PERCENTAGES
from finmart.session import new_folder, spread, written
from finmart.sources import sinks
from finmart.sources.envelope import envelope, open_envelopes
from finmart.sources.files import read_csv, read_positional_csv
from finmart.sources.layouts import (
    QUOTE_COLUMNS, QUOTES_2019, QUOTES_2020, QUOTES_2021_HEADER, QUOTES_2022, strings)
from finmart.sources.workbook_writer import write_workbooks

K = ", ".join(KEYS)


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _ptbr(c) -> Column:
    return F.translate(F.format_number(c, 2), ",.", ".,")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS "CodInst",
                 strftime(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH, '%Y%m') AS "AnoMes", """ + ", ".join(
    f"""CAST(sum(trunc(o_totalprice)) FILTER (o_orderpriority = '{p}') AS BIGINT) AS "{p}" """ for p in PRIORITIES)
    + " FROM orders GROUP BY 1, 2")
def job_credit_extract(t: Tables) -> DataFrame:
    record = F.struct(
        F.lit("2").alias("TipoInstituicao"), _text("o_custkey").alias("CodInst"), quarter_period("o_orderdate").alias("AnoMes"),
        F.lit("Carteira").alias("NomeRelatorio"), F.lit("10").alias("NumeroRelatorio"), F.col("o_orderstatus").alias("Grupo"),
        _text("o_orderkey").alias("Conta"), F.col("o_orderpriority").alias("NomeColuna"),
        F.lit("").alias("DescricaoColuna"), _text("o_totalprice").alias("Saldo"))
    documents = spread(t.orders, "o_orderkey").select(envelope(record).alias("document"))
    # only the fields the extract needs are parsed out of the documents
    return credit.credit_extract(open_envelopes(documents, "document", credit.EXTRACTED), PRIORITIES)


@query(f"""SELECT {K}, n.inst AS "NomeInstituicao", CAST(last_day(dt) AS VARCHAR) AS "Periodo",
                  CAST(trunc(cart) AS BIGINT) AS "Qtd_de_operacoes_ativas",
                  CAST(trunc(lucro) AS BIGINT) AS "Qtd_de_clientes_com_operacoes_ativas", r.seg AS "SegmentoTb"
           FROM nfact n LEFT JOIN regp r ON n.cod = r.cod
           WHERE trunc(cart) <> 0 AND trunc(lucro) <> 0 AND n.inst IS NOT NULL""", "nfact", "regp")
def job_credit_clean(t: Tables) -> DataFrame:
    portfolio = nfact(t).select(
        *KEYS, F.col("cod").alias("CodInst"), F.col("inst").alias("NomeInstituicao"), F.col("anomes").alias("AnoMes"),
        F.col("cart").alias(credit.OPERATIONS), F.col("lucro").alias(credit.CLIENTS))
    segments = regp(t).select(F.col("cod").alias("CodInst"), F.col("seg").alias("SegmentoTb"))
    clean = registry_join(credit.credit_clean(portfolio), segments, period=None).drop("CodInst")
    return clean.withColumn("Periodo", _text("Periodo"))


_SUMMARY_SQL = f"""
    SELECT {K}, inst AS "NomeInstituicao", coalesce(seg, 'Na') AS "SegmentoTb", coalesce(atividade, 'Na') AS "Atividade",
           coalesce(uf, 'Na') AS "Uf", coalesce(uf, 'Na') AS "Municipio", strftime(dt, '%Y-%m-01') AS "AnoMes",
           round(ativo, 2) AS "Ativo_Total", round(coalesce(cart, 0.0), 2) AS "Captações",
           round(coalesce(cart, 0.0), 2) AS "Cart_Cred_Classif",
           round(CASE WHEN lucro IS NULL THEN 0.0 ELSE ativo / 7 END, 2) AS "Lucro_Líquido",
           round(ativo, 2) AS "PassCircExigLongPrzResExer_Fut", round(pl, 2) AS "Patrimônio_Líquido" FROM nfact"""


def _summary(t: Tables) -> DataFrame:
    measures = {"Ativo_Total": "ativo", "Captações": "cart", "Carteira_de_Crédito_Classificada": "cart",
                "Lucro_Líquido": "parcela", summary.LIABILITIES: "ativo", "Patrimônio_Líquido": "pl"}
    rows = nfact(t, heavy=True).withColumn("parcela", F.when(F.col("lucro").isNotNull(), F.col("ativo") / 7))
    return rows.select(
        *KEYS, F.col("inst").alias("NomeInstituicao"), F.col("seg").alias("SegmentoTb"), F.col("atividade").alias("Atividade"),
        F.col("uf").alias("Uf"), F.col("uf").alias("Municipio"), F.col("anomes").alias("AnoMes"),
        *(F.col(c).alias(n) for n, c in measures.items()))


@query(f"""SELECT * FROM ({_SUMMARY_SQL}) WHERE "NomeInstituicao" NOT LIKE 'Supplier#00000001%'""", "nfact")
def job_summary_clean(t: Tables) -> DataFrame:
    clean = summary.summary_clean(_summary(t), cooperative="Supplier#00000001")
    return clean.withColumn("AnoMes", _text("AnoMes"))


@query(f"""SELECT "NomeInstituicao", "Uf", "Municipio", round(sum("Lucro_Líquido"), 2) AS lucro,
                  round(sum("PassCircExigLongPrzResExer_Fut"), 2) AS passivo, round(sum("Patrimônio_Líquido"), 2) AS patrimonio
           FROM ({_SUMMARY_SQL}) GROUP BY 1, 2, 3""", "nfact")
def job_summary_by_place(t: Tables) -> DataFrame:
    sums = summary.summary_by_place(summary.summary_filled(_summary(t)))
    return rounded(sums.toDF("NomeInstituicao", "Uf", "Municipio", "lucro", "passivo", "patrimonio"), "lucro", "passivo", "patrimonio")


TICKERS = [f"BANK{i}" for i in range(1, 7)]
TICKERS_2022 = TICKERS + ["BANK7"]
NAMES = {f"EMISSOR {c}   {share}": f"EMISSOR {c}" for c in "ANR" for share in "OPU"}
HEADERLESS = {2019: QUOTES_2019, 2020: QUOTES_2020, 2022: QUOTES_2022}
# which layout a ship year is dressed in
LAYOUT_OF = {2019: [1995, 1999], 2020: [1996, 2000], 2021: [1997, 2001], 2022: [1998, 2002]}


def _quote_texts(t: Tables) -> DataFrame:
    """Line items as quote texts, each in the dress (``layout``) of its ship year."""
    layout = F.coalesce(*(F.when(F.year("l_shipdate").isin(years), y) for y, years in LAYOUT_OF.items()))
    new = layout == 2022
    share = F.when(F.col("l_linestatus") == "O", "O").when(F.col("l_quantity") > 25, "P").otherwise("U")
    name = F.concat(F.lit("EMISSOR "), F.col("l_returnflag"), F.when(new, F.concat(F.lit("   "), share)).otherwise("   "))
    volume = F.round(F.col("l_extendedprice") / 7, 2).cast("string")
    cells = {"CODNEG": F.concat(F.lit("BANK"), _text("l_linenumber"), F.lit("  ")), "NOMES": name,
             "ABERTURA": _text("l_extendedprice"), "MAXIMO": _text("l_extendedprice"), "MINIMO": _text("l_quantity"),
             "MEDIO": _text("l_discount"), "ULTIMO": _text("l_tax"), "PREOFC": _text("l_discount"), "PREOFV": _text("l_tax"),
             "TOTNEG": _text("l_orderkey"), "QUATOT": _text("l_partkey"),
             "VOLTOT": F.when(new, F.translate(volume, ".", ",")).otherwise(volume),
             "CODISI": F.concat(F.lit("BR"), _text("l_suppkey")), "DISMES": _text("l_linenumber")}
    return spread(t.lineitem, "l_orderkey", "l_partkey").select(layout.alias("layout"), F.to_date("l_shipdate").alias("dia"),
                                     *(c.alias(n) for n, c in cells.items()))


def _line(layout: dict) -> Column:
    """A quote as a raw line of a headerless layout."""
    fields = [F.lit("0")] * layout["width"]
    if len(layout["date"]) == 1:
        fields[layout["date"][0]] = F.date_format("dia", "yyyyMMdd")
    else:
        for place, part in zip(layout["date"], (F.year("dia"), F.month("dia"), F.dayofmonth("dia"))):
            fields[place] = part.cast("string")
    for name, place in layout["at"].items():
        fields[place] = F.col(name)
    return F.concat_ws(";", *fields)


def _write_quotes(t: Tables) -> dict[int, str]:
    """The yearly raw files: one folder per layout."""
    root = new_folder(t.spark, "quotes")
    texts = _quote_texts(t)
    lines = F.coalesce(*(F.when(F.col("layout") == y, _line(shape)) for y, shape in HEADERLESS.items()))
    texts.where(F.col("layout").isin(list(HEADERLESS))).select("layout", lines.alias("line")).write.partitionBy("layout").text(root)
    dated = {"ANO": F.year("dia"), "MES": F.month("dia"), "DIA": F.dayofmonth("dia")}
    headed = texts.where(F.col("layout") == 2021).select(*(
        dated[n].alias(n) if n in dated else F.col(n) if n in QUOTE_COLUMNS else F.lit("1").alias(n)
        for n in QUOTES_2021_HEADER.fieldNames()))
    headed.write.option("header", True).csv(f"{root}/layout=2021")
    return {year: f"{root}/layout={year}" for year in LAYOUT_OF}


@query(f"""SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "PERIODO", 'BANK' || l_linenumber AS "CODNEG",
                  'EMISSOR ' || l_returnflag AS "NOMES", l_extendedprice AS "ABERTURA", l_extendedprice AS "MAXIMO",
                  l_quantity AS "MINIMO", l_discount AS "MEDIO", l_tax AS "ULTIMO", l_discount AS "PREOFC", l_tax AS "PREOFV",
                  l_orderkey AS "TOTNEG", l_partkey AS "QUATOT", round(l_extendedprice / 7, 2) AS "VOLTOT",
                  'BR' || l_suppkey AS "CODISI", l_linenumber AS "DISMES"
           FROM lineitem WHERE l_linenumber <= 6 OR (l_linenumber = 7 AND year(l_shipdate) IN {tuple(LAYOUT_OF[2022])})""")
def job_quotes_union(t: Tables) -> DataFrame:
    at = _write_quotes(t)
    raw = {year: read_positional_csv(t.spark, at[year], shape["width"]) for year, shape in HEADERLESS.items()}
    headed = read_csv(t.spark, at[2021], QUOTES_2021_HEADER)
    df = quotes.quotes_union(raw[2019], raw[2020], headed, raw[2022], TICKERS, TICKERS_2022, NAMES)
    return df.withColumn("PERIODO", _text("PERIODO"))


REGISTRY_FIELDS = ["CodInst", "NomeInstituicao", "SegmentoTb", "Uf", "Situacao"]


def _registry(t: Tables) -> DataFrame:
    return regq(t).select(
        F.col("cod").alias("CodInst"), F.col("nome").alias("NomeInstituicao"), F.col("seg").alias("SegmentoTb"),
        F.col("uf").alias("Uf"), F.col("sit").alias("Situacao"), F.col("periodo").alias("AnoMes"))


@query("""SELECT CAST(periodo AS VARCHAR) AS "AnoMes", CAST(cod AS VARCHAR) AS "CodInst", nome AS "NomeInstituicao",
                 seg AS "SegmentoTb", uf AS "Uf", sit AS "Situacao" FROM regq""", "regq")
def job_registry(t: Tables) -> DataFrame:
    service, listing = new_folder(t.spark, "service"), new_folder(t.spark, "listing")
    cut, pages = paged(_registry(t), "AnoMes", "CodInst")
    cut.write.partitionBy("AnoMes", "page").option("header", True).csv(service)
    schema = strings("AnoMes", *REGISTRY_FIELDS)
    fetched = registry.fetch_registry(t.spark, service + "/AnoMes={period}/page={page}", pages=pages, schema=schema,
                                      missing="empty")
    sinks.write_csv(fetched, listing, "append")
    return registry.appended_listings(t.spark.read.schema(schema).option("header", True).csv(listing))


LATEST = "(SELECT * FROM regq WHERE periodo = (SELECT max(periodo) FROM regq))"


@query(f"""SELECT {K}, n.cod AS "CodInst", lucro, r.nome AS "NomeInstituicao", r.seg AS "SegmentoTb", r.uf AS "Uf", r.sit AS "Situacao"
           FROM nfact n JOIN {LATEST} r ON n.cod = r.cod""", "nfact", "regq")
def job_income_join(t: Tables) -> DataFrame:
    statement = nfact(t).select(*KEYS, F.col("cod").alias("CodInst"), "lucro")
    return income.income_join(statement, _registry(t))


RULES = {"segments": ["HOUSEHOLD", "FURNITURE"], "name_parts": ["00003"], "activity_parts": ["R"], "activities": ["Cambio"]}


@query(f"""SELECT row_number() OVER (ORDER BY lucro DESC, {K}) - 1 AS indice, * FROM (
             SELECT {K}, n.cod AS "CodInst", coalesce(atividade, 'Não Informado') AS "Atividade", CAST(dt AS VARCHAR) AS "AnoMes",
                    coalesce(lucro, 0.0) AS lucro, r.nome AS "NomeInstituicao", r.seg AS "SegmentoTb", r.uf AS "Uf",
                    r.sit AS "Situacao", CAST(year(dt) AS INTEGER) AS "Ano", CAST(month(dt) AS INTEGER) AS "Mes"
             FROM nfact n JOIN {LATEST} r ON n.cod = r.cod
             WHERE r.sit <> 'I' AND r.seg NOT IN ('HOUSEHOLD', 'FURNITURE') AND NOT contains(r.nome, '00003')
                   AND NOT contains(atividade, 'R'))""", "nfact", "regq")
def job_income_clean(t: Tables) -> DataFrame:
    statement = nfact(t).select(*KEYS, F.col("cod").alias("CodInst"), F.col("atividade").alias("Atividade"),
                                _text("dt").alias("AnoMes"), F.col("lucro").alias("Lucro Líquido \n(j) = (g) + (h) + (i)"))
    listed = _registry(t).withColumnRenamed("AnoMes", "Listagem")
    joined = registry_join(statement, listed, period="Listagem", how="inner")
    df = income.income_clean(joined, tie_break=KEYS, **RULES)
    return df.withColumnRenamed(income.NET_INCOME, "lucro").withColumn("AnoMes", _text("AnoMes"))


def _income_stats_sql() -> str:
    parts = []
    for name, of in (("Mes", "month"), ("Ano", "year")):
        parts.append(f"""
        SELECT '{name}' AS periodo, valor, count(*) AS n, round(avg(lucro), 2) AS media, round(stddev(lucro), 2) AS desvio,
               min(lucro) AS minimo, max(lucro) AS maximo, round(max(q1), 6) AS q1, round(max(mediana), 6) AS mediana,
               round(max(q3), 6) AS q3, min(lucro) FILTER (dentro) AS bigode_inf, max(lucro) FILTER (dentro) AS bigode_sup,
               count(*) FILTER (NOT dentro) AS fora
        FROM (SELECT f.*, q1, mediana, q3, lucro BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS dentro
              FROM (SELECT CAST({of}(dt) AS INTEGER) AS valor, lucro FROM fact) f
              JOIN (SELECT CAST({of}(dt) AS INTEGER) AS valor, quantile_cont(lucro, 0.25) AS q1, quantile_cont(lucro, 0.5) AS mediana,
                           quantile_cont(lucro, 0.75) AS q3 FROM fact GROUP BY 1) q USING (valor))
        GROUP BY valor""")
    return " UNION ALL ".join(parts)


@query(_income_stats_sql(), "fact")
def job_income_stats(t: Tables) -> DataFrame:
    clean = written(fact(t, heavy=True).select(F.month("dt").alias("Mes"), F.year("dt").alias("Ano"), "lucro"), "income")
    return stats_rounded(income.income_stats(clean, "lucro"))


CORRELATED = ["lucro", "ativo", "cart", "pl"]


def _correlation_sql(a: str, b: str) -> str:
    ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{n}" for n, c in enumerate((a, b)))
    return f"""SELECT 'pearson' AS metodo, '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM nfact
               UNION ALL SELECT 'spearman', '{a}', '{b}', round(corr(r0, r1), 6) FROM (
               SELECT {ranks} FROM nfact WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query(" UNION ALL ".join(_correlation_sql(a, b) for a, b in combinations(CORRELATED, 2)), "nfact")
def job_income_correlation(t: Tables) -> DataFrame:
    """Gaps in two of the four measures, at places of their own."""
    clean = written(nfact(t, heavy=True).select(*CORRELATED), "income")
    return rounded(income.income_correlations(clean, CORRELATED), "r", places=6)


@query("""SELECT o_orderkey, o_orderpriority AS modalidade, n_name AS uf, o_totalprice AS valor, CAST(year(o_orderdate) AS INTEGER) AS ano
          FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def job_loans_union(t: Tables) -> DataFrame:
    rows = _orders_by_state(t).select(
        "o_orderkey", F.col("o_orderpriority").alias("modalidade"), "uf",
        F.translate(_text("o_totalprice"), ".", ",").alias("valor"), F.year("o_orderdate").alias("ano"))
    root = new_folder(t.spark, "loans")
    rows.write.partitionBy("ano").option("header", True).option("sep", ";").csv(root)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), *strings("modalidade", "uf", "valor").fields])
    return loans.read_loans(t.spark, root, schema, ["valor"])


def _orders_by_state(t: Tables) -> DataFrame:
    states = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("uf"), F.col("n_nationkey").alias("place"))
    return lookup(t.orders, states, ["o_custkey"], "inner")


_STATE_ORDERS = """SELECT n_name AS uf, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderpriority AS p, o_totalprice AS v FROM orders
                   JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


@query(f"""SELECT uf AS "{BRANCH_COLUMNS[0]}", CAST(count(*) AS DOUBLE) AS "{BRANCH_COLUMNS[1]}", """ + ", ".join(
        f"""CAST(nullif(count(*) FILTER (p = '{p}'), 0) AS DOUBLE) AS "{c}" """ for p, c in zip(PRIORITIES, BRANCH_COLUMNS[2:]))
    + f", ano FROM ({_STATE_ORDERS}) GROUP BY uf, ano")
def job_branches(t: Tables) -> DataFrame:
    totals = written(_orders_by_state(t).groupBy("uf", "place", F.year("o_orderdate").alias("ano")).agg(
        F.count(F.lit(1)).alias("total"),
        *(F.expr(f"nullif(count_if(o_orderpriority = '{p}'), 0)").alias(f"p{i}") for i, p in enumerate(PRIORITIES))), "totals")
    # a workbook per year; the known sheet layouts stand for each fourth year
    known = t.spark.createDataFrame([(i, col, name) for i, cols in enumerate(BRANCH_LETTERS.values())
                                     for col, name in zip(cols, BRANCH_COLUMNS)], "layout int, col string, nome string")
    years = totals.select("ano").distinct().withColumn("layout", F.pmod("ano", F.lit(len(BRANCH_LETTERS))))
    layouts = written(years.join(known, "layout").select("ano", "col", "nome"), "layouts")
    named = totals.toDF("uf", "place", "ano", *BRANCH_COLUMNS[1:]).withColumn(BRANCH_COLUMNS[0], F.col("uf"))
    long = named.select("ano", (F.col("place") + BRANCH_SKIP + 1).cast("int").alias("row"),
                        *(quoted(c).cast("string").alias(c) for c in BRANCH_COLUMNS)).unpivot(
        ["ano", "row"], BRANCH_COLUMNS, "nome", "value")
    body = long.where("value IS NOT NULL").join(layouts, ["ano", "nome"]).select("ano", "row", "col", "value")
    notes = body.groupBy("ano").agg(F.max("row").alias("last")).select("ano", F.explode(F.concat(
        F.sequence(F.lit(1), F.lit(BRANCH_SKIP)), F.sequence(F.col("last") + 1, F.col("last") + BRANCH_FOOTER))).alias("row"))
    cells = body.unionByName(notes.withColumns({"col": F.lit("B"), "value": F.lit("nota")})).select(
        F.format_string("ano=%d/quadros.xlsx", "ano").alias("file"), F.lit("quadro 4").alias("sheet"),
        F.lit(3).alias("sheet_index"), "row", "col", "value")
    root = new_folder(t.spark, "branches")
    written(write_workbooks(cells, root), "workbook-list")
    return branch_job.read_branches(t.spark, root, layouts)


BUCKETS = ["2018", "2019", "2020"]  # thirds of the month stand for years
_THIRD = "least(CAST(floor((day(ts) - 1) / 10) AS INTEGER), 2)"


def _third() -> Column:
    return F.element_at(F.array(*(F.lit(b) for b in BUCKETS)), F.least(F.floor((F.dayofmonth("ts") - 1) / 10).cast("int"), F.lit(2)) + 1)


@query("""SELECT event_type AS "Canal_Acesso", """ + ", ".join(
    f"""nullif(count(*) FILTER ({_THIRD} = {i}), 0) AS "ano_{b}" """ for i, b in enumerate(BUCKETS))
    + " FROM events GROUP BY 1")
def job_channels(t: Tables) -> DataFrame:
    thirds = t.events.withColumn("third", _third())
    wide = thirds.groupBy(F.col("event_type").alias("Canal de Acesso")).pivot("third", BUCKETS).count()
    root = new_folder(t.spark, "channels")
    written(write_workbooks(headed_cells(wide, "canais.xlsx"), root), "workbook-list")
    # counts are long in the table, text in a sheet
    told = channels.read_access_channels(t.spark, root)
    return told.select("Canal_Acesso", *(F.col(c).cast("long").alias(c) for c in told.columns[1:]))


CHANNELS = ["agencias_tradicionais", "atm", "central_atendimento", "correspondentes", "net_home_ofc_banking", "phone"]


@query(" UNION ALL ".join(
    f"""SELECT event_type AS operacao, '{channel}' AS canal, """ + ", ".join(
        f"""CAST(CASE WHEN event_type = 'error' THEN 0 ELSE count(*) FILTER ({_THIRD} = {i}) END AS DOUBLE) AS "{b}" """
        for i, b in enumerate(BUCKETS)) + f" FROM events WHERE floor(hour(ts) / 4) = {n} GROUP BY event_type"
    for n, channel in enumerate(CHANNELS)))
def job_channel_ops(t: Tables) -> DataFrame:
    # one pass counts all six sheets; errors are left blank in every one
    counted = written(t.events.withColumns({"third": _third(), "sheet": F.floor(F.hour("ts") / 4).cast("int")})
                      .groupBy("sheet", "event_type").pivot("third", BUCKETS).count(), "channel-counts")
    cells = None
    for n, channel in enumerate(CHANNELS):
        rows = counted.where(F.col("sheet") == n).select(
            F.col("event_type").alias("Tipo de Operação, total"),
            *(F.when(F.col("event_type") != "error", F.col(f"`{b}`").cast("string")).alias(b) for b in BUCKETS))
        sheet = headed_cells(rows, "operacoes.xlsx", channel, n)
        cells = sheet if cells is None else cells.unionByName(sheet)
    root = new_folder(t.spark, "operations")
    written(write_workbooks(cells, root), "workbook-list")
    return channels.read_operations(t.spark, root, CHANNELS)


@query("""SELECT uf AS "ESTADO", """ + ", ".join(
    f"""CAST(round(sum(v) FILTER (ano = {y}), 0) AS BIGINT) AS "ano_{y}" """ for y in YEARS)
    + f" FROM ({_STATE_ORDERS}) GROUP BY 1")
def job_atm_terminals(t: Tables) -> DataFrame:
    dated = _orders_by_state(t).withColumn("ano", F.year("o_orderdate"))
    wide = dated.groupBy(F.col("uf").alias("UF")).pivot("ano", YEARS).agg(F.sum("o_totalprice"))
    texts = wide.select("UF", *(F.translate(F.format_number(F.round(f"`{y}`"), 0), ",", ".").alias(str(y)) for y in YEARS))
    return cards.read_atm_terminals(t.spark, _as_csv(texts, ";"))


def _as_csv(df: DataFrame, sep: str) -> str:
    """A small table as a published file; every file of the folder has its header."""
    path = new_folder(df.sparkSession, "published")
    df.coalesce(1).write.option("header", True).option("sep", sep).csv(path)
    return path


@query("""SELECT strftime(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH), '%Y-%m-%d') AS "Ano",
                 CAST(quarter(o_orderdate) AS INTEGER) AS "Trimestre", round(sum(o_totalprice), 2) AS "Valor",
                 CAST(count(*) AS DOUBLE) AS "Quantidade" FROM orders GROUP BY 1, 2""")
def job_debit_cards(t: Tables) -> DataFrame:
    numerals = F.element_at(F.array(*(F.lit(x) for x in ("I", "II", "III", "IV"))), F.quarter("o_orderdate"))
    raw = t.orders.groupBy(F.year("o_orderdate").alias("Ano"), numerals.alias("Trimestre")).agg(
        _ptbr(F.sum("o_totalprice")).alias("Valor"), _ptbr(F.count(F.lit(1)).cast("double")).alias("Quantidade"))
    return cards.read_debit_cards(t.spark, _as_csv(raw, ";"))


@query("""SELECT CAST(make_date(year(o_orderdate), 12, 31) AS VARCHAR) AS "Ano", round(sum(o_totalprice), 2) AS "Valor" FROM orders GROUP BY 1""")
def job_rewards(t: Tables) -> DataFrame:
    raw = t.orders.groupBy(F.year("o_orderdate").alias("Ano")).agg(_ptbr(F.sum("o_totalprice")).alias("Valor"))
    return cards.read_rewards(t.spark, _as_csv(raw, ";")).withColumn("Ano", _text("Ano"))


DEBT_SEGMENTS = {2019: ["HOUSEHOLD", "MACHINERY", "FURNITURE"], 2020: ["AUTOMOBILE", "BUILDING"]}


def _debts(t: Tables, year: int, instead: dict[str, Column] | None = None) -> DataFrame:
    """The table of a year as published; ``instead`` has texts that stand in a column in place of the amount, unless NULL."""
    first = F.col("c_mktsegment").isin(DEBT_SEGMENTS[2019])
    amount = _ptbr(F.col("c_acctbal"))
    names = list(precatorios.yearly_names(year))
    rows = t.customer.where(first if year == 2019 else ~first).select(
        F.col("c_name").alias(names[0]), F.col("c_mktsegment").alias(names[1]),
        *(F.coalesce((instead or {}).get(n, F.lit(None)), amount).alias(n) for n in names[2:]),
        *(F.lit(None).cast("string").alias(b) for b in precatorios.BLANK_COLUMNS))
    return rows


def _debts_sql(year: int) -> str:
    inside = "IN" if year == 2019 else "NOT IN"
    return f"""SELECT c_name AS ente_devedor, c_mktsegment AS esfera, c_acctbal AS montante_pend_pagamento, c_acctbal AS montante_pago,
        c_acctbal AS saldo_pos_pagamento, c_acctbal AS precatorios_expedidos, '{year - 1}-07-02' AS ini_periodo_expedicao,
        '{year}-07-01' AS fim_periodo_expedicao, c_acctbal AS valor_divida, '{year}-12-31' AS data_divida
        FROM customer WHERE c_mktsegment {inside} {tuple(DEBT_SEGMENTS[2019])}"""


@query(_debts_sql(2019) + " UNION ALL " + _debts_sql(2020))
def job_precatorios(t: Tables) -> DataFrame:
    paths = {}
    for year in DEBT_SEGMENTS:
        paths[year] = new_folder(t.spark, f"debts-{year}")
        _debts(t, year).write.option("header", True).option("sep", "\t").option("nullValue", "").csv(paths[year])
    df = precatorios.precatorios(precatorios.read_years(t.spark, paths))
    return df.withColumns({c: _text(c) for c in ["ini_periodo_expedicao", "fim_periodo_expedicao", "data_divida"]})


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS chave, 'montante_pago_2019' AS coluna, 'dtype(''double'')' AS verificacao, 'n/d' AS valor
           FROM customer WHERE c_acctbal < 0 AND c_mktsegment IN {tuple(DEBT_SEGMENTS[2019])}
           UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'esfera', 'not_nullable', NULL FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
           UNION ALL SELECT NULL, 'divida_31_12_2019', 'column_in_dataframe', NULL""")
def job_precatorios_check(t: Tables) -> DataFrame:
    """The 2019 table with gaps, unreadable amounts and a missing column: every failure is reported."""
    names = list(precatorios.yearly_names(2019))
    rows = t.customer.where(F.col("c_mktsegment").isin(DEBT_SEGMENTS[2019])).select(
        _text("c_custkey").alias("chave"), F.col("c_name").alias(names[0]),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias(names[1]),
        *(F.when((F.col("c_acctbal") < 0) & F.lit(n == names[3]), "n/d").otherwise(_ptbr(F.col("c_acctbal"))).alias(n)
          for n in names[2:-1]))
    return precatorios.check(rows, 2019, ["chave"])


@query(f"""SELECT 'aceita' AS destino, count(*) AS linhas, NULL AS motivo FROM customer
           WHERE (c_acctbal >= 0 AND c_mktsegment IN {tuple(DEBT_SEGMENTS[2019])}) OR c_mktsegment = 'BUILDING'
           UNION ALL SELECT 'retida', count(*), 'montante_pago_2019: dtype(''double'')' FROM customer
           WHERE c_acctbal < 0 AND c_mktsegment IN {tuple(DEBT_SEGMENTS[2019])}
           UNION ALL SELECT 'retida', count(*), 'esfera: not_nullable' FROM customer WHERE c_mktsegment = 'AUTOMOBILE'""")
def job_precatorios_quarantine(t: Tables) -> DataFrame:
    """2019 with unreadable amounts, 2020 with gaps: every row is accepted or kept back with its reasons."""
    names = {year: list(precatorios.yearly_names(year)) for year in DEBT_SEGMENTS}
    # by the balance, not by the sign in its text: -0.0 is printed with one and is no negative amount
    first = _debts(t, 2019, {names[2019][3]: F.when(F.col("c_acctbal") < 0, "n/d")})
    second = _debts(t, 2020).withColumn("Esfera", F.when(F.col("Esfera") != "AUTOMOBILE", F.col("Esfera")))
    told = precatorios.sorted_out({2019: first, 2020: second})
    count = F.count(F.lit(1)).alias("linhas")
    accepted = told.accepted.agg(count).select(F.lit("aceita").alias("destino"), "linhas", F.lit(None).cast("string").alias("motivo"))
    return accepted.unionByName(told.failed.groupBy(F.array_join("motivos", "; ").alias("motivo")).agg(count).select(
        F.lit("retida").alias("destino"), "linhas", "motivo"))


@query("""SELECT event_id, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS "Periodo", """ + ", ".join(
    f"CASE WHEN event_type = 'error' THEN 0.0 ELSE {'-' if i % 2 else ''}value END AS {c}" for i, c in enumerate(INDEBTEDNESS_PERCENTAGES))
    + " FROM events")
def job_indebtedness(t: Tables) -> DataFrame:
    def cell(sign: str) -> Column:
        return F.when(F.col("event_type") == "error", "-").otherwise(
            F.concat(F.lit(sign), F.translate(_text("value"), ".", ",")))

    raw = t.events.select("event_id", F.date_format("ts", "MM/yy").alias("Data"),
                          *(cell("-" if i % 2 else "").alias(c) for i, c in enumerate(INDEBTEDNESS_PERCENTAGES)))
    path = new_folder(t.spark, "indebtedness")
    raw.write.option("header", True).csv(path)
    told = indebtedness.read_indebtedness(t.spark, path)
    return told.withColumns({"Periodo": _text("Periodo"), "event_id": F.col("event_id").cast("long")})


LOAN_COLUMNS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_tax"]


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count({c}) AS n, "
    + ("CAST(NULL AS DOUBLE) AS media, CAST(NULL AS DOUBLE) AS desvio" if c == "l_returnflag"
       else f"round(avg({c}), 2) AS media, round(stddev({c}), 2) AS desvio")
    + f", CAST(min({c}) AS VARCHAR) AS minimo, CAST(max({c}) AS VARCHAR) AS maximo, CAST(count(*) - count({c}) AS BIGINT) AS nulos "
      "FROM (SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax) FROM lineitem)" for c in LOAN_COLUMNS))
def job_loans_profile(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax"))).select(*LOAN_COLUMNS)
    return rounded(loans.loans_profile(df), "media", "desvio")


@query("""SELECT 'pedidos' AS colecao, o_orderkey AS chave, strftime(o_orderdate, '%Y-%m-%dT00:00:00') AS quando FROM orders
          UNION ALL SELECT 'clientes', c_custkey, NULL FROM customer UNION ALL SELECT 'clientes', c_custkey, NULL FROM customer""")
def job_publish_documents(t: Tables) -> DataFrame:
    root = new_folder(t.spark, "collections")
    frames = {"pedidos": t.orders.select(F.col("o_orderkey").alias("chave"), F.to_date("o_orderdate").alias("quando")),
              "clientes": t.customer.select(F.col("c_custkey").alias("chave"))}
    for _ in range(2):  # the first collection is replaced, the second one grows
        publish.publish_collections(frames, root, append=frozenset({"clientes"}))
    record = T.StructType([T.StructField("chave", T.LongType()), T.StructField("quando", T.StringType())])
    parts = [t.spark.read.schema(record).json(f"{root}/{name}").select(
        F.lit(name).alias("colecao"), "chave", F.substring("quando", 1, 19).alias("quando")) for name in frames]
    return reduce(DataFrame.unionByName, parts)


_PAYMENT = "SELECT '{0}' AS meio, CAST(CAST(ts AS DATE) AS VARCHAR) AS \"Data\", {1} AS \"Quantidade\", value AS \"Total\" FROM events"


@query(" UNION ALL ".join(_PAYMENT.format(meio, count) for meio, count in (
    ("pix", "CAST(user_id AS DOUBLE)"), ("cheque", "CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS DOUBLE) END"),
    ("ted", "CAST(user_id AS DOUBLE)"))))
def job_payments(t: Tables) -> DataFrame:
    """Events as the three kinds of payment file: timestamps as text in the documents, days in the CSV."""
    when, total = _text("ts").alias("Data"), F.col("value").alias("Total")
    count = F.col("user_id").alias("Quantidade")
    gap = F.when(F.col("event_id") % 5 == 0, "-").otherwise(_text("user_id")).alias("Quantidade")
    at = {kind: new_folder(t.spark, kind) for kind in ("pix", "cheque", "ted")}
    t.events.select(envelope(F.struct(when, count, total))).write.text(at["pix"])
    t.events.select(envelope(F.struct(when, gap, total))).write.text(at["cheque"])
    t.events.select(F.to_date("ts").alias("Data"), count, total).write.option("header", True).csv(at["ted"])
    rows = payments.payments_union(t.spark, at["pix"], at["cheque"], at["ted"])
    return rows.withColumn("Data", _text("Data"))
