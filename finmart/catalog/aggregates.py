"""Aggregation, statistics, order and SQL questions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.catalog.base import KEYS, Tables, fact, nfact, query, rounded
from finmart.operators import aggregate as ops
from finmart.operators import correlation, ordering, quality
from finmart.plans.insights import ask
from finmart.plans.summary import summary_view
from finmart.session import spread, written

K = ", ".join(KEYS)
SUMMARY = {"inst": "NomeInstituicao", "seg": "SegmentoTb", "atividade": "Atividade", "pl": "Patrimonio_Liquido",
           "lucro": "Lucro_Liquido", "cart": "Cart_Cred_Classif", "ativo": "Ativo_Total"}


def summary(t: Tables) -> DataFrame:
    return fact(t).select(*(F.col(c).alias(n) for c, n in SUMMARY.items()))


@query("""SELECT inst AS "NomeInstituicao", max(pl) AS patrimonio, round(sum(lucro), 2) AS lucro, max(cart) AS carteira
          FROM fact GROUP BY 1""", "fact")
def sql_largest_banks(t: Tables) -> DataFrame:
    return ask(t.spark, "largest_banks", summary(t))


@query("""SELECT inst AS "NomeInstituicao", min(pl) AS patrimonio, round(sum(lucro), 2) AS lucro, min(cart) AS carteira
          FROM fact GROUP BY 1""", "fact")
def sql_tail_banks(t: Tables) -> DataFrame:
    return ask(t.spark, "tail_banks", summary(t))


@query("""SELECT inst AS "NomeInstituicao", min(pl) AS patrimonio, min(lucro) AS menor_lucro, max(lucro) AS maior_lucro
          FROM fact WHERE lucro < 0 GROUP BY 1""", "fact")
def sql_negative_profit(t: Tables) -> DataFrame:
    return ask(t.spark, "negative_profit", summary(t))


@query("""SELECT inst AS "NomeInstituicao", min(pl) AS patrimonio, min(lucro) AS menor_lucro, max(lucro) AS maior_lucro
          FROM fact WHERE lucro > 0 GROUP BY 1""", "fact")
def sql_low_equity_profit(t: Tables) -> DataFrame:
    return ask(t.spark, "low_equity_profit", summary(t))


@query("""SELECT inst AS "NomeInstituicao", min(cart) AS carteira, min(ativo) AS ativo, max(lucro) AS maior_lucro
          FROM fact WHERE lucro > 0 GROUP BY 1 ORDER BY avg(lucro) DESC""", "fact")
def sql_order_by_hidden_agg(t: Tables) -> DataFrame:
    return ask(t.spark, "by_average_profit", summary(t))


@query("""SELECT inst AS "NomeInstituicao", seg AS "SegmentoTb", atividade AS "Atividade" FROM fact WHERE lucro > 0
          ORDER BY lucro DESC""", "fact")
def sql_sort_unprojected(t: Tables) -> DataFrame:
    return ask(t.spark, "profitable", summary(t))


@query("""SELECT atividade AS "Atividade", count(*) AS n, round(sum(lucro), 2) AS lucro FROM fact GROUP BY 1""", "fact")
def sql_named_view(t: Tables) -> DataFrame:
    accented = {"Lucro_Liquido": "Lucro_Líquido", "Patrimonio_Liquido": "Patrimônio_Líquido"}
    name = f"finmart_resumo_{uuid.uuid4().hex}"
    summary_view(summary(t).withColumnsRenamed(accented), name)
    return t.spark.sql(f"SELECT Atividade, count(*) AS n, round(sum(Lucro_Liquido), 2) AS lucro FROM {name} GROUP BY Atividade")


SUMS = ["soma_lucro", "soma_ativo", "soma_cart"]


@query(f"SELECT inst, uf, {', '.join(f'round(sum({s[5:]}), 2) AS {s}' for s in SUMS)} FROM fact GROUP BY 1, 2", "fact")
def group_sum_multi(t: Tables) -> DataFrame:
    return rounded(ops.group_sums(fact(t), ["inst", "uf"], ["lucro", "ativo", "cart"]), *SUMS)


@query("SELECT inst, count(*) AS n FROM nfact GROUP BY 1", "nfact")
def group_count_desc(t: Tables) -> DataFrame:
    # a count per key keeps the NULL key here, unlike value_counts
    return nfact(t).groupBy("inst").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("inst"))


@query("""SELECT round(sum(cart), 2) AS soma, round(avg(lucro), 4) AS media, min(lucro) AS minimo, max(lucro) AS maximo
          FROM nfact""", "nfact")
def global_agg(t: Tables) -> DataFrame:
    return ops.totals(nfact(t), soma=F.round(F.sum("cart"), 2), media=F.round(F.avg("lucro"), 4),
                      minimo=F.min("lucro"), maximo=F.max("lucro"))


@query("SELECT count(DISTINCT atividade) AS qtd FROM nfact WHERE atividade IS NOT NULL", "nfact")
def count_distinct_col(t: Tables) -> DataFrame:
    return nfact(t).where("atividade IS NOT NULL").agg(F.count_distinct("atividade").alias("qtd"))


@query("SELECT DISTINCT seg FROM nfact WHERE seg IS NOT NULL", "nfact")
def distinct_values(t: Tables) -> DataFrame:
    return ops.distinct_values(nfact(t).where("seg IS NOT NULL"), "seg")


PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PART_NUMBERS = ["p_partkey", "p_size", "p_retailprice"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS coluna, count(DISTINCT {c}) AS distintos FROM part" for c in PART))
def nunique_all(t: Tables) -> DataFrame:
    return quality.distinct_counts(t.part)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("""SELECT o_custkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS anomes, """ + ", ".join(
    f"""CAST(sum(trunc(o_totalprice)) FILTER (o_orderpriority = '{p}') AS BIGINT) AS "{p}" """ for p in PRIORITIES)
    + " FROM orders GROUP BY 1, 2")
def pivot_sum(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("anomes", F.year("o_orderdate") * 100 + F.month("o_orderdate"))
    return ops.pivot_sum(dated, ["o_custkey", "anomes"], "o_orderpriority", "o_totalprice", PRIORITIES)


@query("SELECT seg, count(*) AS n FROM nfact WHERE seg IS NOT NULL GROUP BY 1", "nfact")
def value_counts(t: Tables) -> DataFrame:
    return ops.value_counts(nfact(t), "seg")


@query("SELECT inst, count(*) AS n FROM nfact WHERE inst IS NOT NULL GROUP BY 1", "nfact")
def group_count_nonnull(t: Tables) -> DataFrame:
    return ops.value_counts(nfact(t), "inst")


@query("SELECT inst, round(coalesce(sum(lucro), 0), 2) AS lucro FROM nfact WHERE inst IS NOT NULL GROUP BY 1", "nfact")
def group_sum_desc(t: Tables) -> DataFrame:
    return rounded(ops.group_sum_desc(nfact(t), "inst", "lucro", "lucro"), "lucro")


# Quantiles of four-decimal values have up to six decimals: rounded there, no value sits on a rounding edge.
PLACES = {"media": 2, "desvio": 2, "q1": 6, "mediana": 6, "q3": 6}


def stats_rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, p) for c, p in PLACES.items() if c in df.columns})


def _profits(t: Tables, key) -> DataFrame:
    """A key and the profit; stored, because describing reads them more than once and the join should run once."""
    return written(fact(t, heavy=True).select(key, "lucro"), "profits")


@query("SELECT inst, round(avg(lucro), 2) AS media, round(median(lucro), 6) AS mediana FROM fact GROUP BY 1", "fact")
def group_mean_median(t: Tables) -> DataFrame:
    return stats_rounded(ops.mean_median(_profits(t, "inst"), "inst", "lucro"))


STATES = [f"NATION_{i}" for i in range(25)]


@query("SELECT estatistica, " + ", ".join(f"""max(valor) FILTER (uf = '{s}') AS "{s}" """ for s in STATES) + """
       FROM (SELECT uf, 'media' AS estatistica, round(avg(lucro), 2) AS valor FROM fact GROUP BY uf
             UNION ALL SELECT uf, 'mediana', round(median(lucro), 6) FROM fact GROUP BY uf) GROUP BY 1""", "fact")
def transpose_stats(t: Tables) -> DataFrame:
    stats = stats_rounded(ops.mean_median(_profits(t, "uf"), "uf", "lucro"))
    return ops.transpose(stats, "uf", ["media", "mediana"], STATES)


def describe_sql(measure: str) -> str:
    points = ", ".join(f"round(quantile_cont({measure}, {p}), 6) AS {n}" for p, n in ((.25, "q1"), (.5, "mediana"), (.75, "q3")))
    return (f"count({measure}) AS n, round(avg({measure}), 2) AS media, round(stddev({measure}), 2) AS desvio, "
            f"min({measure}) AS minimo, {points}, max({measure}) AS maximo")


@query(f"SELECT CAST(month(dt) AS INTEGER) AS mes, {describe_sql('lucro')} FROM fact GROUP BY 1", "fact")
def group_describe(t: Tables) -> DataFrame:
    return stats_rounded(ops.describe(_profits(t, F.month("dt").alias("mes")), "lucro", ["mes"]))


@query(" UNION ALL ".join(f"SELECT '{c}' AS coluna, {describe_sql(f'CAST({c} AS DOUBLE)')} FROM part" for c in PART_NUMBERS))
def describe_numeric(t: Tables) -> DataFrame:
    return stats_rounded(ops.describe_numeric(t.part))


def _simple_sql(table: str, columns: list[str], numbers: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, count({c}) AS n, "
        + (f"round(avg({c}), 2) AS media, round(stddev({c}), 2) AS desvio, " if c in numbers
           else "CAST(NULL AS DOUBLE) AS media, CAST(NULL AS DOUBLE) AS desvio, ")
        + f"CAST(min({c}) AS VARCHAR) AS minimo, CAST(max({c}) AS VARCHAR) AS maximo FROM {table}" for c in columns)


@query(_simple_sql("part", PART, PART_NUMBERS))
def describe_spark(t: Tables) -> DataFrame:
    return rounded(ops.describe_columns(t.part), "media", "desvio")


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS coluna, count({c}) AS n, count(DISTINCT {c}) AS distintos, "
    f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS f FROM part GROUP BY 1 ORDER BY f DESC, v LIMIT 1)) AS moda, "
    f"(SELECT max(f) FROM (SELECT count(*) AS f FROM part GROUP BY {c})) AS frequencia, "
    + (describe_sql(f"CAST({c} AS DOUBLE)").partition(", ")[2] if c in PART_NUMBERS
       else ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in ["media", "desvio", "minimo", "q1", "mediana", "q3", "maximo"]))
    + " FROM part" for c in PART))
def describe_all(t: Tables) -> DataFrame:
    return stats_rounded(ops.describe_all(t.part))


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]
_GAPS = "(SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax) FROM lineitem)"


def _with_gaps(t: Tables) -> DataFrame:
    return t.lineitem.withColumn("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_tax")))


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {_GAPS}" for a, b in PAIRS))
def corr_pearson(t: Tables) -> DataFrame:
    return rounded(correlation.pearson(_with_gaps(t), MEASURES), "r", places=6)


DECLARED = PRIORITIES[:3]


@query("""SELECT o_custkey, """ + ", ".join(
    f"""CAST(sum(trunc(o_totalprice)) FILTER (o_orderpriority = '{p}') AS BIGINT) AS "{p}" """ for p in DECLARED)
    + f""", CAST(sum(trunc(o_totalprice)) FILTER (o_orderpriority NOT IN {tuple(DECLARED)}) AS BIGINT) AS outras,
          count(*) FILTER (o_orderpriority NOT IN {tuple(DECLARED)}) AS linhas_outras FROM orders GROUP BY 1""")
def pivot_sum_rest(t: Tables) -> DataFrame:
    """Three of the priorities are declared; the others are summed and counted."""
    return ops.pivot_sum(t.orders, ["o_custkey"], "o_orderpriority", "o_totalprice", DECLARED, rest=("outras", "linhas_outras"))


def _rank_sql(column: str) -> str:
    return f"rank() OVER (ORDER BY {column}) + (count(*) OVER (PARTITION BY {column}) - 1) / 2.0"


@query(" UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 6) AS r FROM (
        SELECT {_rank_sql(a)} AS ra, {_rank_sql(b)} AS rb FROM {_GAPS} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""
    for a, b in PAIRS))
def corr_spearman(t: Tables) -> DataFrame:
    gaps = _with_gaps(t).select("l_orderkey", "l_partkey", *MEASURES)
    # stored: ranking reads the columns three times
    return rounded(correlation.spearman(written(spread(gaps, "l_orderkey", "l_partkey"), "measures"), MEASURES), "r", places=6)


_BOX = """SELECT {keys}, CAST(month(l_shipdate) AS INTEGER) AS mes, l_extendedprice * l_quantity * l_discount AS m FROM lineitem"""


def _box_input(t: Tables) -> DataFrame:
    return spread(t.lineitem, "l_orderkey", "l_partkey").select(*KEYS, F.month("l_shipdate").alias("mes"),
                             (F.col("l_extendedprice") * F.col("l_quantity") * F.col("l_discount")).alias("m"))


_BOX_SQL = f"""WITH x AS ({_BOX.format(keys=K)}),
    q AS (SELECT mes, quantile_cont(m, 0.25) AS q1, quantile_cont(m, 0.5) AS mediana, quantile_cont(m, 0.75) AS q3 FROM x GROUP BY 1),
    f AS (SELECT x.*, q1, mediana, q3, m BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS dentro FROM x JOIN q USING (mes))
"""


@query(_BOX_SQL + """SELECT mes, count(*) AS n, round(max(q1), 2) AS q1, round(max(mediana), 2) AS mediana, round(max(q3), 2) AS q3,
       round(min(m) FILTER (dentro), 2) AS bigode_inf, round(max(m) FILTER (dentro), 2) AS bigode_sup,
       count(*) FILTER (NOT dentro) AS fora FROM f GROUP BY 1""")
def boxplot_stats(t: Tables) -> DataFrame:
    return rounded(ops.box_stats(_box_input(t), "m", ["mes"]), "q1", "mediana", "q3", "bigode_inf", "bigode_sup")


@query(_BOX_SQL + f"SELECT {K}, mes, m FROM f WHERE NOT dentro")
def boxplot_outliers(t: Tables) -> DataFrame:
    return ops.box_outliers(_box_input(t), "m", ["mes"])


@query("SELECT CAST(sum(trunc(value * 100000000)) AS BIGINT) AS soma FROM events")
def sum_of_cast(t: Tables) -> DataFrame:
    return ops.whole_sum(t.events.withColumn("texto", (F.col("value") * 100000000).cast("string")), "texto", "soma")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_sorted(t: Tables) -> DataFrame:
    return ordering.top(t.orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 20).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5")
def tail_rows(t: Tables) -> DataFrame:
    return ordering.tail(t.orders, [("o_totalprice", True), ("o_orderkey", True)], 5).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1 OFFSET 74")
def row_at(t: Tables) -> DataFrame:
    return ordering.row_at(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice"), F.col("o_orderkey")], 74)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 50")
def preview_limit(t: Tables) -> DataFrame:
    return ordering.top(t.orders.drop("o_orderdate"), [F.col("o_orderkey")], 50)


@query("SELECT count(*) AS linhas, 11 AS colunas FROM lineitem")
def shape(t: Tables) -> DataFrame:
    return quality.shape(t.lineitem)


@query("SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS indice, o_orderkey, o_totalprice FROM orders")
def row_index_sorted(t: Tables) -> DataFrame:
    return ordering.row_index(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")])


@query(f"SELECT DISTINCT l_quantity, count(*) OVER (PARTITION BY l_quantity) AS n, {_rank_sql('l_quantity')} AS posto FROM lineitem")
def avg_rank(t: Tables) -> DataFrame:
    return ordering.average_rank(t.lineitem, "l_quantity")
