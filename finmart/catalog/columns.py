"""Projection, naming and schema shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.catalog.base import KEYS, Tables, query
from finmart.functions.dates import day_first
from finmart.functions.names import first_line, lower_underscored, rename_by, snake, underscored, without_spaces
from finmart.operators import columns as ops
from finmart.operators.narrow import narrow, narrowing_plan
from finmart.operators.quality import schema_info as schema_info_of
from finmart.sources.layouts import REPORT_VALUES


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def project_cols(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_name", "c_mktsegment")


@query("SELECT c_custkey AS cod, c_name AS nome, c_nationkey, c_acctbal AS saldo, c_mktsegment FROM customer")
def rename_map(t: Tables) -> DataFrame:
    return ops.rename(t.customer, {"c_custkey": "cod", "c_name": "nome", "c_acctbal": "saldo", "absent": "ignored"})


@query("""SELECT c_custkey AS a, c_name AS b, c_nationkey AS c, c_acctbal AS saldo_final, c_mktsegment AS e
          FROM customer""")
def rename_positional(t: Tables) -> DataFrame:
    return ops.rename_at(ops.rename_positional(t.customer, list("abcde")), {-2: "saldo_final"})


@query("""SELECT c_custkey AS cod, c_name AS "ano_c_name", c_nationkey AS "ano_c_nationkey", c_acctbal AS "ano_c_acctbal",
                 c_mktsegment AS "ano_c_mktsegment" FROM customer""")
def prefix_names(t: Tables) -> DataFrame:
    return ops.prefix(t.customer, "ano_", {"c_custkey": "cod"})


LOCAL_NAMES = {"c_custkey": "Código do Cliente", "c_name": "Nome", "c_nationkey": "País", "c_acctbal": "Saldo da Conta",
               "c_mktsegment": "Segmento"}


@query("""SELECT c_custkey AS "Código do Cliente", c_name AS "Nome", c_nationkey AS "País", c_acctbal AS "Saldo da Conta",
                 c_mktsegment AS "Segmento" FROM customer""")
def localize_names(t: Tables) -> DataFrame:
    return ops.rename(t.customer, LOCAL_NAMES)


@query("""SELECT c_custkey AS codigo_do_cliente, c_name AS "Nome_Completo", c_nationkey AS "Paísdeorigem",
                 c_acctbal AS "saldo_em_conta", c_mktsegment AS "SegmentoTb" FROM customer""")
def normalize_names(t: Tables) -> DataFrame:
    raw = t.customer.toDF("Código do Cliente", " Nome Completo \n(a)=(b)+(c)", "País de origem", "Saldo, em conta", "SegmentoTb")
    code = rename_by(raw.select(raw.columns[0]), snake).columns[0]
    named = rename_by(raw.select(ops.quoted(raw.columns[1])), first_line, underscored).columns[0]
    plain = rename_by(raw.select(ops.quoted(raw.columns[2])), without_spaces).columns[0]
    lower = rename_by(raw.select(ops.quoted(raw.columns[3])), lower_underscored).columns[0]
    return raw.toDF(code, named, plain, lower, "SegmentoTb")


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def drop_cols(t: Tables) -> DataFrame:
    return t.part.drop("p_brand", "p_type")


@query("""SELECT p_partkey, p_name, p_brand, '2019-12-31' AS data_divida, p_type, p_size, p_retailprice FROM part""")
def insert_after(t: Tables) -> DataFrame:
    return ops.insert_after(t.part, "p_brand", "data_divida", day_first("31-12-2019").cast("string"))


@query("SELECT p_partkey, p_name, 2018 AS ano, '2018-07-02' AS ini FROM part")
def tag_literal(t: Tables) -> DataFrame:
    return ops.tag(t.part.select("p_partkey", "p_name"), ano=2018, ini=day_first("02-07-2018").cast("string"))


YEARS = list(range(1995, 2002))


@query("""SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, round(sum(o_totalprice), 2) AS valor
          FROM orders GROUP BY 1, 2""")
def unpivot_years(t: Tables) -> DataFrame:
    dated = t.orders.withColumn("year", F.year("o_orderdate"))
    wide = dated.groupBy("o_custkey").pivot("year", YEARS).agg(F.round(F.sum("o_totalprice"), 2))
    return ops.years_to_rows(ops.prefix(wide, "ano_", {"o_custkey": "o_custkey"}), ["o_custkey"])


@query("SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def select_by_type(t: Tables) -> DataFrame:
    return ops.select_by_type(t.lineitem, "double")


@query("""SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand_codigo,
                 CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type_codigo, p_size,
                 CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS p_retailprice FROM part""")
def narrow_types(t: Tables) -> DataFrame:
    df = t.part.select("p_partkey", "p_brand", "p_type", "p_size", "p_retailprice")
    small = narrow(df, narrowing_plan(df))
    # back to the SQL's types, which do not follow the data
    return small.select(F.col("p_partkey").cast("long"), "p_brand_codigo", "p_type_codigo", F.col("p_size").cast("int"),
                        F.col("p_retailprice").cast("double"))


@query("""SELECT posicao, coluna, tipo, n AS preenchidos FROM (SELECT count(*) AS n FROM part),
          (VALUES (0, 'p_partkey', 'bigint'), (1, 'p_name', 'string'), (2, 'p_brand', 'string'), (3, 'p_type', 'string'),
                  (4, 'p_size', 'int'), (5, 'p_retailprice', 'double')) AS c(posicao, coluna, tipo)""")
def schema_info(t: Tables) -> DataFrame:
    return schema_info_of(t.part)


@query("""SELECT '2' AS "TipoInstituicao", CAST(o_custkey AS VARCHAR) AS "CodInst",
                 strftime(o_orderdate, '%Y%m') AS "AnoMes", 'Resumo' AS "NomeRelatorio", '1' AS "NumeroRelatorio",
                 o_orderstatus AS "Grupo", CAST(o_orderkey AS VARCHAR) AS "Conta", o_orderpriority AS "NomeColuna",
                 CAST(NULL AS VARCHAR) AS "DescricaoColuna", CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) AS "Saldo"
          FROM orders""")
def declared_schema(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.floor("o_totalprice").alias("Saldo"), F.col("o_orderkey").alias("Conta"), F.col("o_custkey").alias("CodInst"),
        F.lit(2).alias("TipoInstituicao"), F.lit(1).alias("NumeroRelatorio"), F.lit("Resumo").alias("NomeRelatorio"),
        F.date_format("o_orderdate", "yyyyMM").alias("AnoMes"), F.col("o_orderpriority").alias("NomeColuna"),
        F.col("o_orderstatus").alias("Grupo"), F.lit(None).cast("string").alias("DescricaoColuna"), "o_orderdate")
    return ops.with_schema(rows, REPORT_VALUES)


@query(f"SELECT 'lineitem' AS origem, {', '.join(KEYS)}, l_quantity FROM lineitem")
def insert_first(t: Tables) -> DataFrame:
    return ops.insert_first(t.lineitem.select(*KEYS, "l_quantity"), "origem", F.lit("lineitem"))


@query("""SELECT 'F' AS parte, o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority, CAST(NULL AS BIGINT) AS o_custkey
          FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT 'O', o_orderkey, NULL, o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT 'O', o_orderkey, NULL, o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT 'P', o_orderkey, NULL, NULL, o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def union_by_name(t: Tables) -> DataFrame:
    def part(status: str, column: str) -> DataFrame:
        rows = t.orders.where(F.col("o_orderstatus") == status)
        return rows.select(F.lit(status).alias("parte"), "o_orderkey", column)

    open_orders = part("O", "o_orderpriority")
    return ops.union_by_name(part("F", "o_totalprice"), open_orders, open_orders, part("P", "o_custkey"))
