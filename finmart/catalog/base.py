"""Registration, and the inputs shared by many queries, once as frames and once as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.functions.dates import period_list
from finmart.operators.joins import lookup
from finmart.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# The schemas of the given tables, so that opening one reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Tables:
    """The given tables of one folder; a table is opened when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")


def query(sql: str, *inputs: str, name: str | None = None):
    """Register a query over :class:`Tables`, with its SQL; ``inputs`` name shared inputs the SQL uses."""
    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        wanted: list[str] = []
        for i in inputs:
            wanted += [n for n in (*NEEDS.get(i, ()), i) if n not in wanted]
        ctes = ",\n".join(f"{i} AS ({INPUTS[i]})" for i in wanted)
        SQL[key] = (f"WITH {ctes}\n{sql}" if ctes else sql).strip()
        return build
    return register


PERIODS = [int(p) for p in period_list("2019-03", "2021-10")]
KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
NEEDS = {"nfact": ("fact",), "regq": ("reg",), "regp": ("reg",)}
INPUTS = {
    "fact": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_suppkey AS cod, s_name AS inst, n_name AS uf,
               CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS anomes, CAST(l_shipdate AS DATE) AS dt,
               l_extendedprice AS ativo, s_acctbal AS pl, l_quantity AS cart,
               l_extendedprice * (1 - l_discount) * (CASE WHEN l_quantity < 10 THEN -1 ELSE 1 END) AS lucro,
               l_returnflag AS atividade, l_linestatus AS seg
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "nfact": """
        SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN NULL ELSE lucro END AS lucro,
                          CASE WHEN l_linenumber = 2 THEN 0.0 WHEN l_linenumber = 4 THEN NULL ELSE cart END AS cart,
                          CASE WHEN l_linenumber = 5 THEN NULL ELSE seg END AS seg,
                          CASE WHEN pl < 0 THEN NULL ELSE inst END AS inst)
        FROM fact""",
    "reg": """
        SELECT c_custkey AS cod, c_name AS nome, c_mktsegment AS seg, n_name AS uf,
               CASE WHEN c_acctbal < 0 THEN 'I' ELSE 'A' END AS sit
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "regq": f"""
        SELECT cod, nome || ' v' || CAST(periodo AS VARCHAR) AS nome, seg, uf, sit, periodo
        FROM reg, (SELECT unnest({PERIODS}) AS periodo)""",
    "regp": "SELECT * FROM reg WHERE sit = 'A'",
}


def fact(t: Tables, heavy: bool = False) -> DataFrame:
    """Line items as institution facts: institution, state, period, assets, equity, credit, signed profit.

    ``heavy`` says that much work per row follows, so all cores should get rows.
    """
    # nation has 25 rows at every scale; Spark broadcasts it by its file size
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    items = spread(t.lineitem, "l_orderkey", "l_partkey") if heavy else t.lineitem
    rows = lookup(items, suppliers.withColumnRenamed("s_suppkey", "l_suppkey"), ["l_suppkey"], "inner")
    sign = F.when(F.col("l_quantity") < 10, -1).otherwise(1)
    return rows.select(
        *KEYS, F.col("l_suppkey").alias("cod"), F.col("s_name").alias("inst"), F.col("n_name").alias("uf"),
        (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("anomes"), F.to_date("l_shipdate").alias("dt"),
        F.col("l_extendedprice").alias("ativo"), F.col("s_acctbal").alias("pl"), F.col("l_quantity").alias("cart"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * sign).alias("lucro"),
        F.col("l_returnflag").alias("atividade"), F.col("l_linestatus").alias("seg"))


def nfact(t: Tables, heavy: bool = False) -> DataFrame:
    """:func:`fact` with gaps and zeros at known places."""
    line = F.col("l_linenumber")
    return fact(t, heavy).withColumns({
        "lucro": F.when(line != 3, F.col("lucro")),
        "cart": F.when(line == 2, F.lit(0.0)).when(line != 4, F.col("cart")),
        "seg": F.when(line != 5, F.col("seg")),
        "inst": F.when(F.col("pl") >= 0, F.col("inst")),
    })


def reg(t: Tables) -> DataFrame:
    """Customers as an institution registry; a negative balance means inactive."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(
        F.col("c_custkey").alias("cod"), F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("seg"),
        F.col("n_name").alias("uf"), F.when(F.col("c_acctbal") < 0, "I").otherwise("A").alias("sit"))


def regq(t: Tables) -> DataFrame:
    """The registry as published: every institution once per period, under a name that changes."""
    listed = reg(t).withColumn("periodo", F.explode(F.array(*(F.lit(p) for p in PERIODS))))
    return listed.withColumn("nome", F.concat("nome", F.lit(" v"), F.col("periodo").cast("string")))


def regp(t: Tables) -> DataFrame:
    """A registry that lacks some institutions: the active ones only."""
    return reg(t).where("sit = 'A'")


def rounded(df: DataFrame, *columns: str, places: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})

