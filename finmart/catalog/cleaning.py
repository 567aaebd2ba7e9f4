"""Filters, null policy, replacement, joins, duplicates and schema checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.catalog.base import KEYS, Tables, fact, nfact, query, reg, regp, regq
from finmart.operators import filters, joins, quality
from finmart.operators.quality import Expected
from finmart.session import written

K = ", ".join(KEYS)
BRANDS = ["Brand#1", "Brand#5", "Brand#9", "Brand#13", "Brand#17"]


@query(f"SELECT p_partkey, p_brand FROM part WHERE p_brand IN ({', '.join(repr(b) for b in BRANDS)})")
def filter_isin(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_brand").isin(BRANDS)).select("p_partkey", "p_brand")


@query(f"""SELECT {K}, l_quantity FROM lineitem
           WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')""")
def semi_join_list(t: Tables) -> DataFrame:
    listing = t.part.where("p_type = 'ECONOMY'").select(F.col("p_partkey").alias("l_partkey"))
    return filters.keep_listed(t.lineitem.select(*KEYS, "l_quantity"), listing, ["l_partkey"])


@query(f"SELECT {K}, lucro, cart FROM nfact WHERE lucro IS NOT NULL OR cart IS NOT NULL", "nfact")
def filter_any_not_null(t: Tables) -> DataFrame:
    return filters.keep_any_not_null(nfact(t), ["lucro", "cart"]).select(*KEYS, "lucro", "cart")


@query(f"SELECT {K}, lucro, cart FROM nfact WHERE lucro <> 0 AND cart <> 0", "nfact")
def filter_both_nonzero(t: Tables) -> DataFrame:
    return filters.keep_all_nonzero(nfact(t), ["lucro", "cart"]).select(*KEYS, "lucro", "cart")


@query(f"SELECT {K}, inst FROM nfact WHERE inst IS NOT NULL", "nfact")
def filter_not_null(t: Tables) -> DataFrame:
    return filters.keep_not_null(nfact(t), "inst").select(*KEYS, "inst")


@query(f"SELECT {K}, inst FROM nfact WHERE inst NOT LIKE 'Supplier#00000001%'", "nfact")
def filter_not_like(t: Tables) -> DataFrame:
    return filters.exclude_prefix(nfact(t), "inst", "Supplier#00000001").select(*KEYS, "inst")


@query(f"SELECT {K}, inst FROM nfact WHERE inst IS NULL OR NOT (contains(inst, '7') OR contains(inst, '01'))", "nfact")
def filter_not_contains(t: Tables) -> DataFrame:
    return filters.exclude_containing(nfact(t), "inst", ["7", "01"]).select(*KEYS, "inst")


@query("SELECT * FROM reg WHERE seg NOT IN ('HOUSEHOLD', 'MACHINERY') AND sit <> 'I'", "reg")
def filter_excl_list(t: Tables) -> DataFrame:
    return filters.exclude_values(filters.exclude_values(reg(t), "seg", ["HOUSEHOLD", "MACHINERY"]), "sit", ["I"])


@query("SELECT * FROM reg r WHERE NOT EXISTS (SELECT 1 FROM reg b WHERE b.sit = 'I' AND b.seg = r.seg AND b.uf = r.uf)", "reg")
def anti_join_rules(t: Tables) -> DataFrame:
    rules = reg(t).where("sit = 'I'").select("seg", "uf")
    return filters.exclude_by_rules(reg(t), rules, ["seg", "uf"])


@query(f"""SELECT {K}, coalesce(lucro, 0.0) AS lucro, coalesce(seg, 'Na') AS seg, coalesce(inst, 'Não Informado') AS inst,
                  coalesce(cart, 0.0) AS cart FROM nfact""", "nfact")
def fill_nulls(t: Tables) -> DataFrame:
    df = filters.fill(nfact(t).select(*KEYS, "lucro", "seg", "inst", "cart"),
                      {"lucro": 0.0, "seg": "Na", "inst": "Não Informado"})
    return filters.fill_all(df, 0)


@query("SELECT CAST(c_custkey AS VARCHAR) AS cod, c_name AS nome, c_mktsegment AS seg FROM customer")
def drop_header_rows(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("cod"), F.col("c_name").alias("nome"),
                             F.col("c_mktsegment").alias("seg"))
    # every segment's listing was appended with its own header line
    headers = rows.select("seg").distinct().select(F.lit("cod").alias("cod"), F.lit("nome").alias("nome"), F.lit("seg").alias("seg"))
    return filters.drop_header_rows(rows.unionByName(headers), "cod")


@query(f"SELECT {K}, lucro FROM fact WHERE lucro < 0", "fact")
def filter_compare(t: Tables) -> DataFrame:
    return fact(t).where("lucro < 0").select(*KEYS, "lucro")


@query(f"SELECT {K}, uf FROM fact WHERE uf = 'NATION_7'", "fact")
def filter_eq(t: Tables) -> DataFrame:
    return fact(t).where("uf = 'NATION_7'").select(*KEYS, "uf")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '0.00' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders")
def replace_exact(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return filters.replace_exact(df, {"P": "0.00"}, ["o_orderstatus", "o_orderpriority"])


@query("SELECT p_partkey, p_name AS nome FROM part")
def canonical_map(t: Tables) -> DataFrame:
    share = F.when(F.col("p_size") <= 20, " O").when(F.col("p_size") <= 40, " P").otherwise("")
    raw = t.part.select("p_partkey", F.concat("p_name", share).alias("nome"))
    mapping = t.part.select("p_name").distinct().select(
        F.explode(F.array(F.concat("p_name", F.lit(" O")), F.concat("p_name", F.lit(" P")))).alias("variant"),
        F.col("p_name").alias("canonical"))
    return filters.canonicalise(raw, "nome", mapping)


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("cod"), "o_totalprice")


@query("""SELECT o_orderkey, o_custkey AS cod, o_totalprice, nome, seg, uf, sit FROM regp RIGHT JOIN orders ON cod = o_custkey""", "regp")
def join_right(t: Tables) -> DataFrame:
    return joins.registry_join(_orders(t), regp(t), "cod", None, "left")


@query("""SELECT o_orderkey, cod, o_totalprice, nome, seg, uf, sit FROM regp JOIN orders ON cod = o_custkey""", "regp")
def join_inner(t: Tables) -> DataFrame:
    return joins.registry_join(_orders(t), regp(t), "cod", None, "inner")


@query("""SELECT o_orderkey, cod, nome, periodo FROM regq JOIN orders ON cod = o_custkey""", "regq")
def join_all_listings(t: Tables) -> DataFrame:
    joined = joins.registry_join(_orders(t), regq(t), "cod", "periodo", "inner", keep_listings=True)
    return joined.select("o_orderkey", "cod", "nome", "periodo")


@query("""SELECT o_orderkey, o_custkey AS cod, o_totalprice, nome, seg, uf, sit
          FROM orders LEFT JOIN (SELECT * FROM regq QUALIFY row_number() OVER (PARTITION BY cod ORDER BY periodo DESC) = 1)
          ON cod = o_custkey""", "regq")
def join_latest_dim(t: Tables) -> DataFrame:
    return joins.registry_join(_orders(t), regq(t), "cod", "periodo")


@query("""SELECT o_orderkey, o_custkey AS cod, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT cod FROM regp)""", "regp")
def unmatched_rows(t: Tables) -> DataFrame:
    return joins.unmatched(_orders(t), regp(t), ["cod"])


@query("""SELECT 'igual' AS tipo, count(*) AS n FROM nfact JOIN (SELECT DISTINCT inst FROM nfact) d ON nfact.inst = d.inst
          UNION ALL
          SELECT 'nulo_seguro', count(*) FROM nfact JOIN (SELECT DISTINCT inst FROM nfact) d
          ON nfact.inst IS NOT DISTINCT FROM d.inst""", "nfact")
def join_null_safe(t: Tables) -> DataFrame:
    rows = nfact(t)
    named = rows.select("inst").distinct()
    plain = joins.lookup(rows.select("inst"), named, ["inst"], "inner")
    safe = joins.lookup(rows.select("inst"), named, ["inst"], "inner", null_safe=True)
    return plain.agg(F.lit("igual").alias("tipo"), F.count(F.lit(1)).alias("n")).unionByName(
        safe.agg(F.lit("nulo_seguro").alias("tipo"), F.count(F.lit(1)).alias("n")))


def _dup(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority")


@query("""SELECT CAST(sum(n - 1) AS BIGINT) AS duplicadas FROM
          (SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus, o_orderpriority)""")
def duplicate_count(t: Tables) -> DataFrame:
    return quality.duplicate_count(_dup(t))


@query("""SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderstatus, o_orderpriority ORDER BY o_orderkey) > 1""")
def duplicate_rows(t: Tables) -> DataFrame:
    return quality.duplicate_rows(_dup(t))


PROFILED = ["inst", "seg", "atividade", "cart", "ativo", "anomes"]


@query("SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in [*PROFILED, "lucro"]) + " FROM nfact", "nfact")
def null_profile(t: Tables) -> DataFrame:
    return quality.null_counts(nfact(t).select(*PROFILED, "lucro"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS coluna, CAST(count(*) - count({c}) AS BIGINT) AS nulos, count({c}) AS preenchidos FROM nfact"
                          for c in [*PROFILED, "lucro"]), "nfact")
def null_profile_long(t: Tables) -> DataFrame:
    return quality.null_profile(nfact(t).select(*PROFILED, "lucro")).drop("proporcao")


@query(" UNION ALL ".join(f"SELECT '{c}' AS coluna, round(1 - count({c}) / count(*), 6) AS proporcao FROM nfact"
                          for c in [*PROFILED, "lucro"]), "nfact")
def null_ratio(t: Tables) -> DataFrame:
    profile = quality.null_profile(nfact(t).select(*PROFILED, "lucro"))
    return profile.select("coluna", F.round("proporcao", 6).alias("proporcao"))


def _profile_sql() -> str:
    kinds = {"inst": "string", "seg": "string", "atividade": "string", "cart": "double", "ativo": "double", "anomes": "int"}
    parts = []
    for c, kind in kinds.items():
        number = kind != "string"
        text = f"CAST({c} AS VARCHAR)"
        top = f"(SELECT {{}} FROM (SELECT {text} AS v, count(*) AS f FROM nfact WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY f DESC, v LIMIT 1))"
        stats = [f"CAST(count(*) FILTER ({c} = 0) AS BIGINT)", f"round(avg({c}), 2)", f"round(stddev({c}), 2)",
                 f"CAST(min({c}) AS DOUBLE)", *(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 2)" for p in (.25, .5, .75)),
                 f"CAST(max({c}) AS DOUBLE)"]
        if not number:
            stats = ["CAST(NULL AS BIGINT)"] + ["CAST(NULL AS DOUBLE)"] * 7
        names = ["zeros", "media", "desvio", "minimo", "q1", "mediana", "q3", "maximo"]
        parts.append(
            f"SELECT '{c}' AS coluna, '{kind}' AS tipo, count({c}) AS preenchidos, CAST(count(*) - count({c}) AS BIGINT) AS nulos, "
            f"count(DISTINCT {c}) AS distintos, {top.format('v')} AS moda, {top.format('f')} AS frequencia, "
            + ", ".join(f"{s} AS {n}" for s, n in zip(stats, names)) + " FROM nfact")
    return " UNION ALL ".join(parts)


@query(_profile_sql(), "nfact")
def column_profile(t: Tables) -> DataFrame:
    # stored: the profile reads it several times, the join should run once
    profile = quality.column_profile(written(nfact(t, heavy=True).select(*PROFILED), "profiled"))
    return profile.withColumns({c: F.round(c, 2) for c in ["media", "desvio", "q1", "mediana", "q3"]})


CHECKED = {"event_type": Expected("string"), "valor": Expected("double"), "usuario": Expected("bigint"),
           "props": Expected("string", nullable=True)}


def _broken(t: Tables) -> DataFrame:
    """Events as text, with unreadable values for errors and no value for large clicks."""
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("value").cast("string"))) \
        .when((F.col("event_type") == "click") & (F.col("value") > 10), None).otherwise(F.col("value").cast("string"))
    user = F.when(F.col("event_type") == "view", F.concat(F.lit("u"), F.col("user_id").cast("string"))).otherwise(
        F.col("user_id").cast("string"))
    return t.events.select("event_id", "event_type", value.alias("valor"), user.alias("usuario"), "props")


_BROKEN = """
    SELECT event_id, 'valor' AS coluna, 'dtype(''double'')' AS verificacao, 'x' || CAST(value AS VARCHAR) AS valor
    FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, 'valor', 'not_nullable', NULL FROM events WHERE event_type = 'click' AND value > 10
    UNION ALL SELECT event_id, 'usuario', 'dtype(''bigint'')', 'u' || CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'view'"""


@query(_BROKEN)
def schema_check_failures(t: Tables) -> DataFrame:
    return quality.schema_failures(_broken(t), CHECKED, ["event_id"])


@query(f"SELECT coluna, verificacao, count(*) AS falhas FROM ({_BROKEN}) GROUP BY 1, 2")
def schema_check_summary(t: Tables) -> DataFrame:
    return quality.schema_summary(quality.schema_failures(_broken(t), CHECKED, ["event_id"]))


@query("""SELECT coluna, distintos FROM (
            SELECT 'moeda' AS coluna, count(DISTINCT 'R$') AS distintos FROM part
            UNION ALL SELECT 'vazia', CAST(0 AS BIGINT)
            """ + "".join(f"UNION ALL SELECT '{c}', count(DISTINCT {c}) FROM part "
                          for c in ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
       + ") WHERE distintos <= 1")
def constant_columns(t: Tables) -> DataFrame:
    df = t.part.withColumns({"moeda": F.lit("R$"), "vazia": F.lit(None).cast("string")})
    return quality.constant_columns(df)
