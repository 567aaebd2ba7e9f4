"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from finmart import catalog
from finmart.operators import aggregate, filters, joins
from finmart.plans import ingest_cli
from finmart.plans.insights import ask
from finmart.session import new_folder, spread
from finmart.sources.sinks import Folder, Relational

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - {"odata_source", "job_registry", "stream_ingest"}))
def test_no_slow_operators(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text
    if name != "sheet_cells":  # the one format Spark has no reader for
        assert "InPandas" not in text


def test_filters_reach_the_scan(spark):
    path = new_folder(spark, "summary")
    columns = ["NomeInstituicao", "SegmentoTb", "Atividade"]
    df = spark.range(10).select(*(F.lit("x").alias(c) for c in columns), *(
        F.col("id").cast("double").alias(c) for c in ("Patrimonio_Liquido", "Lucro_Liquido", "Cart_Cred_Classif", "Ativo_Total")))
    df.write.parquet(path)
    text = plan(ask(spark, "negative_profit", spark.read.parquet(path)))
    assert "LessThan(Lucro_Liquido,0.0)" in text
    assert re.search(r"ReadSchema: struct<NomeInstituicao:string,Patrimonio_Liquido:double,Lucro_Liquido:double>", text)
    kept = plan(filters.keep_not_null(spark.read.parquet(path), "SegmentoTb").select("SegmentoTb"))
    assert "IsNotNull(SegmentoTb)" in kept and "ReadSchema: struct<SegmentoTb:string>" in kept


def test_pivot_shuffles_once(spark):
    df = spark.createDataFrame([("a", "x", "1")], "k string, c string, v string")
    text = plan(aggregate.pivot_sum(df, ["k"], "c", "v", ["x", "y"]))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_sum" in text


def test_a_measured_lookup_does_not_move_the_facts(spark):
    facts = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(7).select(F.col("id").alias("k"), F.lit("n").alias("n"))
    assert "BroadcastHashJoin" in plan(joins.lookup(facts, dim, ["k"]))
    assert "Exchange hashpartitioning" not in plan(joins.lookup(facts, dim, ["k"]))
    assert "Exchange hashpartitioning" in plan(joins.lookup(facts, dim, ["k"], limit=0).hint("merge"))


def test_index_never_sorts_in_one_task(spark):
    text = plan(catalog.QUERIES["row_index_sorted"](spark, FOLDER))
    window = text[text.index("Window"):]
    # the only window is over the partition sizes: its input is an aggregate by partition
    assert text.count("Window ") == 1 and "HashAggregate(keys=[_part" in window


def test_spread_leaves_split_tables_alone(spark):
    wide = spark.range(0, 100, 1, 16)
    assert spread(wide, "id") is wide
    assert spread(spark.range(0, 100, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_ingest_parameters(spark, folder, monkeypatch):
    (open(f"{folder}/d.json", "w")).write('{"value": [{"Data": "2021-01-04", "Total": 1}]}')
    out = new_folder(spark, "db")
    call = ["--input", f"file://{folder}/d.json", "--table", "pix", "--fields", "Data,Total", "--folder", out]
    assert ingest_cli.main(call, spark) == 0
    assert [tuple(r) for r in Folder(out).table(spark, "pix").collect()] == [("2021-01-04", "1")]
    monkeypatch.setenv("FINMART_DB_USER", "u")
    args = ingest_cli.arguments([*call[:6], "--jdbc-url", "jdbc:x"])
    target = ingest_cli.target_of(args)
    assert isinstance(target, Relational) and target.properties == {"user": "u"}
    with pytest.raises(SystemExit):
        ingest_cli.arguments(["--table", "x"])
