"""NaN is missing, -0.0 is zero, and nothing is lost in silence."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.functions import dates
from finmart.operators import aggregate, filters, narrow, ordering, quality
from finmart.session import measured_bytes, new_folder
from finmart.sources import envelope
from finmart.streaming.ingest import ingest_new, ingested, landed_files
from tests.test_sinks import SCHEMA, land


def numbers(spark):
    return spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", 3.0), ("a", None), ("b", -0.0), ("b", 0.0)], "k string, v double")


def test_statistics_leave_nan_out(spark):
    df = numbers(spark)
    for limit in (1000, 0):  # quartiles built in tasks, and by brackets
        got = {r["k"]: r for r in aggregate.describe(df, "v", ["k"], in_task=limit).collect()}
        assert (got["a"]["n"], got["a"]["media"], got["a"]["mediana"], got["a"]["maximo"]) == (2, 2.0, 2.0, 3.0)
    box = {r["k"]: r for r in aggregate.box_stats(df, "v", ["k"]).collect()}
    assert (box["a"]["bigode_inf"], box["a"]["bigode_sup"], box["a"]["fora"]) == (1.0, 3.0, 0)
    assert aggregate.box_outliers(df, "v", ["k"]).count() == 0
    assert quality.null_counts(df).first()["v"] == 2
    assert {r["coluna"]: r["nulos"] for r in quality.null_profile(df).collect()} == {"k": 0, "v": 2}
    assert {r["coluna"]: r["distintos"] for r in quality.distinct_counts(df).collect()} == {"k": 2, "v": 3}
    assert {r["coluna"]: r["preenchidos"] for r in quality.column_profile(df).collect()}["v"] == 4
    assert sorted(r["v"] for r in filters.fill(df, {"v": 9.0}).collect()) == [0.0, 0.0, 1.0, 3.0, 9.0, 9.0]


def test_dates_with_a_time_of_day(spark):
    df = spark.createDataFrame([("2019-01-01 10:30:00",), ("2019-01-02",), ("2019",), ("x",)], "x string")
    assert [str(r["d"]) for r in df.select(dates.iso_date("x").alias("d")).collect()] == ["2019-01-01", "2019-01-02", "None", "None"]
    stamps = df.select(F.col("x").try_cast("timestamp_ntz").alias("t")).select(dates.iso_date("t").alias("d"))
    assert str(stamps.first()["d"]) == "2019-01-01"
    plan = narrow.narrowing_plan(df, datetimes=["x"])
    assert str(narrow.narrow(df, plan).first()["x"]) == "2019-01-01 10:30:00"


def test_a_variant_listed_twice_keeps_the_rows(spark):
    df = spark.createDataFrame([("x",), ("y",)], "n string")
    mapping = spark.createDataFrame([("x", "B"), ("x", "A")], "variant string, canonical string")
    assert sorted(r["n"] for r in filters.canonicalise(df, "n", mapping).collect()) == ["A", "y"]


def test_tail_keeps_the_order(spark):
    assert [r["id"] for r in ordering.tail(spark.range(9), [("id", True)], 3).collect()] == [6, 7, 8]


def test_binary_columns_are_measured(spark):
    df = spark.range(1).select(F.repeat(F.lit("x"), 1_000_000).cast("binary").alias("b"))
    assert measured_bytes(df) > 1_000_000


def test_broken_documents_are_kept(spark, folder):
    record = T.StructType([T.StructField("Data", T.StringType())])
    texts = spark.createDataFrame([('{"value":[{"Data":"x"}]}',), ('{"value":[{"Data":"y"',), ('{"other":1}',), (None,)], "doc string")
    assert envelope.unreadable_envelopes(texts, "doc", record).count() == 2
    (__import__("pathlib").Path(folder) / "a.json").write_text('{"value":[{"Data":"x"}]}\n{"value":[{"Da\n')
    assert envelope.unreadable_files(spark, f"file://{folder}", record, per_line=True).count() == 1


def test_a_new_checkpoint_replaces_nothing(spark, folder):
    import os
    table = new_folder(spark, "table")
    for name, keys in (("one", range(5)), ("two", range(10, 17))):
        os.mkdir(f"{folder}/{name}")
        land(f"{folder}/{name}", "a", keys)
        ingest_new(landed_files(spark, f"file://{folder}/{name}", SCHEMA), table, new_folder(spark, "progress"))
    assert ingested(spark, table, SCHEMA).count() == 12
