import pytest
from pyspark.sql import functions as F

from finmart.operators import aggregate, columns, filters, narrow, quality
from finmart.operators.quality import Expected


def test_duplicates_of_a_hot_row(spark):
    """One row has far more copies than a run holds; nothing is lost."""
    many = quality.COPIES_PER_RUN * 3 + 17
    hot = spark.range(many).select(F.lit("hot").alias("a"), F.lit(None).cast("int").alias("b"))
    rest = spark.createDataFrame([("x", 1), ("x", 1), ("x", 1), ("y", 2)], "a string, b int")
    df = hot.unionByName(rest)
    assert quality.duplicate_count(df).first()[0] == many - 1 + 2
    counts = {tuple(r)[:2]: r["count"] for r in quality.duplicate_rows(df).groupBy("a", "b").count().collect()}
    assert counts == {("hot", None): many - 1, ("x", 1): 2}
    assert quality.duplicate_count(df.where("false")).first()[0] == 0
    assert quality.duplicate_count(spark.range(5)).first()[0] == 0


def test_schema_check_reports_every_failure(spark):
    df = spark.createDataFrame([("1", None, "1.5"), ("2", "State", "n/d"), ("3", "City", None)], "k string, level string, amount string")
    expected = {"level": Expected("string"), "amount": Expected("double"), "debt": Expected("double"),
                "note": Expected("string", required=False)}
    found = quality.schema_failures(df, expected, ["k"])
    assert {tuple(r) for r in found.collect()} == {
        ("1", "level", "not_nullable", None), ("2", "amount", "dtype('double')", "n/d"),
        ("3", "amount", "not_nullable", None), (None, "debt", "column_in_dataframe", None)}
    assert quality.schema_summary(found).count() == 4
    good = {"level": Expected("string", nullable=True), "k": Expected("int")}
    assert quality.schema_failures(df, good, ["k"]).count() == 0


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, None), (0, "b", None)], "n int, `t.x` string, e string")
    profile = {r["coluna"]: r for r in quality.column_profile(df).collect()}
    assert (profile["n"]["zeros"], profile["n"]["mediana"], profile["n"]["distintos"]) == (1, 1.5, 4)
    assert (profile["t.x"]["moda"], profile["t.x"]["frequencia"], profile["t.x"]["nulos"]) == ("a", 2, 1)
    assert (profile["e"]["distintos"], profile["e"]["preenchidos"], profile["e"]["moda"]) == (0, 0, None)
    assert {r["coluna"] for r in quality.constant_columns(df).collect()} == {"e"}
    shares = {r["coluna"]: r["proporcao"] for r in quality.null_profile(df).collect()}
    assert shares == {"n": 0.0, "t.x": 0.25, "e": 1.0}
    assert tuple(quality.null_counts(df).first()) == (0, 1, 4)
    assert tuple(quality.shape(df).first()) == (4, 3)


def test_profile_takes_few_jobs(spark):
    """The statistics do not cost a job per column."""
    wide = spark.range(50).select(*(F.col("id").alias(f"c{i}") for i in range(30)))
    tracker, group = spark.sparkContext.statusTracker(), "null-profile"
    spark.sparkContext.setJobGroup(group, group)
    quality.null_profile(wide).collect()
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 2


def test_fill(spark):
    df = spark.createDataFrame([(None, None), (1.5, "a")], "n double, t string")
    assert [tuple(r) for r in filters.fill(df, {"n": 0.0, "t": "Na"}).collect()] == [(0.0, "Na"), (1.5, "a")]
    with pytest.raises(TypeError):
        filters.fill(df, {"n": "Na"})


def test_exclusions_keep_nulls(spark):
    df = spark.createDataFrame([("COOPERATIVA X",), ("BANCO COOPER",), ("BANCO",), (None,)], "nome string")
    assert {r[0] for r in filters.exclude_containing(df, "nome", ["COOPER"]).collect()} == {"BANCO", None}
    assert {r[0] for r in filters.exclude_prefix(df, "nome", "COOPERATIVA").collect()} == {"BANCO COOPER", "BANCO"}
    assert {r[0] for r in filters.exclude_values(df, "nome", ["BANCO"]).collect()} == {"COOPERATIVA X", "BANCO COOPER", None}


def test_semi_and_anti_are_a_partition(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    listing = df.where("k % 3 = 0")
    assert filters.keep_listed(df, listing, ["k"]).count() + filters.exclude_by_rules(df, listing, ["k"]).count() == 100


def test_replace_exact_and_header_rows(spark):
    df = spark.createDataFrame([("-",), ("-1,5",), ("v",)], "v string")
    assert [r[0] for r in filters.replace_exact(df, {"-": "0.00"}, ["v"]).collect()] == ["0.00", "-1,5", "v"]
    assert filters.drop_header_rows(df, "v").count() == 2


def test_narrowing(spark):
    df = spark.range(1000).select(
        F.col("id"), (F.col("id") * 3_000_000).alias("big"), (F.col("id") / 7).alias("d"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("cat"), F.col("id").cast("string").alias("text"),
        F.lit("2020-01-31").alias("day"), F.array("id").alias("list"))
    plan = narrow.narrowing_plan(df, ["day"])
    # 999 * 3,000,000 needs a bigint, so "big" is left alone; as are distinct texts and lists
    assert plan == {"id": "smallint", "d": "float", "cat": "category", "day": "date"}
    out = narrow.narrow(df, plan)
    assert dict(out.dtypes)["id"] == "smallint" and dict(out.dtypes)["day"] == "date"
    codes = {(r["cat"], r["codigo"]) for r in narrow.code_table(df, "cat").collect()}
    assert codes == {(f"c{i}", i) for i in range(5)}
    assert out.groupBy("cat_codigo").count().count() == 5


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a", "b", "c"])
    assert columns.insert_after(df, "a", "x", F.lit(0)).columns == ["a", "x", "b", "c"]
    assert columns.insert_first(df, "c", F.lit(9)).columns == ["c", "a", "b"]
    assert columns.drop_first(df).columns == ["b", "c"]
    assert columns.rename_at(df, {-1: "z"}).columns == ["a", "b", "z"]
    assert columns.rename(df, {"a": "x", "nope": "y"}).columns == ["x", "b", "c"]
    with pytest.raises(ValueError):
        columns.rename_positional(df, ["x", "y"])


def test_unpivot_undoes_pivot(spark):
    long = spark.createDataFrame([("a", 2019, 1.0), ("a", 2020, 2.0), ("b", 2019, 3.0)], "k string, ano int, valor double")
    wide = columns.prefix(long.groupBy("k").pivot("ano", [2019, 2020]).sum("valor"), "ano_", {"k": "k"})
    back = columns.years_to_rows(wide, ["k"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, t string")
    b = spark.createDataFrame([(2.5, 1)], "v double, k int")
    out = columns.union_by_name(a, a, b)
    assert out.columns == ["k", "t", "v"] and out.count() == 3
    assert [tuple(r) for r in out.orderBy("v").collect()] == [(1, "x", None), (1, "x", None), (1, None, 2.5)]


def test_session_settings_and_in_memory_rows(spark):
    assert columns.session_settings(spark).columns == ["key", "value"]
    assert columns.session_settings(spark).where("key = 'spark.sql.shuffle.partitions'").count() == 1
    from finmart.sources.layouts import REGISTRY
    df = columns.rows_to_frame(spark, [("1", "Banco", None, None, "SP", None, "A")], REGISTRY)
    assert df.schema == REGISTRY and df.count() == 1


def test_long_texts_are_profiled_by_digest(spark):
    """The most frequent value, its ties and the distinct count are those of the whole texts."""
    a, b, c = "b" * 50, "a" * 60, "z" * 41
    rows = [(a, a, 1), (a, b, 2), (b, c, 3), (b, "short", 4), ("short", None, 5), (None, "", 6)]
    df = spark.createDataFrame(rows, "`twice.x` string, once string, n int")
    got = {r["coluna"]: tuple(r)[1:] for r in aggregate.top_values(df, df.columns).collect()}
    assert got == {"twice.x": (3, b, 2), "once": (5, "", 1), "n": (6, "1", 1)}
    assert {r["coluna"]: r["distintos"] for r in quality.distinct_counts(df).collect()} == {"twice.x": 3, "once": 5, "n": 6}
    profile = {r["coluna"]: r for r in quality.column_profile(df).collect()}
    assert (profile["twice.x"]["moda"], profile["twice.x"]["frequencia"], profile["once"]["distintos"]) == (b, 2, 5)
    assert aggregate.top_values(df.where("false"), df.columns).count() == 0
    digest = "c" * 64
    near = spark.createDataFrame([(digest,), (digest,), ("d" * 40,), ("d" * 41,)], "t string")
    assert tuple(aggregate.top_values(near, ["t"]).first()) == ("t", 3, digest, 2)
