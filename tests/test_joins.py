import pytest
from pyspark.sql import functions as F

from finmart.operators import joins


@pytest.fixture(scope="module")
def frames(spark):
    """A third of the facts share one key, another tenth has none; some keys are unknown; one is listed twice."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(7)).when(n % 10 == 1, None).otherwise((n % 500).cast("int"))
    facts = spark.range(30_000).select(n.alias("fact"), key.alias("key"))
    dim = spark.range(0, 400).select(F.col("id").cast("int").alias("key"), F.concat(F.lit("n"), "id").alias("name"))
    dim = dim.unionByName(spark.createDataFrame([(8, "again"), (None, "nobody")], "key int, name string"))
    return facts, dim


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_equals_broadcast(frames, how, null_safe):
    facts, dim = frames
    small = joins.lookup(facts, dim, ["key"], how, null_safe)
    big = joins.lookup(facts, dim, ["key"], how, null_safe, limit=0)
    assert small.columns == big.columns
    assert small.exceptAll(big).count() == big.exceptAll(small).count() == 0
    condition = (facts["key"].eqNullSafe(dim["key"])) if null_safe else facts["key"] == dim["key"]
    assert big.count() == facts.join(dim, condition, how).count()


def test_salting_spreads_the_hot_key(frames):
    facts, dim = frames
    assert {r["key"] for r in joins.hot_keys(facts, ["key"], 0.05).collect()} == {7, None}
    plan = joins.lookup(facts, dim, ["key"], limit=0)._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_hot_keys_are_bounded(frames):
    facts, _ = frames
    assert joins.hot_keys(facts, ["key"], 0.01).count() <= 100


def test_right_join_keeps_every_fact(frames):
    facts, dim = frames
    unique = dim.where("name <> 'again'")
    joined = joins.registry_join(facts, unique, "key", None)
    assert joined.count() == facts.count()
    unknown = joins.unmatched(facts, unique, ["key"]).count()
    assert joined.where("name IS NULL").count() == unknown > 0


def test_latest_listing_removes_the_fan_out(spark):
    listings = spark.createDataFrame(
        [("a", 201903, "old"), ("a", 201906, "new"), ("b", 201903, "only")], "CodInst string, AnoMes int, nome string")
    facts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "CodInst string, v int")
    rows = {(r["v"], r["nome"]) for r in joins.registry_join(facts, listings).collect()}
    assert rows == {(1, "new"), (2, "new"), (3, "only"), (4, None)}
    assert joins.registry_join(facts, listings, keep_listings=True).count() == 6
    assert joins.registry_join(facts, listings, how="inner").count() == 3


def test_self_derived_lookup(frames):
    facts, _ = frames
    counts = facts.groupBy("key").agg(F.count("*").alias("n"))
    for limit in (0, joins.BROADCAST_BYTES):
        assert joins.lookup(facts, counts, ["key"], "inner", null_safe=True, limit=limit).count() == facts.count()
