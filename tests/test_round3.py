"""What the third review found: signs of zero, and steps whose tasks grew with the table."""

import duckdb
import pytest

from finmart import catalog
from finmart.operators import correlation, joins, ordering
from finmart.session import dealt
from tests.compare import assert_same

SMALL = "/root/testdata/sf0.001"


def test_quarantine_goes_by_the_balance_and_not_by_its_text(spark, folder):
    """-0.0 is printed with a sign but is no negative amount; -0.003 is one, though it is printed as zero."""
    connection = duckdb.connect()
    connection.execute(f"""COPY (SELECT * REPLACE (CASE WHEN c_custkey % 7 = 0 THEN -0.0::DOUBLE WHEN c_custkey % 11 = 0 THEN -0.003
                           ELSE c_acctbal END AS c_acctbal) FROM '{SMALL}/customer.parquet') TO '{folder}/customer.parquet'""")
    connection.execute(f"CREATE VIEW customer AS SELECT * FROM '{folder}/customer.parquet'")
    name = "job_precatorios_quarantine"
    assert_same(catalog.QUERIES[name](spark, folder), connection.sql(catalog.SQL[name]))


def test_latest_deals_many_rows_to_several_tasks(spark):
    """One file with one row group is one task, which had to sort every row."""
    listings = spark.range(0, 2000, 1, 1).selectExpr("id % 40 AS k", "id DIV 40 AS p", "concat('n', id) AS name")
    assert dealt(listings, 2000, "k", "p", most=100).rdd.getNumPartitions() == 20
    assert dealt(listings, 2000, "k", "p").rdd.getNumPartitions() == 1
    plain = sorted(map(tuple, joins.latest(listings, ["k"], "p").collect()))
    assert plain == [(k, 49, f"n{49 * 40 + k}") for k in range(40)]
    assert sorted(map(tuple, joins.latest(listings, ["k"], "p", in_task=100).collect())) == plain


def test_many_small_groups_are_not_ordered_as_a_whole(spark, monkeypatch):
    """Beyond the rows of one task, groups that are small each had all their values bracketed, stored and ordered."""
    df = spark.range(6000).selectExpr("IF(id < 3000, 0, id % 300) AS g", "CAST((id * 7919) % 1009 AS DOUBLE) AS v")
    values = df.toPandas()
    expected = values.groupby("g")["v"].quantile([0.25, 0.5]).unstack()
    ordered = []
    placed = ordering._placed
    monkeypatch.setattr(ordering, "_placed", lambda frame, *rest: ordered.append(frame.agg({"_n": "sum"}).first()[0]) or placed(frame, *rest))
    for small_group, rows in ((5000, []), (100, [3000])):  # no large group, and one beside 300 small ones
        ordered.clear()
        got = ordering.quantiles(df, "v", [0.25, 0.5], ["g"], ["a", "b"], in_task=0, small_group=small_group, accuracy=20)
        got = got.toPandas().set_index("g").sort_index()
        assert got.to_numpy() == pytest.approx(expected.to_numpy())
        assert len(ordered) == len(rows) and all(n <= 2 * most for n, most in zip(ordered, rows))


def test_spearman_orders_a_value_once_for_all_rankings(spark, monkeypatch):
    """A value went through the order, and to two tables, once for each ranking that its column needs."""
    df = spark.range(400).selectExpr("CAST(id * 7919 % 101 AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, CAST(id * 31 % 57 AS DOUBLE)) AS b",
                                     "IF(id % 5 = 0, NULL, CAST(id * 17 % 13 AS DOUBLE)) AS c")
    ordered = []
    placed = ordering._placed
    monkeypatch.setattr(ordering, "_placed", lambda frame, *rest: ordered.append(frame.count()) or placed(frame, *rest))
    # the second time no side is broadcast, so the counts name the hot values
    for limit in (correlation.BROADCAST_BYTES, 0):
        monkeypatch.setattr(correlation, "BROADCAST_BYTES", limit)
        expected = df.toPandas().corr("spearman")
        for r in correlation.spearman(df, ["a", "b", "c"]).collect():
            assert r["r"] == pytest.approx(expected.loc[r["a"], r["b"]], abs=1e-9)
    assert ordered == [df.toPandas().nunique().sum()] * 2
