import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from finmart.operators import aggregate, correlation, ordering

PROBS = [0, 0.1, 0.25, 0.5, 0.75, 0.99, 1]


@pytest.fixture(scope="module")
def data(spark):
    """Half of the rows in one group, and a third of all values equal; some NULLs."""
    rng = np.random.default_rng(5)
    n = 6000
    pdf = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c"], n)),
        "v": np.where(rng.random(n) < 0.33, 10.0, rng.normal(0, 50, n).round(3)),
        "w": rng.integers(0, 9, n).astype(float), "id": np.arange(n)})
    pdf.loc[pdf["id"] % 11 == 0, "v"] = np.nan
    rows = [(r.g, None if np.isnan(r.v) else float(r.v), float(r.w), int(r.id)) for r in pdf.itertuples()]
    return pdf, spark.createDataFrame(rows, "g string, v double, w double, id long")


def test_row_index_is_the_sorted_order(data):
    pdf, df = data
    out = ordering.row_index(df, [F.desc_nulls_last("v"), F.col("id")]).toPandas().sort_values("indice")
    expected = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert out["indice"].tolist() == list(range(len(pdf)))
    assert out["id"].tolist() == expected["id"].tolist()


def test_row_at(data):
    pdf, df = data
    order = [F.col("w"), F.col("id")]
    expected = pdf.sort_values(["w", "id"])["id"].iloc[74]
    assert ordering.row_at(df, order, 74).first()["id"] == expected
    assert ordering.row_at(df, order, 74, direct=10).first()["id"] == expected
    assert ordering.row_at(df, order, len(pdf)).count() == 0


def test_tail(data):
    pdf, df = data
    assert {r["id"] for r in ordering.tail(df, [("id", True)], 5).collect()} == set(range(len(pdf) - 5, len(pdf)))


def test_average_rank(data):
    pdf, df = data
    out = ordering.average_rank(df, "v").toPandas().set_index("v")["posto"]
    expected = pdf["v"].dropna().to_frame().assign(r=lambda d: d["v"].rank()).drop_duplicates().set_index("v")["r"]
    pd.testing.assert_series_equal(out.sort_index(), expected.sort_index(), check_names=False)


def test_average_rank_by_group(data):
    pdf, df = data
    out = ordering.average_rank(df, "v", ["g"]).toPandas().set_index(["g", "v"])["posto"].sort_index()
    present = pdf.dropna(subset=["v"])
    expected = present.assign(r=present.groupby("g")["v"].rank()).drop_duplicates(["g", "v"]).set_index(["g", "v"])["r"]
    pd.testing.assert_series_equal(out, expected.sort_index(), check_names=False)


# the built-in, small groups taken whole, and real brackets: narrow ones with a coarse sketch, wide ones
WAYS = [{}, {"in_task": 0}, {"in_task": 0, "small_group": 0, "accuracy": 100}, {"in_task": 0, "small_group": 0, "accuracy": 10}]


@pytest.mark.parametrize("way", WAYS)
def test_quantiles(data, way):
    pdf, df = data
    names = [f"p{i}" for i in range(len(PROBS))]
    whole = ordering.quantiles(df, "v", PROBS, names=names, **way).first()
    assert list(whole) == pytest.approx(pdf["v"].quantile(PROBS).tolist())
    by_group = ordering.quantiles(df, "v", PROBS, ["g"], names, **way).toPandas().set_index("g").sort_index()
    expected = pdf.groupby("g")["v"].quantile(PROBS).unstack()
    np.testing.assert_allclose(by_group.to_numpy(), expected.to_numpy())


def test_brackets_that_miss_are_noticed(data, monkeypatch):
    """A sketch that points to the wrong place must not give a wrong quantile."""
    pdf, df = data
    calls = []
    ordered = ordering._all_ordered
    monkeypatch.setattr(ordering, "_all_ordered", lambda *a: calls.append(1) or ordered(*a))
    monkeypatch.setattr(ordering.F, "percentile_approx", lambda column, ends, accuracy: F.array(*(F.lit(1e6) for _ in ends)))
    found = ordering.quantiles(df, "v", [0.25, 0.5], names=["a", "b"], in_task=0, small_group=0).first()
    assert calls and list(found) == pytest.approx(pdf["v"].quantile([0.25, 0.5]).tolist())


def test_brackets_keep_few_values(spark):
    """A third of the rows share one value; what is ordered in the end is a small part of the table."""
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.rand(7) * 10).alias("v"))
    stored = []
    real = ordering.written
    ordering.written = lambda frame, label: stored.append((label, real(frame, label))) or stored[-1][1]
    try:
        found = ordering.quantiles(df, "v", [0.25, 0.5, 0.75], in_task=0, accuracy=1000).first()
    finally:
        ordering.written = real
    assert list(found) == pytest.approx(df.toPandas()["v"].quantile([0.25, 0.5, 0.75]).tolist())
    sizes = {label: frame.count() for label, frame in stored}
    assert sizes["bands"] < 200_000 * 3 * 6 / 1000


@pytest.mark.parametrize("in_task", [0, ordering.IN_TASK_ROWS])
def test_describe(data, in_task):
    pdf, df = data
    out = aggregate.describe(df, "v", ["g"], in_task).toPandas().set_index("g").sort_index()
    expected = pdf.groupby("g")["v"].describe()
    np.testing.assert_allclose(out[["n", "media", "desvio", "minimo", "q1", "mediana", "q3", "maximo"]], expected)
    out = aggregate.describe_numeric(df, ["v", "w"], in_task=in_task).toPandas().set_index("coluna").sort_index()
    expected = pdf[["v", "w"]].describe().T
    np.testing.assert_allclose(out[["n", "media", "desvio", "minimo", "q1", "mediana", "q3", "maximo"]], expected)


@pytest.mark.parametrize("in_task", [0, ordering.IN_TASK_ROWS])
def test_box_numbers(data, in_task):
    pdf, df = data
    v = pdf["v"].dropna()
    q1, q3 = v.quantile([0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = v[v.between(low, high)]
    box = aggregate.box_stats(df, "v", [], in_task=in_task).first()
    assert (box["bigode_inf"], box["bigode_sup"], box["fora"]) == (inside.min(), inside.max(), len(v) - len(inside))
    assert aggregate.box_outliers(df, "v", [], in_task=in_task).count() == box["fora"] > 0
    by_group = aggregate.box_stats(df, "v", ["g"], in_task=in_task)
    assert by_group.agg(F.sum("fora")).first()[0] == aggregate.box_outliers(df, "v", ["g"], in_task=in_task).count()


def test_correlations(data):
    pdf, df = data
    columns = ["v", "w", "id"]
    for found, method in ((correlation.pearson, "pearson"), (correlation.spearman, "spearman")):
        expected = pdf[columns].corr(method)
        for r in found(df, columns).collect():
            assert r["r"] == pytest.approx(expected.loc[r["a"], r["b"]], abs=1e-9), (method, r)


def test_spearman_with_gaps_in_both(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.integers(0, 20, (500, 3)).astype(float), columns=list("abc")).mask(rng.random((500, 3)) < 0.2)
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in pdf.to_numpy()]
    out = correlation.spearman(spark.createDataFrame(rows, "a double, b double, c double"), list("abc"))
    expected = pdf.corr("spearman")
    for r in out.collect():
        assert r["r"] == pytest.approx(expected.loc[r["a"], r["b"]], abs=1e-9)
