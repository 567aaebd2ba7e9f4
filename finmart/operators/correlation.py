"""Correlation matrices in long form: (a, b, r), one row per pair of columns."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.functions.numbers import nan_to_null
from finmart.operators.columns import quoted
from finmart.operators.joins import lookup
from finmart.operators.ordering import average_ranks
from finmart.session import BROADCAST_BYTES, spread, written


def _long(df: DataFrame, pairs: list[tuple[str, str, str, str]]) -> DataFrame:
    """One aggregate with a ``corr`` per pair (a, b, column of a, column of b); rows lacking either are skipped."""
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(quoted(x), quoted(y)).alias("r"))
             for a, b, x, y in pairs]
    return df.agg(F.array(*cells).alias("_all")).selectExpr("inline(_all)")


def pearson(df: DataFrame, columns: list[str]) -> DataFrame:
    return _long(nan_to_null(df), [(a, b, a, b) for a, b in combinations(columns, 2)])


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of average ranks, a pair's ranks taken over the rows that have both values.

    The cells are counted once by column and value, for each ranking that the column needs: one for every partner with
    gaps and one for all others. A value keeps all its rankings in one row, so that it is ordered once, and each column
    then gets all its ranks in one join, so there are as many joins, and copies of a row before the count, as columns.
    The counts also tell the joins which values are hot.
    """
    df = spread(nan_to_null(df.select(*(quoted(c).cast("double").alias(c) for c in columns))), *columns)
    missing = df.agg(*(F.count_if(quoted(c).isNull()).alias(c) for c in columns)).first().asDict()
    rankings: dict[tuple[str, str], str] = {}
    pairs = []
    for a, b in combinations(columns, 2):
        ranked = []
        for own, partner in ((a, b), (b, a)):
            key = (own, partner if missing[partner] else "")
            ranked.append(rankings.setdefault(key, f"_rank{len(rankings)}"))
        pairs.append((a, b, *ranked))
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")

    # how often a value counts in each ranking of its column: those of partners that the row lacks leave it out
    own_rankings = {c: [(partner, name) for (own, partner), name in rankings.items() if own == c] for c in columns}
    for c in columns:  # where all partners have gaps, no ranking of the column counts all rows of a value
        if all(partner for partner, _ in own_rankings[c]):
            own_rankings[c].append(("", f"_all_{c}"))
    widest = max(map(len, own_rankings.values()))
    weights = [f"_w{k}" for k in range(widest)]

    def cell(i: int, c: str) -> Column:
        counts = [F.lit(1) if not partner else F.when(quoted(partner).isNotNull(), 1).otherwise(0) for partner, _ in own_rankings[c]]
        counts += [F.lit(0)] * (widest - len(counts))
        return F.struct(F.lit(i).alias("_own"), quoted(c).alias("_value"), *(n.cast("long").alias(w) for n, w in zip(counts, weights)))

    cells = df.select(F.explode(F.array(*(cell(i, c) for i, c in enumerate(columns)))).alias("c")).select("c.*")
    counted = written(cells.where("_value IS NOT NULL").groupBy("_own", "_value").agg(
        *(F.sum(w).alias(w) for w in weights)), "cells")
    places = [f"_p{k}" for k in range(widest)]
    ranks = average_ranks(counted, "_value", ["_own"], dict(zip(weights, places)))
    sizes = dict(counted.groupBy("_own").count().collect())  # one row per column
    out = df
    for i, c in enumerate(columns):
        names = [name for _, name in own_rankings[c]]
        mine = ranks.where(F.col("_own") == i).select(F.col("_value").alias(c), *(F.col(p).alias(n) for p, n in zip(places, names)))
        all_rows = weights[[partner for partner, _ in own_rankings[c]].index("")]
        often = counted.where(F.col("_own") == i).select(F.col("_value").alias(c), F.col(all_rows).alias("_n"))
        # doubles alone: the count proves the size
        out = lookup(out, mine, [c], "left", fits=sizes.get(i, 0) * 32 * (1 + len(names)) <= BROADCAST_BYTES, counts=often)
    lacking = {name: F.when(quoted(partner).isNotNull(), F.col(name)) for (_, partner), name in rankings.items() if partner}
    return _long(out.withColumns(lacking) if lacking else out, pairs)
