"""Connected components of a graph given as edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmart.session import written


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least neighbour of u, itself included.

    Both sides are stored tables, so Spark can split the rows of a node with very many neighbours.
    """
    least = written(pairs.groupBy("u").agg(F.min("v").alias("m")), "least")
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node with an edge can reach.

    ``edges`` has two long columns; loops, repeats and either direction are allowed, rows with a NULL are ignored. An
    empty table gives an empty table. Each round stores its edges in the shared folder, so a lost executor costs one
    round at most. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns[:2]
    clean = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull())
    nodes = clean.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    links = written(clean.where("u <> v").distinct(), "edges")
    for _ in range(max_rounds):
        # every larger neighbour of u points at the least node around u
        both = written(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large")
        # every smaller neighbour of u, and u, point at the least of them
        seen = _with_least(large)
        small = seen.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            seen.select("u", F.col("m").alias("v")))
        after = written(small.where("u <> v").distinct(), "edges")
        changed = after.join(links, ["u", "v"], "left_anti").limit(1).count() or links.join(
            after, ["u", "v"], "left_anti").limit(1).count()
        links = after
        if not changed:
            return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
                "node", F.coalesce("root", "node").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
