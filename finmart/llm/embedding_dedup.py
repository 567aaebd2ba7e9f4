"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations.

A rotation flips signs and applies the Hadamard transform, three times. A vector's hash under one rotation is its
largest coordinate and that coordinate's sign, the nearest corner of the cross-polytope. A table joins ``width``
such hashes into a bucket. Each vector lies in its own bucket of every table and also asks the buckets of its
next-best corners. Whoever meets is compared exactly, in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.llm.base import needed, sorted_groups
from finmart.llm.components import components
from finmart.session import written

# Expected vectors in a bucket; the width of the buckets follows the number of vectors.
BUCKET_ROWS = 16
# Vectors of one bucket that are compared in one block; a fuller bucket becomes a grid of blocks.
BLOCK_ROWS = 512


def rotations(dim: int, count: int, seed: int) -> np.ndarray:
    """Signs (count, 3, padded dim); padded to a power of two."""
    size = 1 << max(0, dim - 1).bit_length()
    return np.random.default_rng(seed).choice([-1.0, 1.0], size=(count, 3, size))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, size = rows.shape
    out, half = rows, 1
    while half < size:
        pairs = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out / math.sqrt(size)


def bucket_codes(unit: np.ndarray, signs: np.ndarray, width: int, probes: int) -> np.ndarray:
    """Buckets (rows, tables, 1 + probes): the own bucket first, then those of the next-best corners.

    Candidates for a probe replace one or two of the table's corners by the runner-up; those that lose least come first.
    """
    n, (count, _, size) = len(unit), signs.shape
    padded = np.zeros((n, size))
    padded[:, :unit.shape[1]] = unit
    best = np.empty((n, count, 2), np.int64)
    loss = np.empty((n, count))
    for r in range(count):
        y = padded
        for s in signs[r]:
            y = hadamard(y * s)
        size_of = np.abs(y)
        order = np.argpartition(-size_of, min(1, size - 1), axis=1)[:, :2]
        if order.shape[1] == 1:
            order = np.repeat(order, 2, axis=1)
        held = np.take_along_axis(size_of, order, 1)
        order = np.where((held[:, :1] >= held[:, 1:]), order, order[:, ::-1])
        top = np.take_along_axis(y, order, 1)
        best[:, r] = 2 * order + (top < 0)
        loss[:, r] = np.abs(top[:, 0]) - np.abs(top[:, 1])
    tables = count // width
    best, loss = best.reshape(n, tables, width, 2), loss.reshape(n, tables, width)
    # each way to take the runner-up in one or two places
    ways = [()] + [(i,) for i in range(width)] + [(i, j) for i in range(width) for j in range(i + 1, width)]
    cost = np.stack([loss[:, :, list(w)].sum(2) if w else np.full((n, tables), -1.0) for w in ways], axis=2)
    codes = np.zeros((n, tables, len(ways)), np.int64)
    for k, way in enumerate(ways):
        for i in range(width):
            codes[:, :, k] = codes[:, :, k] * (2 * size) + best[:, :, i, 1 if i in way else 0]
    order = np.argsort(cost, axis=2, kind="stable")[:, :, :1 + probes]
    return np.take_along_axis(codes, order, 2)


def _bucket_rows(signs: np.ndarray, width: int, probes: int, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2048) for i in range(0, batch.num_rows, 2048)):
                raw = part.column(1).to_pylist()
                vectors = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), dim)
                codes = bucket_codes(vectors, signs, width, probes)
                n, tables, each = codes.shape
                table_of = np.broadcast_to(np.arange(tables)[None, :, None], codes.shape)
                row = np.broadcast_to(np.arange(n)[:, None, None], codes.shape).ravel()
                asks = np.broadcast_to(np.arange(each)[None, None, :] > 0, codes.shape).ravel()
                yield pa.RecordBatch.from_arrays([
                    pa.array(part.column(0).to_numpy()[row]),
                    pa.array(table_of.ravel().astype(np.int32)), pa.array(codes.ravel()), pa.array(asks)],
                    names=["node", "slot", "bucket", "asks"])
    return run


def _unit_rows(dim: int):
    """Unit vectors as raw doubles; NULL for rows that can link with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws: list[bytes | None] = []
            for values in batch.column(1).to_pylist():
                if values is None:
                    raws.append(None)
                    continue
                vector = np.array(values, np.float64)
                vector = vector / np.abs(vector).max()  # lengths of very large or small vectors stay finite
                raws.append((vector / math.sqrt(float(vector @ vector)) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raws, pa.binary())], names=["vec_id", "unit"])
    return run


def _block_links(threshold: float, dim: int, signs: np.ndarray, width: int, probes: int):
    """Links inside one block, each counted once over all tables: by the first table in which the two meet.

    A block tells one row per node that has a link in it: the vectors linked there, copies included, and the smallest
    node that these links reach. Its output grows with its rows, not with its pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, "block"):
            lies = np.flatnonzero(group.column("lies").to_numpy())
            goes = np.flatnonzero(group.column("goes").to_numpy())
            if not len(lies) or not len(goes) or group.num_rows < 2:
                continue
            asks = group.column("asks").to_numpy()
            node = group.column("node").to_numpy()
            copies = group.column("copies").to_numpy()
            unit = np.frombuffer(b"".join(group.column("unit").to_pylist()), np.float64).reshape(len(node), dim)
            slot = group.column("slot")[0].as_py()
            q, d = np.nonzero(unit[goes] @ unit[lies].T >= threshold)
            q, d = goes[q], lies[d]
            # two that both lie in the bucket are seen twice; the larger node reports
            keep = (node[q] != node[d]) & (asks[q] | (node[q] > node[d]))
            q, d = q[keep], d[keep]
            if not len(q):
                continue
            rows, place = np.unique(np.concatenate([q, d]), return_inverse=True)
            codes = bucket_codes(unit[rows], signs, width, probes)
            one, two = codes[place[:len(q)]], codes[place[len(q):]]
            meet = (one == two[:, :, :1]).any(2) | (two == one[:, :, :1]).any(2)
            # asked from both sides in one table: the larger node reports
            here_one, here_two = one[:, slot], two[:, slot]
            mutual = (here_one == here_two[:, :1]).any(1) & (here_two == here_one[:, :1]).any(1)
            first = (meet.argmax(1) == slot) & (~mutual | (node[q] > node[d]))
            if not first.any():
                continue
            q, d = q[first], d[first]
            names, place = np.unique(np.concatenate([node[q], node[d]]), return_inverse=True)
            one, two = place[:len(q)], place[len(q):]
            others = np.zeros(len(names), np.int64)
            np.add.at(others, one, copies[d])
            np.add.at(others, two, copies[q])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(names[_least_reached(one, two, len(names))]), pa.array(others)],
                names=["node", "root", "others"])
    return run


def _least_reached(one: np.ndarray, two: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each of ``n`` places reaches over the links."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, one, root[two])
        np.minimum.at(least, two, root[one])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _sound(vector_col: str) -> Column:
    """The vector in doubles, NULL where it can link with nothing."""
    values = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & F.exists(values, lambda x: x != 0), values)


def lengths(df: DataFrame, vector_col: str = "embedding") -> list[tuple[int, int]]:
    """(length, number) of the vectors that can link, the commonest length first; a handful of lengths."""
    sizes = df.select(F.size(_sound(vector_col)).alias("dim")).where("dim > 0").groupBy("dim").count()
    return [tuple(r) for r in sizes.orderBy(F.desc("count"), "dim").collect()]


def link_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                 tables: int = 10, probes: int = 2, seed: int = 7, length: tuple[int, int] | None = None,
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): all rows, their distinct directions, and what each block tells of the links between them.

    ``rows`` has ``vec_id`` and ``unit`` (raw doubles; NULL where the vector is NULL, zero, empty, of another length
    than ``length`` (length and number of vectors; by default the commonest), or holds a NULL or a non-finite component:
    such rows are in no class). ``classes`` has ``unit``, ``node``,
    ``least`` (smallest id) and ``copies``; ``links`` has ``node``, ``root`` (a node that it reaches) and ``others`` (vectors
    linked directly, copies included; each link is in one block's sum). Equal directions are one class before any bucket
    is made, so copies cost nothing; a full bucket is cut into a grid of blocks, so none is one task's work and no pair
    in it is lost.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), _sound(vector_col).alias("vector"))
    dim, total = length or (lengths(df, vector_col) or [(1, 0)])[0]
    rows = written(vectors.withColumn("vector", F.when(F.size("vector") == dim, F.col("vector"))).mapInArrow(
        _unit_rows(dim), "vec_id long, unit binary"), "units")
    classes = rows.where("unit IS NOT NULL").groupBy("unit").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    size = 1 << max(0, dim - 1).bit_length()
    width = max(1, math.ceil(math.log(max(2, total / BUCKET_ROWS)) / math.log(2 * size)))
    signs = rotations(dim, tables * width, seed)
    buckets = written(classes.select("node", "unit").mapInArrow(
        _bucket_rows(signs, width, probes, dim), "node long, slot int, bucket long, asks boolean"), "buckets")
    full = buckets.groupBy("slot", "bucket").agg(
        F.count(F.lit(1)).alias("all"), F.count(F.when(~F.col("asks"), 1)).alias("own"))
    # a bucket matters when someone lies in it and someone else comes by
    full = full.where("own > 0 AND all > 1").select(
        "slot", "bucket", F.ceil(F.col("own") / BLOCK_ROWS).cast("int").alias("down"),
        F.ceil(F.col("all") / BLOCK_ROWS).cast("int").alias("across"))
    placed = buckets.join(written(full, "full"), ["slot", "bucket"])
    one_block = "down = 1 AND across = 1"
    zero = F.lit(0)
    small = placed.where(one_block).select(
        "node", "slot", "bucket", "asks", F.lit(True).alias("goes"), (~F.col("asks")).alias("lies"),
        zero.alias("row"), zero.alias("col"))
    large = placed.where(f"NOT ({one_block})")
    row = F.pmod(F.xxhash64("node", "slot"), F.col("down")).cast("int")
    col = F.pmod(F.xxhash64("slot", "node"), F.col("across")).cast("int")
    going = large.select("node", "slot", "bucket", "asks", F.lit(True).alias("goes"), F.lit(False).alias("lies"),
                         F.explode(F.sequence(zero, F.col("down") - 1)).alias("row"), col.alias("col"))
    lying = large.where(~F.col("asks")).select(
        "node", "slot", "bucket", "asks", F.lit(False).alias("goes"), F.lit(True).alias("lies"), row.alias("row"),
        F.explode(F.sequence(zero, F.col("across") - 1)).alias("col"))
    grid = small.unionByName(going).unionByName(lying).select(
        "node", "slot", "asks", "goes", "lies", F.xxhash64("slot", "bucket", "row", "col").alias("block"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = grid.join(classes.select("node", "unit", "copies"), "node").repartition(parts, "block").sortWithinPartitions("block")
    links = blocks.mapInArrow(_block_links(threshold, dim, signs, width, probes), "node long, root long, others long")
    return rows, classes, written(links, "links")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95,
                    **options) -> DataFrame:
    """One row per input row: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other vectors linked directly, copies included; ``component_id`` is the smallest id that links
    reach. A row whose vector links with nothing has no links and is its own component, a row without an id in a
    component gets that component's id, and an empty table gives an empty table. Rows that repeat an id stay rows. Vectors
    link with those of their own length; each length is worked on by itself.
    """
    found = lengths(df, vector_col) or [(1, 0)]
    size = F.coalesce(F.size(_sound(vector_col)), F.lit(-1))
    others = [one for one, _ in found[1:]]
    parts = [df.where(~size.isin(others)) if others else df, *(df.where(size == one) for one in others)]
    told = [_near_duplicates(part, id_col, vector_col, threshold, length=length, **options) for part, length in zip(parts, found)]
    return reduce(DataFrame.unionByName, told)


def _near_duplicates(df: DataFrame, id_col: str, vector_col: str, threshold: float, **options) -> DataFrame:
    rows, classes, links = link_vectors(df, id_col, vector_col, threshold, **options)
    degree = links.groupBy("node").agg(F.sum("others").alias("others"))
    found = components(links.select("node", "root")).join(classes.select("node", "least"), "node")
    roots = found.groupBy("root").agg(F.min("least").alias("component_id"))
    named = found.select("node", "root").join(roots, "root").select("node", "component_id")
    told = classes.join(degree, "node", "left").join(named, "node", "left").select(
        "unit", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "least").alias("component_id"))
    whole = rows.join(written(told, "told"), "unit", "left")
    component = F.coalesce("component_id", "vec_id")
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
