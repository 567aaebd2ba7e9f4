"""Global order at scale: row index, ranks and exact quantiles without a one-partition window.

Shared idea: range-partition by the order columns, store the result as a table that remembers each row's partition
and position, sum the sizes of the partitions (one row each) into offsets, and add the offsets back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.operators.columns import quoted
from finmart.operators.joins import lookup
from finmart.session import IN_TASK_ROWS, dealt, written

# The values of a group of up to this many rows may be collected in a task.
SMALL_GROUP = 100_000

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row's place in its partition in the low 33 bits


def _placed(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Range-partitioned, sorted and stored, with ``_part`` and ``_pos`` (place inside the partition)."""
    # no partition count: adaptive execution joins neighbouring small ranges, which keeps the order
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row_id = F.monotonically_increasing_id()
    return written(placed.withColumns({
        "_part": F.shiftright(row_id, _POSITION_BITS).cast("int"),
        "_pos": row_id.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
    }), label)


def row_index(df: DataFrame, order: list[Column], name: str = "indice") -> DataFrame:
    """Number the rows 0..n-1 in the given order, which must be total."""
    placed = _placed(df, order, "row-index")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per range partition: the window and the broadcast are bounded by the partition count
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos")).alias(name), *(quoted(c) for c in df.columns))


def row_at(df: DataFrame, order: list[Column], position: int, direct: int = 10_000) -> DataFrame:
    """The row at a 0-based position of the given total order."""
    if position > direct:
        return row_index(df, order, "_at").where(F.col("_at") == position).drop("_at")
    head = df.orderBy(*order).limit(position + 1)
    # at most direct + 1 rows are left here
    numbered = head.withColumn("_at", F.row_number().over(Window.orderBy(*order)) - 1)
    return numbered.where(F.col("_at") == position).drop("_at")


def tail(df: DataFrame, order: list[tuple[str, bool]], n: int = 5) -> DataFrame:
    """The last ``n`` rows of an order given as (column, ascending), in that order."""
    last = df.orderBy(*(F.desc_nulls_last(c) if asc else F.asc_nulls_first(c) for c, asc in order)).limit(n)
    return last.orderBy(*(F.asc_nulls_first(c) if asc else F.desc_nulls_last(c) for c, asc in order))


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _cells(placed: DataFrame, groups: list[str]) -> DataFrame:
    """Weight before each (group, partition) cell, and the group's total; at most one cell per partition each."""
    cells = placed.groupBy(*groups, "_part").agg(F.sum("_n").alias("_cell"))
    group = Window.partitionBy(*groups)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(*groups, "_part", "_cell",
                        F.coalesce(F.sum("_cell").over(earlier), F.lit(0)).alias("_before"),
                        F.sum("_cell").over(group).alias("_total"))


def _counted(df: DataFrame, groups: list[str], value: str, weight: str | None = None) -> DataFrame:
    """How often each value occurs per group: equal values meet before they are ordered, so none is hot."""
    present = df.where(quoted(value).isNotNull())
    for g in groups:
        present = present.where(quoted(g).isNotNull())
    if weight:
        return present.where(quoted(weight) > 0).select(*groups, value, quoted(weight).alias("_n"))
    return present.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))


def average_rank(df: DataFrame, value: str, groups: list[str] | None = None, name: str = "posto",
                 weight: str | None = None) -> DataFrame:
    """Distinct values with their average rank (1-based, ties share the mean) and count, per group.

    Columns: the groups, the value, ``n``, the rank. NULL values and NULL groups have no rank.
    ``weight`` names a column that says how often a value
    occurs; each value then stands once per group.
    """
    keys = groups or ["_all"]
    if not groups:
        df = df.select(quoted(value), F.lit(0).alias("_all"), *([quoted(weight)] if weight else []))
    placed = _placed(_counted(df, keys, value, weight), [*(F.col(g) for g in keys), F.col(value)], "ranks")
    running = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    within = placed.withColumn("_upto", F.sum("_n").over(running))
    cells = _cells(placed, keys).select(*keys, "_part", "_before")
    rank = F.col("_before") + F.col("_upto") - F.col("_n") + (F.col("_n") + 1) / 2
    return within.join(cells, [*keys, "_part"]).select(
        *(groups or []), value, F.col("_n").alias("n"), rank.cast("double").alias(name))


def average_ranks(df: DataFrame, value: str, groups: list[str], weights: dict[str, str]) -> DataFrame:
    """One row per group and value, in which it stands once, with an average rank by each weight column (``weights``: column -> rank).

    All rankings of a value travel in one row and are summed in one order. A weight of 0 leaves the value out of that
    ranking; its rank there says nothing.
    """
    present = df.where(quoted(value).isNotNull()).select(*groups, value, *weights)
    placed = _placed(present, [*(F.col(g) for g in groups), F.col(value)], "ranks")
    running = Window.partitionBy(*groups, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cells = placed.groupBy(*groups, "_part").agg(*(F.sum(w).alias(w) for w in weights))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = cells.select(*groups, "_part", *(F.coalesce(F.sum(w).over(earlier), F.lit(0)).alias(f"_before{w}") for w in weights))
    within = placed.withColumns({f"_upto{w}": F.sum(w).over(running) for w in weights})
    # one row per group and range partition
    joined = within.join(F.broadcast(before), [*groups, "_part"])
    return joined.select(*groups, value, *(
        (F.col(f"_before{w}") + F.col(f"_upto{w}") - F.col(w) + (F.col(w) + 1) / 2).cast("double").alias(name)
        for w, name in weights.items()))


def quantiles(df: DataFrame, value: str, probs: list[float], groups: list[str] | None = None,
              names: list[str] | None = None, in_task: int = IN_TASK_ROWS, accuracy: int = 10_000,
              small_group: int = SMALL_GROUP) -> DataFrame:
    """Exact quantiles with linear interpolation, per group (NULL groups dropped) or overall.

    Up to ``in_task`` rows, and for groups of up to ``small_group`` rows however many there are, the built-in
    ``percentile`` does it, whose memory grows with the values of a group. For larger groups, sketches of ``accuracy``
    first bracket each quantile and a second pass counts the values below each bracket and keeps only those inside, some
    ``4 / accuracy`` of the rows, to be ordered. Should a bracket miss its quantile, all their values are ordered instead.
    """
    keys = groups or []
    names = names or [f"q{round(p * 100)}" for p in probs]
    keyed = keys or ["_all"]
    present = df if keys else df.withColumn("_all", F.lit(0))
    present = present.select(*(quoted(k) for k in keyed), quoted(value).alias("_v"))
    for column in [*keyed, "_v"]:
        present = present.where(quoted(column).isNotNull())
    ready = for_percentile(present, keyed, in_task, small_group)
    if ready is not None:
        return _percentiles(ready, probs, keyed, names).select(*keys, *names)
    # fewer than one key per ``small_group`` rows
    large = F.broadcast(written(_sizes(present, keyed).where(F.col("_n") > small_group).select(*keyed), "large-groups"))
    rest = present.join(large, keyed, "left_anti")
    small = _percentiles(dealt(rest, rest.count(), *keyed), probs, keyed, names)
    present = present.join(large, keyed, "left_semi")
    found = _bracketed(present, probs, keyed, names, accuracy)
    if found is None:
        found = _all_ordered(present, probs, keyed, names)
    return found.select(*keys, *names).unionByName(small.select(*keys, *names))


def _sizes(present: DataFrame, keyed: list[str]) -> DataFrame:
    return present.groupBy(*keyed).agg(F.count(F.lit(1)).alias("_n"))


def for_percentile(present: DataFrame, keyed: list[str], in_task: int = IN_TASK_ROWS,
                   small_group: int = SMALL_GROUP) -> DataFrame | None:
    """The rows, dealt out so that tasks may collect the values of each group; None if some group is too large for that."""
    rows = present.count()
    if rows <= in_task:
        return present
    most = _sizes(present, keyed).agg(F.max("_n")).first()[0]
    return None if most is not None and most > small_group else dealt(present, rows, *keyed)


def _percentiles(present: DataFrame, probs: list[float], keyed: list[str], names: list[str]) -> DataFrame:
    packed = present.groupBy(*keyed).agg(F.percentile("_v", probs).alias("_q"))
    return packed.select(*keyed, *(F.col("_q")[i].alias(n) for i, n in enumerate(names)))


def _all_ordered(present: DataFrame, probs: list[float], keyed: list[str], names: list[str]) -> DataFrame:
    placed = _placed(_counted(present, keyed, "_v"), [*(F.col(k) for k in keyed), F.col("_v")], "quantiles")
    wanted = F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("_total") - 1)).alias("at"))
                       for i, p in enumerate(probs)))
    points = _order_statistics(placed, _cells(placed, keyed).withColumn("_wanted", wanted), keyed)
    return _side_by_side(points, keyed, names)


def _bracketed(present: DataFrame, probs: list[float], keyed: list[str], names: list[str],
               accuracy: int) -> DataFrame | None:
    """Quantiles from the values near them, or None if some bracket missed."""
    margin = 2 / accuracy  # a sketch is off by at most 1 / accuracy of the rows
    ends = [e for p in probs for e in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = F.percentile_approx("_v", ends, accuracy)
    stats = present.groupBy(*keyed).agg(F.count(F.lit(1)).alias("_total"), F.min("_v").alias("_min"),
                                        F.max("_v").alias("_max"), sketch.alias("_ends"))
    lows = [F.when(F.lit(p <= margin), F.col("_min")).otherwise(F.col("_ends")[2 * i]).alias(f"_lo{i}")
            for i, p in enumerate(probs)]
    highs = [F.when(F.lit(p >= 1 - margin), F.col("_max")).otherwise(F.col("_ends")[2 * i + 1]).alias(f"_hi{i}")
             for i, p in enumerate(probs)]
    brackets = written(stats.select(*keyed, "_total", *lows, *highs), "brackets")

    every = range(len(probs))
    v = F.col("_v")
    inside = [v.between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in every]
    kept = F.when(reduce(Column.__or__, inside), v).alias("_kept")
    rows = lookup(present, brackets, keyed, "inner")
    bands = written(rows.groupBy(*keyed, kept).agg(
        F.count(F.lit(1)).alias("_n"), *(F.count_if(v < F.col(f"_lo{i}")).alias(f"_below{i}") for i in every),
        *(F.max(inside[i]).alias(f"_in{i}") for i in every)), "bands")

    # positions counted from the start of each bracket
    below = bands.groupBy(*keyed).agg(*(F.sum(f"_below{i}").alias(f"_below{i}") for i in every))
    positions = F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(p) * (F.col("_total") - 1)).alias("at"),
                                   F.col(f"_below{i}").alias("below")) for i, p in enumerate(probs)))
    # both sides hold one row per group
    targets = brackets.join(below, keyed).withColumn("_w", F.explode(positions)).select(
        *keyed, F.col("_w.i").alias("_band"), F.array(F.struct("_w.i", (F.col("_w.at") - F.col("_w.below")).alias("at"))).alias("_wanted"))
    members = F.array_compact(F.array(*(F.when(F.col(f"_in{i}"), F.lit(i)) for i in every)))
    near = bands.where("_kept IS NOT NULL").select(*keyed, F.explode(members).alias("_band"), F.col("_kept").alias("_v"), "_n")
    group = [*keyed, "_band"]
    placed = _placed(near, [*(F.col(k) for k in group), F.col("_v")], "near")
    points = _order_statistics(placed, _cells(placed, group).join(targets, group), group)
    found = written(_side_by_side(points, keyed, names), "quantiles")
    complete = found.where(reduce(Column.__and__, (F.col(n).isNotNull() for n in names))).count()
    return found if complete == brackets.count() else None


def _order_statistics(placed: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """(group, i, q) for the positions ``_wanted`` (i, at) of each group, given its cells."""
    ends = F.transform("_wanted", lambda w: F.struct(w["i"].alias("i"), w["at"].alias("at"),
                                                     F.floor(w["at"]).alias("lo"), F.ceil(w["at"]).alias("hi")))

    def inside(pos):
        return (pos >= F.col("_before")) & (pos < F.col("_before") + F.col("_cell"))

    hit = cells.withColumn("_ends", F.filter(ends, lambda w: inside(w["lo"]) | inside(w["hi"]))).where(F.size("_ends") > 0)
    # at most two cells per group and quantile go on
    chosen = placed.join(hit.select(*group, "_part", "_before", "_ends"), [*group, "_part"])
    running = Window.partitionBy(*group, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    spans = chosen.withColumn("_end", F.col("_before") + F.sum("_n").over(running)).withColumn(
        "_start", F.col("_end") - F.col("_n"))
    near = spans.withColumn("_w", F.explode("_ends")).select(*group, "_v", "_start", "_end", "_w.*")
    at_lo = (F.col("lo") >= F.col("_start")) & (F.col("lo") < F.col("_end"))
    at_hi = (F.col("hi") >= F.col("_start")) & (F.col("hi") < F.col("_end"))
    pairs = near.where(at_lo | at_hi).groupBy(*group, "i").agg(
        F.max(F.when(at_lo, F.col("_v"))).alias("_lo"), F.max(F.when(at_hi, F.col("_v"))).alias("_hi"),
        F.max(F.col("at") - F.col("lo")).alias("_share"))
    between = (1 - F.col("_share")) * F.col("_lo") + F.col("_share") * F.col("_hi")
    return pairs.select(*group, "i", F.when(F.col("_share") == 0, F.col("_lo")).otherwise(between).alias("q"))


def _side_by_side(points: DataFrame, keyed: list[str], names: list[str]) -> DataFrame:
    return points.groupBy(*keyed).agg(*(F.max(F.when(F.col("i") == i, F.col("q"))).alias(n) for i, n in enumerate(names)))
