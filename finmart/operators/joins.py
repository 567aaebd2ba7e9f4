"""Joins of a fact table with a lookup table, safe against hot keys and growing lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmart.operators.columns import quoted
from finmart.session import BROADCAST_BYTES, TASK_ROWS, dealt, fits_broadcast, written

# A key is hot when it holds more than this share of the rows, or a fiftieth of it and more rows than a share should
# have; so fewer than 50,000 keys are.
HOT_SHARE = 0.001
# Shares of a hot key: at least SALTS, and so many that none has to hold more rows than this.
SALTS = 64
ROWS_PER_SHARE = 1_000_000


def _match(on: list[str], null_safe: bool) -> Column:
    """Key equality between the frames aliased ``l`` and ``r``."""
    pairs = ((F.col(f"l.`{c}`"), F.col(f"r.`{c}`")) for c in on)
    return reduce(Column.__and__, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs))


def _pick(side: str, names: list[str]) -> list[Column]:
    return [F.col(f"{side}.`{c}`") for c in names]


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE, counts: DataFrame | None = None) -> DataFrame:
    """Keys with ``_n`` rows, more than ``share`` of all rows, or a fiftieth of it and over ``ROWS_PER_SHARE`` rows.

    Fewer than ``50 / share`` of them, whatever the data. ``counts`` has the rows of each key (``_n``; NULL may be left
    out) where they are known.
    """
    total = df.count()
    least = min(share * total, max(share / 50 * total, ROWS_PER_SHARE))
    if counts is None:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    else:
        lacking = reduce(Column.__or__, (quoted(c).isNull() for c in on))
        counts = counts.where(~lacking).unionByName(df.where(lacking).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    return counts.where(F.col("_n") > least)


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", null_safe: bool = False,
           limit: int = BROADCAST_BYTES, salts: int = SALTS, fits: bool | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Join ``facts`` to ``dim`` on equal keys (``how``: inner, left, left_semi, left_anti).

    A ``dim`` measured to fit is broadcast, so the facts do not move. A bigger one is joined by shuffle; the facts
    of hot keys (NULL counts as one) are then spread over ``salts`` shares, more where a key's counted rows need
    them, and only those keys' ``dim`` rows are copied, once to each share of their key. ``fits`` states a size check already made, ``counts`` the rows of
    each key of ``facts`` (``_n``) where they are known. Output: the columns of ``facts``, then the rest of ``dim``.
    """
    keep = list(facts.columns)
    extra = [c for c in dim.columns if c not in on] if how in ("inner", "left") else []
    if fits_broadcast(dim, limit) if fits is None else fits:
        out = facts.alias("l").join(F.broadcast(dim).alias("r"), _match(on, null_safe), how)
        return out.select(*_pick("l", keep), *_pick("r", extra))

    needed = F.greatest(F.lit(salts), F.ceil(F.col("_n") / ROWS_PER_SHARE)).cast("int")
    hot = hot_keys(facts, on, counts=counts).select(*on, needed.alias("_hot"))
    # salt by map partition: spreads a hot key, and a rerun of a lost task gives the same salt
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.spark_partition_id(), F.col("_hot"))).otherwise(F.lit(0))
    shares = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.col("_hot") - 1)).otherwise(F.array(F.lit(0)))
    left = _mark_hot(facts, hot, on).withColumn("_salt", salt).alias("l")
    right = _mark_hot(dim, hot, on).withColumn("_salt", F.explode(shares)).alias("r")
    same = _match(on, null_safe) & (F.col("l._salt") == F.col("r._salt"))
    return left.join(right, same, how).select(*_pick("l", keep), *_pick("r", extra))


def _mark_hot(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """Add ``_hot``, a hot key's shares. The table has fewer than ``50/HOT_SHARE`` rows by construction, so it is broadcast."""
    out = df.alias("l").join(F.broadcast(hot).alias("r"), _match(on, True), "left")
    return out.select(*_pick("l", df.columns), F.col("r._hot"))


def latest(df: DataFrame, key: list[str], by: str, in_task: int = TASK_ROWS) -> DataFrame:
    """One row per key, the one with the greatest ``by`` (a total order within the key).

    An aggregate, not a window: partial results are combined before the shuffle, so a hot key costs nothing. Whole rows
    are aggregated by sorting; above ``in_task`` rows they are dealt out by key and ``by`` first, so that no task sorts
    more than about that many, and the result is stored, because a join measures it before it reads it.
    """
    rows = df.count()
    df = dealt(df, rows, *key, by, most=in_task)
    rest = [c for c in df.columns if c not in key]
    # the row itself breaks ties, so the result does not depend on row order
    best = df.groupBy(*key).agg(F.max(F.struct(quoted(by).alias("_by"), *(quoted(c) for c in rest))).alias("_row"))
    best = best.select(*key, *(F.col("_row")[c].alias(c) for c in rest)).select(*(quoted(c) for c in df.columns))
    return written(best, "latest") if rows > in_task else best


def registry_join(facts: DataFrame, registry: DataFrame, key: str = "CodInst", period: str | None = "AnoMes",
                  how: str = "left", keep_listings: bool = False) -> DataFrame:
    """Attach institution data to facts.

    A registry lists each institution once per period, so joining it as it is (``keep_listings``) repeats the
    facts; by default only the latest listing counts. ``how='left'`` keeps every fact, ``'inner'`` the matched.
    """
    dim = registry
    if period is not None and not keep_listings:
        dim = latest(registry, [key], period).drop(period)
    elif period is not None and period in facts.columns:
        dim = registry.withColumnRenamed(period, period + "_listagem")
    return lookup(facts, dim, [key], how)


def unmatched(facts: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    """Facts whose key the lookup table lacks."""
    return lookup(facts, dim.select(*on).distinct(), on, "left_anti")
