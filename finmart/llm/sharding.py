"""Shards of near equal bytes by sampled splitters, in DataFrame operations only.

A size-weighted sample of the keys gives quantile boundaries. They cut the key space into many small ranges, ranges
that turn out too full are cut again from a sample of their own, and the exact bytes of the ranges, added up in key
order, say where each shard begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finmart.session import written

# Coarse slots of the 32-bit key in which boundaries are looked up.
_SLOT_BITS = 12
_KEY = "struct<k:bigint,id:bigint,r:bigint>"


def _key() -> Column:
    return F.struct(F.col("text_crc32").alias("k"), F.col("id").alias("id"), F.col("tie").alias("r"))


def _drawn(rows: DataFrame, count: int, seed: int) -> list:
    """``count`` keys drawn without replacement with odds in proportion to size, sorted.

    Each row gets an exponential variable of rate ``size``; the smallest ``count`` are the sample.
    """
    coin = (F.pmod(F.xxhash64(F.lit(seed), "text_crc32", "id", "tie"), F.lit(1 << 40)) + F.lit(0.5)) / float(1 << 40)
    late = -F.log(coin) / F.col("size")
    sample = rows.select(_key().alias("key"), late.alias("late")).orderBy("late", "key").limit(count)
    return [r["key"] for r in sample.orderBy("key").collect()]


def _ranged(rows: DataFrame, bounds: list) -> DataFrame:
    """Rows with ``range``: the number of boundaries at or below the row's key.

    Boundaries lie in the coarse slot of their key; a row compares itself with those of its own slot only. The table
    broadcast has one row per slot and the boundaries, whose number is a parameter.
    """
    spark = rows.sparkSession
    slots: dict[int, list] = {s: [] for s in range(1 << _SLOT_BITS)}
    for b in bounds:
        slots[b[0] >> (32 - _SLOT_BITS)].append(tuple(b))
    table, before = [], 0
    for slot, own in slots.items():
        table.append((slot, before, own))
        before += len(own)
    lookup = spark.createDataFrame(table, f"slot int, before int, own array<{_KEY}>")
    with_slot = rows.withColumn("slot", F.shiftright("text_crc32", 32 - _SLOT_BITS).cast("int"))
    here = F.size(F.filter("own", lambda b: b <= _key()))
    return with_slot.join(F.broadcast(lookup), "slot").withColumn(
        "range", F.when(F.size("own") == 0, F.col("before")).otherwise(F.col("before") + here)).drop("slot", "before", "own")


def sized(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``id``, ``size`` (UTF-8 bytes of the text, none for NULL, plus 8), ``text_crc32`` and ``tie``.

    ``tie`` numbers the rows of the stored table, or is their ``row_col``, and tells rows apart that repeat an id or have none.
    """
    raw = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    slim = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                     (F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()).alias("tie"))
    return written(slim, "sized")


def shard_by_bytes(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                   ranges_per_shard: int = 64, rows_per_range: int = 200_000, oversample: int = 4, seed: int = 11,
                   max_rounds: int = 8, row_col: str | None = None) -> DataFrame:
    """``id``, ``size``, ``text_crc32``, ``shard``, ``slot`` (gapless from 0 in each shard); with ``row_col``, a column of
    numbers of its own for each row, also that number as ``row``.

    Keys are (crc32 of the text, id), so equal texts lie side by side and share a shard unless a border falls among
    them: a hot text is a range too full, and is cut by id. Shard sizes differ from the mean by one row at most. NULL
    and empty texts count 8 bytes, rows without an id come first among equal texts, repeated ids stay rows, and an
    empty table gives an empty table. The number of ranges follows the number of rows, so a range stays small enough
    for one task at every size; only the sample (``oversample`` keys per range) and one row per range are gathered.
    """
    rows = sized(df, id_col, text_col, row_col)
    own = [F.col("tie").alias("row")] if row_col else []
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).first()
    n, total = sums["n"], sums["bytes"] or 0
    if not n:
        return rows.select("id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), *own)
    ranges = shards * max(ranges_per_shard, -(-n // (shards * rows_per_range)))
    sample = _drawn(rows, oversample * ranges, seed)
    bounds = sorted(set(map(tuple, (sample[i] for i in range(oversample, len(sample), oversample)))), key=_order)
    even = total / ranges
    for again in range(max_rounds):
        ranged = written(_ranged(rows, bounds), "ranged")
        per_range = written(ranged.groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "ranges")
        # a range is too full at four even shares, unless it is one row
        full = per_range.where((F.col("rows") > 1) & ((F.col("bytes") > 4 * even) | (F.col("rows") > 4 * rows_per_range)))
        wanted = full.agg(F.sum(F.ceil(F.col("bytes") / even) + F.ceil(F.col("rows") / rows_per_range)).alias("k")).first()["k"]
        if not wanted:
            break
        more = _drawn(ranged.join(full.select("range"), "range", "left_semi"), int(wanted), seed + 1 + again)
        bounds = sorted({*bounds, *map(tuple, more)}, key=_order)
    # one row per range: bounded by the number of boundaries
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = per_range.select("range", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("range").orderBy("text_crc32", F.col("id").asc_nulls_first(), "tie").rowsBetween(
        Window.unboundedPreceding, -1)
    offset = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    # a row belongs to the shard in which its middle byte lies
    shard = F.floor((offset + F.col("size") / 2) * shards / F.lit(float(total))).cast("int")
    placed = ranged.join(F.broadcast(before), "range").select(
        "range", "id", "size", "text_crc32", "tie", F.least(shard, F.lit(shards - 1)).alias("shard"))
    stored = written(placed, "placed")
    # a range touches few shards: slots are numbered inside (shard, range) and shifted by what lies before
    cells = stored.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("cell"))
    ahead = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("shard", "range", F.coalesce(F.sum("cell").over(ahead), F.lit(0)).alias("first"))
    number = F.row_number().over(Window.partitionBy("range", "shard").orderBy(
        "text_crc32", F.col("id").asc_nulls_first(), "tie"))
    return stored.join(F.broadcast(starts), ["shard", "range"]).select(
        "id", "size", "text_crc32", "shard", (F.col("first") + number - 1).cast("long").alias("slot"), *own)


def _order(key: tuple) -> tuple:
    return key[0], key[1] is not None, key[1] or 0, key[2]


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> None:
    """Store the whole records of :func:`shard_by_bytes` under ``shard=<n>`` folders, in the order of their slots.

    Every row is stored once, rows without an id or with a repeated one included: records find their shard by a number of
    their own. A column of the records named like the folder's column or the slot is stored with underscores behind it.
    """
    numbered = written(df.select(F.struct("*").alias("record"), F.monotonically_increasing_id().alias("row"),
                                 F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "records")
    placed = shard_by_bytes(numbered, id_col="id", text_col="text", row_col="row", **options).select("row", "shard", "slot")
    names: list[str] = []
    for name in df.columns:
        while name.lower() in {"shard", "slot", *(n.lower() for n in names)}:
            name += "_"
        names.append(name)
    fields = [F.col("record").getField(c).alias(n) for c, n in zip(df.columns, names)]
    whole = numbered.select("record", "row").join(placed, "row").select(*fields, "shard", "slot")
    whole.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
