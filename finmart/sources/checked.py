"""Delimited files with an account of what could not be read: lines of another layout, and cells that are no numbers."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.operators.columns import quoted
from finmart.operators.joins import lookup
from finmart.session import written

FIELDS, VALUE = "campos", "valor"
_BROKEN = "_broken"


class Checked(NamedTuple):
    """``rows`` under the declared schema; ``rejects``: ``arquivo``, ``linha`` (from 1), ``texto``, ``motivo``."""

    rows: DataFrame
    rejects: DataFrame


def _lines(spark: SparkSession, path, encoding: str) -> DataFrame:
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))
    if encoding.upper().replace("-", "") != "UTF8":
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), encoding))
    return lines


def _parsed(schema: T.StructType, sep: str, options: dict[str, str]) -> Column:
    fields = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField(_BROKEN, T.StringType())])
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return F.from_csv("value", ddl, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN, **options})


def read_checked_csv(spark: SparkSession, path, schema: T.StructType, sep: str = ",", encoding: str = "UTF-8",
                     header: bool = True, date_format: str | None = None) -> Checked:
    """A CSV of one line a record, parted into what fits the schema and what does not.

    A line with another number of fields is rejected as ``campos``, one with a value of another type as ``valor``. With
    ``header``, lines that repeat the header are no records, wherever they stand, and a file whose first line is another
    one has that line rejected as ``cabecalho``. Blank lines are skipped, line breaks inside quotes are not for this reader.
    Neither output keeps the other waiting: each is one scan, and places of lines are counted for rejects alone.
    """
    options = {"dateFormat": date_format} if date_format else {}
    lines = _lines(spark, path, encoding).where(F.trim("value") != "")
    typed = _parsed(schema, sep, options)
    texts = _parsed(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]), sep, options)
    names = [f.name for f in schema.fields]
    if header:
        head = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), '"', "") == F.lit(sep.join(names))
        records = lines.where(~head)
    else:
        records = lines
    rows = records.select(typed.alias("r")).where(F.col(f"r.{_BROKEN}").isNull()).select(*(F.col(f"r.`{n}`") for n in names))

    broken = records.withColumn("_typed", typed[_BROKEN]).where(F.col("_typed").isNotNull())
    broken = written(broken.select("arquivo", "_block", "_id", F.col("value").alias("texto"), F.when(
        texts[_BROKEN].isNotNull(), FIELDS).otherwise(VALUE).alias("motivo")), "rejects")
    # a split of a file is one task's, and its lines have consecutive ids: lines before a split are counted by split
    splits = _lines(spark, path, encoding).groupBy("arquivo", "_block").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_count"))
    earlier = Window.partitionBy("arquivo").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_count").over(earlier), F.lit(0)))
    placed = lookup(broken, splits.drop("_count"), ["arquivo", "_block"], "inner")
    line = F.col("_before") + F.col("_id") - F.col("_first") + 1
    motive = F.when((line == 1) & F.lit(header), "cabecalho").otherwise(F.col("motivo"))
    return Checked(rows, placed.select("arquivo", line.alias("linha"), "texto", motive.alias("motivo")))


def _lost(conversions: dict[str, Column]) -> list[Column]:
    return [F.count_if((F.trim(quoted(c)) != "") & value.isNull()).alias(c) for c, value in conversions.items()]


def converted(df: DataFrame, conversions: dict[str, Column], told: Observation | None = None) -> DataFrame:
    """Text columns replaced by what their texts say; ``told`` counts, in the same pass, the filled cells that became NULL."""
    seen = df.observe(told, *_lost(conversions)) if told is not None else df
    return seen.withColumns(conversions)


def lost_cells(df: DataFrame, conversions: dict[str, Column]) -> DataFrame:
    """``coluna``, ``perdidas``: the filled cells of each text column that its conversion makes NULL, in one aggregate."""
    counts = df.agg(*_lost(conversions))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("coluna"), quoted(c).alias("perdidas")) for c in conversions)))
                         .alias("r")).select("r.*")
