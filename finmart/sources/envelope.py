"""JSON documents of the form ``{"value": [ {...}, ... ]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _document(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField("value", T.ArrayType(record))])


def read_envelopes(spark: SparkSession, path, record: T.StructType, per_line: bool = False) -> DataFrame:
    """One row per record of the documents at ``path``: a document per file, or ``per_line``, which splits files."""
    return (spark.read.schema(_document(record)).option("multiLine", not per_line).json(path)
            .selectExpr("inline(value)"))


def open_envelopes(df: DataFrame, column: str, record: T.StructType) -> DataFrame:
    """One row per record of the documents held in a text column; unreadable documents give no rows here
    but in :func:`unreadable_envelopes`.
    """
    return df.select(F.from_json(column, _document(record)).alias("d")).selectExpr("inline(d.value)")


def unreadable_envelopes(df: DataFrame, column: str, record: T.StructType) -> DataFrame:
    """The rows whose document is no envelope or breaks off, with all their columns; a NULL is no document."""
    declared = T.StructType([*_document(record).fields, T.StructField("_corrupt", T.StringType())])
    read = F.from_json(column, declared, {"columnNameOfCorruptRecord": "_corrupt"})
    broken = read["_corrupt"].isNotNull() | read["value"].isNull()
    return df.where(F.col(f"`{column}`").isNotNull() & broken)


def unreadable_files(spark: SparkSession, path, record: T.StructType, per_line: bool = False) -> DataFrame:
    """(arquivo, texto) of the documents at ``path`` that :func:`read_envelopes` can give no records of."""
    declared = T.StructType([*_document(record).fields, T.StructField("_corrupt", T.StringType())])
    read = (spark.read.schema(declared).option("multiLine", not per_line)
            .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    told = read.select(F.input_file_name().alias("arquivo"), F.col("_corrupt").alias("texto"), "value")
    return told.where("texto IS NOT NULL OR value IS NULL").select("arquivo", "texto")


def envelope(*records) -> Column:
    """Pack a row's records (struct columns) into one document."""
    return F.to_json(F.struct(F.array(*records).alias("value")))
