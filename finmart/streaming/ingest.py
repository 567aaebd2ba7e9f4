"""Newly landed files to a table, each file once whatever becomes of the checkpoint.

A table is a folder with its rows (``dados``) and a ledger of the files they came from (``registro``), both by the batch
that stored them. A batch leaves out the files of the ledger, stores its rows, and is part of the table only when its ledger
entry stands; the rows of a batch that broke off in between are never read, and its files are taken again.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "lote"
SOURCE = "fonte"
FILE = "arquivo"
LEDGER = f"{FILE} string, linhas bigint, {SOURCE} string, {BATCH} bigint"


def landed_files(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000,
                 pattern: str = "*.json") -> DataFrame:
    """A stream of the JSON Lines records of the files that appear in ``folder``, with the file of each."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .option("pathGlobFilter", pattern).json(folder))
    return stream.withColumn(FILE, F.col("_metadata.file_path"))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """``arquivo``, ``linhas``, ``fonte``, ``lote``: the files the table holds; empty where there is no table yet."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{table}/registro")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def ingest_new(stream: DataFrame, table: str, checkpoint: str) -> int:
    """Append everything that has landed since the last run, then stop; the number of batches that had new files.

    A batch owns the folders ``fonte=<id of the checkpoint>/lote=<id>`` and replaces them, so a batch replayed after a
    crash leaves no copies. A file is known by its path: a new checkpoint, or a second stream over the same folder, stores
    nothing twice, and a file that is written again under its name is not read again. Two streams into one table must not
    run at the same time.
    """
    stored: set[int] = set()

    def source(spark: SparkSession) -> str:
        return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        origin = source(spark)
        place = f"{SOURCE}={origin}/{BATCH}={batch_id}"
        held = ledger(spark, table).where(~((F.col(SOURCE) == origin) & (F.col(BATCH) == batch_id)))
        new = batch.join(held.select(FILE), FILE, "left_anti")
        new.write.mode("overwrite").parquet(f"{table}/dados/{place}")
        rows = spark.read.schema(f"{FILE} string").parquet(f"{table}/dados/{place}")
        # no more rows than files in a batch; one file, so that the entry stands whole or not at all
        files = rows.groupBy(FILE).agg(F.count(F.lit(1)).alias("linhas")).coalesce(1)
        files.write.mode("overwrite").parquet(f"{table}/registro/{place}")
        if rows.limit(1).count():
            stored.add(batch_id)

    query = (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(stored)


def ingested(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """The rows of the batches in the ledger, with ``arquivo``, ``fonte`` and ``lote``."""
    declared = T.StructType([*schema.fields, T.StructField(FILE, T.StringType()), T.StructField(SOURCE, T.StringType()),
                             T.StructField(BATCH, T.LongType())])
    rows = spark.read.schema(declared).parquet(f"{table}/dados")
    return rows.join(ledger(spark, table).select(SOURCE, BATCH).distinct(), [SOURCE, BATCH], "left_semi")


def batches(spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of each batch that stored any, by the ledger."""
    return ledger(spark, table).groupBy(SOURCE, BATCH).agg(F.sum("linhas").alias("linhas"))
