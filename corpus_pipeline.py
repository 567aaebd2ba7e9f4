"""The corpus pipeline: quality, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` stores every stage as Parquet in the shared folder
and hands the stored table to the next, so a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finmart.llm import decontaminate, jaccard_join, packing, quality
from finmart.llm.base import table
from finmart.llm.queries import QUALITY_THRESHOLD
from finmart.session import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled texts vote for; fitted on the labelled documents of this stage's input."""
    space = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, space, carry=tuple(docs.columns), name="_quality")
    return scored.where(F.col("_quality") >= QUALITY_THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: the one with the smallest id, an id before none; all other rows stay.

    Similar are documents whose five-word shingles have a Jaccard similarity of 0.8 or more. The query op6 has values of
    its own. Rows are told apart by a number of their own, so rows that repeat an id or have none are judged each alone.
    """
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    found = jaccard_join.similar_documents(rows, id_col="_row", words=5, percent=80)
    linked = found.where("n_links > 0").select(F.col("id").alias("_row"), F.col("component_id").alias("_group"))
    linked = written(rows.select("_row", F.col("doc_id").alias("_id")).join(linked, "_row"), "linked")
    first = linked.groupBy("_group").agg(F.min(F.struct(F.isnull("_id").alias("none"), "_id", "_row")).alias("first"))
    extra = linked.join(first.select(F.col("first._row").alias("_row")), "_row", "left_anti").select("_row")
    return rows.join(extra, "_row", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, and the sequences they go to."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", quality_classifier), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark_decontamination), ("best-fit packing", best_fit_packing)]
# a vote of latent-semantic neighbours has no SQL form; tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
