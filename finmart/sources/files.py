"""File scans with declared schemas: one scan per folder, never one per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.sources.layouts import positions, strings


def read_parquet(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path, schema: T.StructType, sep: str = ",", encoding: str = "UTF-8",
             date_format: str | None = None, check_header: bool = True) -> DataFrame:
    """CSV with a header line; date columns are parsed while scanning when the schema says so.

    The header must name the schema's columns in order, so a file with another layout fails instead of shifting its
    values; ``check_header=False`` takes the columns by place.
    """
    reader = spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding)
    reader = reader.option("enforceSchema", not check_header)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    return reader.csv(path)


def read_text_csv(spark: SparkSession, path, sep: str = ",", encoding: str = "UTF-8", header_of: str | None = None) -> DataFrame:
    """CSV whose header is not known before: every column as text, under the names of the file's header.

    The header is that of one file of the folder (of ``header_of`` if given); a file with another one fails.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    names = reader.csv(header_of or path).columns
    return read_csv(spark, path, strings(*names), sep, encoding)


def read_positional_csv(spark: SparkSession, path, width: int, sep: str = ";") -> DataFrame:
    """Headerless CSV: text columns ``_0`` .. ``_{width-1}``."""
    return spark.read.schema(positions(width)).option("sep", sep).csv(path)


def parse_positional(df: DataFrame, column: str, width: int, sep: str = ";") -> DataFrame:
    """Like :func:`read_positional_csv`, for lines that are already in a column."""
    ddl = ", ".join(f"_{i} string" for i in range(width))
    return df.select(F.from_csv(column, ddl, {"sep": sep}).alias("r")).select("r.*")


def read_json_lines(spark: SparkSession, folder, schema: T.StructType, pattern: str = "*.json",
                    with_file: bool = False, unreadable: str | None = None) -> DataFrame:
    """Every JSON Lines file of a folder, as one scan.

    A line that cannot be read gives a row of NULLs; ``unreadable`` names a column that then holds its text.
    """
    reader = spark.read.option("pathGlobFilter", pattern)
    if unreadable:
        schema = T.StructType([*schema.fields, T.StructField(unreadable, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", unreadable)
    df = reader.schema(schema).json(folder)
    return df.withColumn("file", F.col("_metadata.file_path")) if with_file else df


def read_partitioned_csv(spark: SparkSession, root: str, schema: T.StructType, sep: str = ";", year: str = "ano") -> DataFrame:
    """CSV folders ``<year>=<value>`` below one root as one table with the year: one scan, years are pruned by folder."""
    return read_csv(spark, root, T.StructType([*schema.fields, T.StructField(year, T.IntegerType())]), sep)


def read_year_folders(spark: SparkSession, folders: dict[int, str], schema: T.StructType, sep: str = ";",
                      year: str = "ano") -> DataFrame:
    """CSV folders, one per year, as one table with a year column: a scan per folder."""
    out = None
    for value, folder in folders.items():
        part = read_csv(spark, folder, schema, sep).withColumn(year, F.lit(value))
        out = part if out is None else out.unionByName(part)
    return out
