"""Payment originals: instant payments and cheques from JSON envelopes, transfers from comma CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.functions.dates import iso_date
from finmart.functions.numbers import to_number
from finmart.sources.envelope import read_envelopes
from finmart.sources.files import read_csv

# Everything is read as text: a field of another type must not cost its record.
FIELDS = T.StructType([T.StructField(c, T.StringType()) for c in ("Data", "Quantidade", "Total")])


def payments(raw: DataFrame, kind: str) -> DataFrame:
    """Parsed day, count and amount; what cannot be read is NULL."""
    return raw.select(F.lit(kind).alias("meio"), iso_date("Data").alias("Data"),
                      to_number("Quantidade").alias("Quantidade"), to_number("Total").alias("Total"))


def payments_union(spark: SparkSession, pix: str, cheques: str, transfers: str, per_line: bool = True) -> DataFrame:
    """The three means of payment as one table, from their folders."""
    return (payments(read_envelopes(spark, pix, FIELDS, per_line), "pix")
            .unionByName(payments(read_envelopes(spark, cheques, FIELDS, per_line), "cheque"))
            .unionByName(payments(read_csv(spark, transfers, FIELDS), "ted")))
