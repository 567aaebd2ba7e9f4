"""Publishing: originals to tables, results to document collections, JSON documents to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from finmart.functions.dates import to_midnight
from finmart.functions.names import first_line, rename_by, underscored
from finmart.operators.columns import columns_of_type, quoted, rename_at
from finmart.plans.fixed_values import LOAD_LIST
from finmart.sources.envelope import read_envelopes
from finmart.sources.sinks import Folder, Load, Relational, load_tables, publish_documents


def income_original(joined: DataFrame) -> DataFrame:
    """Short names for the relational load; the two exchange results share a first line, so they go by place."""
    df = rename_by(joined, first_line, underscored)
    return rename_at(df, {-5: "Receitas_de_Operações_de_Câmbio", -4: "Despesas_de_Operações_de_Câmbio"})


def summary_original(joined: DataFrame) -> DataFrame:
    long = "Passivo_Circulante_e_Exigível_a_Longo_Prazo_e_Resultados_de_Exercícios_Futuros"
    return rename_by(joined, first_line, underscored).withColumnRenamed(
        long, "Passivo_Circ_Longo_Prazo_e_Result_Exer_Futuros")


def load_originals(frames: dict[str, DataFrame], target: Relational | Folder, batch: int = 1000,
                   load: str | None = None) -> dict[str, str]:
    """Append each frame to its table; the outcome per table."""
    return load_tables([Load(table, df, batch) for table, df in frames.items()], target, load)


def load_list(frames: dict[str, DataFrame], target: Relational | Folder, load: str) -> dict[str, str]:
    """The published load list: each of its frames to its table, in order, once per load id.

    ``frames`` has a frame for each original of ``LOAD_LIST``; an original without a frame, or a frame that is no original,
    stops the load before anything is stored. Tables that take several originals get them one after the other.
    """
    missing = [name for name, *_ in LOAD_LIST if name not in frames]
    unknown = sorted(set(frames) - {name for name, *_ in LOAD_LIST})
    if missing or unknown:
        raise ValueError(f"originals without a frame: {missing}; frames that are no original: {unknown}")
    spark = next(iter(frames.values())).sparkSession
    done = target.done(spark) if isinstance(target, Folder) else {}
    report = {}
    for name, table, batch in LOAD_LIST:
        one = f"{load}-{name}"
        told = {table: "ok"} if (one, table) in done else load_tables([Load(table, frames[name], batch)], target, one)
        report[name] = told[table]
    return report


def documents_ready(df: DataFrame) -> DataFrame:
    """Dates become timestamps at midnight, which document stores can hold."""
    return df.withColumns({c: to_midnight(quoted(c)) for c in columns_of_type(df, "date")})


def publish_collections(frames: dict[str, DataFrame], folder: str, append: frozenset[str] = frozenset()) -> None:
    """Write each frame as a collection; those in ``append`` are added to instead of replaced."""
    for name, df in frames.items():
        publish_documents(documents_ready(df), f"{folder}/{name}", replace=name not in append)


def ingest_documents(spark: SparkSession, path: str, record: T.StructType, table: str, target: Relational | Folder,
                     batch: int = 1000, per_line: bool = False) -> dict[str, str]:
    """Every record of the JSON documents at ``path``, once, to the end of a table."""
    return load_tables([Load(table, read_envelopes(spark, path, record, per_line), batch)], target)
