"""Writers. Every one is a distributed write; no rows pass through the driver."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNAL = "carga string, tabela string, linhas bigint, estado string"


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _lines(spark: SparkSession, path: str) -> DataFrame | None:
    """A text folder; None where there is none."""
    try:
        return spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass
class Versions:
    """A Parquet table that is replaced by a switch.

    Each version is a folder ``versao=<n>`` of its own. The pointer ``atual``, written last, names the one to read, so readers see
    the old version whole until the new one stands, and go on reading it if they have begun. A version whose writing broke
    off is never pointed at and is written anew. One writer at a time; old versions stay for the folder's owner to expire.
    """

    path: str

    def current(self, spark: SparkSession) -> int | None:
        """The version in force; each switch added one line of a number to the pointer."""
        told = _lines(spark, f"{self.path}/atual")
        return None if told is None else told.agg(F.max(F.col("value").cast("long"))).first()[0]

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        version = self.current(spark) if version is None else version
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return spark.read.parquet(f"{self.path}/versao={version}")

    def replace(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Store ``df``, which may itself read the table, as the next version and switch to it."""
        spark = df.sparkSession
        version = (self.current(spark) or 0) + 1
        write_parquet(df, f"{self.path}/versao={version}", "overwrite", partition_by)
        spark.createDataFrame([(str(version),)], "value string").coalesce(1).write.mode("append").text(f"{self.path}/atual")
        return version


def replace_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace the table at ``path``, which ``df`` may read by :class:`Versions`, and read it back."""
    table = Versions(path)
    table.replace(df, partition_by)
    return table.read(df.sparkSession)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",", encoding: str = "UTF-8") -> None:
    """Each part file carries its own header line, which the reader takes off again."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def documents(df: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    """Rows as JSON documents, one text column; a missing field is written as null unless ``ignore_nulls``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": str(ignore_nulls).lower()}).alias("document"))


def publish_documents(df: DataFrame, collection: str, replace: bool = True) -> None:
    """Write a collection folder of JSON documents: replace the collection, or add to it."""
    documents(df).write.mode("overwrite" if replace else "append").text(collection)


def publish_mongodb(df: DataFrame, uri: str, database: str, collection: str, replace: bool = True) -> None:
    """The same into MongoDB; needs the Spark connector on the session's class path."""
    (df.write.format("mongodb").mode("overwrite" if replace else "append")
     .options(**{"connection.uri": uri, "database": database, "collection": collection}).save())


@dataclass
class Relational:
    """A database reached over JDBC. ``connections`` caps the parallel writers."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batch: int = 1000
    connections: int = 8

    def append(self, df: DataFrame, table: str, batch: int | None = None) -> None:
        (df.write.format("jdbc").mode("append")
         .options(url=self.url, dbtable=table, batchsize=str(batch or self.batch),
                  numPartitions=str(self.connections), **self.properties).save())


@dataclass
class Folder:
    """Tables as Parquet folders below one root, and a journal of the loads; the target for loads without a database.

    A load owns the folder ``carga=<id>`` of its table and replaces it. It belongs to the table when the journal says ``ok``, so
    what a load that broke off has left is never read, and a repeated load counts once.
    """

    root: str

    def append(self, df: DataFrame, table: str, batch: int | None = None, load: str | None = None) -> int:
        """Add a load, named by itself or at random; the rows it stored."""
        load = load or uuid.uuid4().hex
        place = f"{self.root}/{table}/carga={load}"
        df.write.mode("overwrite").parquet(place)
        rows = df.sparkSession.read.parquet(place).count()
        self.note(df.sparkSession, load, table, rows, "ok")
        return rows

    def note(self, spark: SparkSession, load: str, table: str, rows: int | None, state: str) -> None:
        entry = spark.createDataFrame([(load, table, rows, state)], JOURNAL).withColumn("quando", F.current_timestamp())
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/_jornal")

    def journal(self, spark: SparkSession) -> DataFrame:
        """``carga``, ``tabela``, ``linhas``, ``estado``: the last entry of each load of each table."""
        try:
            entries = spark.read.schema(f"{JOURNAL}, quando timestamp").parquet(f"{self.root}/_jornal")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], JOURNAL)
        last = F.max_by(F.struct("linhas", "estado"), F.struct("quando", F.col("estado") == "ok"))
        return entries.groupBy("carga", "tabela").agg(last.alias("last")).select("carga", "tabela", "last.*")

    def done(self, spark: SparkSession) -> dict[tuple[str, str], int]:
        """Rows of the loads that are stored, by load and table (one entry a load: metadata)."""
        return {(r["carga"], r["tabela"]): r["linhas"] for r in self.journal(spark).where("estado = 'ok'").collect()}

    def table(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of the table's stored loads, whose list is metadata."""
        loads = sorted(load for load, name in self.done(spark) if name == table)
        if not loads:
            raise FileNotFoundError(f"no load of {table} is stored")
        return spark.read.parquet(*(f"{self.root}/{table}/carga={load}" for load in loads))


@dataclass
class Load:
    table: str
    frame: DataFrame
    batch: int = 1000


def load_tables(loads: list[Load], target: Relational | Folder, load: str | None = None) -> dict[str, str]:
    """Append every load to its table; report ``ok`` or the error per table, and go on after an error.

    With a load id and a folder target, tables that a run under the same id has stored are not stored again.
    """
    report = {}
    done = target.done(loads[0].frame.sparkSession) if load and loads and isinstance(target, Folder) else {}
    for one in loads:
        if (load, one.table) in done:  # stored by an earlier run
            report[one.table] = "ok"
            continue
        try:
            if isinstance(target, Folder):
                target.append(one.frame, one.table, one.batch, load)
            else:
                target.append(one.frame, one.table, one.batch)
        except Exception as error:  # one bad table must not stop the others
            report[one.table] = f"{type(error).__name__}: {error}"
            if load and isinstance(target, Folder):
                target.note(one.frame.sparkSession, load, one.table, None, type(error).__name__)
        else:
            report[one.table] = "ok"
    return report
