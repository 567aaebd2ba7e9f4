"""Where intermediate tables live, and how a size is proven before it is relied on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side of a join is broadcast only when it was measured to be at most this big.
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows that one task should sort or group at most, where their number is known.
TASK_ROWS = 2_000_000
# A per-group exact percentile keeps its values in one task; allowed up to this many rows in all.
IN_TASK_ROWS = 4_000_000

# Whether Spark removes a query's shuffle files when the query has ended.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_BASE: dict[str, str] = {}


def shared_base(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) may run without that setting; it gets one scratch folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if master not in _LOCAL_BASE:
        _LOCAL_BASE[master] = "file://" + tempfile.mkdtemp(prefix="finmart-")
    return _LOCAL_BASE[master]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before (not created)."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage, and freezes partition ids and row positions, in a way that outlives executors. What was shuffled
    for it is removed at once; else it stays on the executors' disks until the driver happens to collect its garbage.
    """
    path, conf = new_folder(df.sparkSession, label), df.sparkSession.conf
    before = conf.get(_DROP_SHUFFLES)
    conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``: one aggregate job over it."""
    width = F.lit(16)
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + 16 + F.coalesce(F.octet_length(name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + 16 + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
        else:
            width = width + 16
    size = df.agg(F.sum(width.cast("long")).alias("size")).first()["size"]
    return int(size or 0)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def fits_task(df: DataFrame, limit: int = IN_TASK_ROWS) -> bool:
    return df.count() <= limit


def dealt(df: DataFrame, rows: int, *by: str, most: int | None = None) -> DataFrame:
    """Hand ``rows`` rows to as many tasks as they need, by the hash of columns, so that a task has about ``most`` at most.

    What a task sorts then does not grow with the table, however few files or row groups hold it. A table that fits one
    task stays as it is.
    """
    tasks = -(-rows // (most or TASK_ROWS))
    return df if tasks <= 1 else df.repartition(tasks, *by)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Hand the rows of a table that is read in fewer tasks than there are cores to all cores, by the hash of columns.

    For heavy per-row work on a small or badly split input; a table with enough splits is left as it is. ``by`` should
    be nearly unique. Only the columns used later, and ``by``, are read and moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *by)
