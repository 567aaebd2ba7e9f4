import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart import session
from finmart.plans.publish import ingest_documents, publish_collections
from finmart.session import new_folder
from finmart.sources import sinks
from finmart.streaming.ingest import batches, ingest_new, ingested, landed_files, ledger


@pytest.fixture
def df(spark):
    return spark.range(20).select(F.col("id").alias("k"), (F.col("id") / 2).alias("v"), F.lit(None).cast("string").alias("n"))


def test_parquet_refuses_to_overwrite(spark, df):
    path = new_folder(spark, "t")
    sinks.write_parquet(df, path)
    with pytest.raises(AnalysisException):
        sinks.write_parquet(df, path)


def test_replace_self(spark, df):
    path = new_folder(spark, "t")
    assert sinks.replace_parquet(df, path).count() == 20
    table = sinks.Versions(path)
    assert sinks.replace_parquet(table.read(spark).where("k >= 5"), path).count() == 15
    assert table.current(spark) == 2 and table.read(spark, 1).count() == 20


def test_broken_replacement_leaves_the_table(spark, df):
    table = sinks.Versions(new_folder(spark, "t"))
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    table.replace(df)
    begun = table.read(spark)
    for _ in range(2):
        with pytest.raises(Exception, match="broken"):
            table.replace(table.read(spark).withColumn("v", F.when(F.col("k") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("v"))))
        assert table.current(spark) == 1 and table.read(spark).count() == 20
    table.replace(table.read(spark).where("k < 3"), partition_by=["k"])  # takes the place the broken one left
    assert table.read(spark).count() == 3 and begun.count() == 20


def test_append_twice(spark, df):
    path = new_folder(spark, "t")
    for _ in range(2):
        sinks.write_csv(df, path, "append")
    assert spark.read.schema(df.schema).option("header", True).csv(path).count() == 40


def test_documents(spark, df):
    docs = [json.loads(r["document"]) for r in sinks.documents(df).collect()]
    assert docs[1] == {"k": 1, "v": 0.5, "n": None}
    root = new_folder(spark, "c")
    dated = df.select("k", F.lit("2020-01-31").cast("date").alias("d"))
    for _ in range(2):
        publish_collections({"a": dated, "b": dated}, root, append=frozenset({"b"}))
    assert spark.read.text(f"{root}/a").count() == 20 and spark.read.text(f"{root}/b").count() == 40
    assert "2020-01-31T00:00:00" in spark.read.text(f"{root}/a").first()[0]


class Recorder:
    """Stands in for a frame's writer: no database may be started here, so the call is what is checked."""

    def __init__(self):
        self.calls = {}

    @property
    def write(self):
        return self

    def format(self, kind):
        self.calls["format"] = kind
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def save(self):
        self.calls["saved"] = True


def test_relational_append():
    frame = Recorder()
    sinks.Relational("jdbc:x", {"user": "u"}, connections=3).append(frame, "pix", 500)
    assert frame.calls == {"format": "jdbc", "mode": "append", "url": "jdbc:x", "dbtable": "pix", "batchsize": "500",
                           "numPartitions": "3", "user": "u", "saved": True}


def test_manifest_goes_on_after_an_error(spark, df):
    target = sinks.Folder(new_folder(spark, "db"))
    bad = df.withColumn("x", F.expr("cast('a' as int)"))
    report = sinks.load_tables([sinks.Load("a", df), sinks.Load("b", bad), sinks.Load("c", df)], target)
    assert report["a"] == report["c"] == "ok" and report["b"] != "ok"
    assert target.table(spark, "c").count() == 20


def test_repeated_load_counts_once(spark, df):
    target = sinks.Folder(new_folder(spark, "db"))
    bad = df.withColumn("x", F.raise_error(F.lit("broken")).cast("string"))
    first = sinks.load_tables([sinks.Load("a", df), sinks.Load("b", bad)], target, "1")
    assert first["a"] == "ok" and first["b"] != "ok"
    with pytest.raises(FileNotFoundError):
        target.table(spark, "b")
    assert {tuple(r) for r in target.journal(spark).collect()} == {("1", "a", 20, "ok"), ("1", "b", None, first["b"].split(":")[0])}
    again = sinks.load_tables([sinks.Load("a", df), sinks.Load("b", df)], target, "1")
    assert again == {"a": "ok", "b": "ok"} and target.done(spark) == {("1", "a"): 20, ("1", "b"): 20}
    sinks.load_tables([sinks.Load("a", df)], target, "2")
    assert target.table(spark, "a").count() == 40 and target.table(spark, "b").count() == 20


def test_rows_without_a_journal_entry_are_not_read(spark, df):
    """A load that broke off after its rows were stored."""
    target = sinks.Folder(new_folder(spark, "db"))
    target.append(df, "a", load="1")
    df.write.parquet(f"{target.root}/a/carga=2")
    assert target.table(spark, "a").count() == 20
    target.append(df, "a", load="2")
    assert target.table(spark, "a").count() == 40


def test_load_list_wants_every_original(spark, df):
    from finmart.plans.fixed_values import LOAD_LIST
    from finmart.plans.publish import load_list
    assert len(LOAD_LIST) == 28 and len({table for _, table, _ in LOAD_LIST}) == 28
    with pytest.raises(ValueError, match="pix"):
        load_list({name: df for name, *_ in LOAD_LIST if name != "pix"}, sinks.Folder("none"), "1")
    with pytest.raises(ValueError, match="outro"):
        load_list({**{name: df for name, *_ in LOAD_LIST}, "outro": df}, sinks.Folder("none"), "1")


def test_each_record_is_loaded_once(spark, folder):
    (open(f"{folder}/d.json", "w")).write(json.dumps({"value": [{"k": "1"}, {"k": "2"}]}))
    target = sinks.Folder(new_folder(spark, "db"))
    record = T.StructType([T.StructField("k", T.StringType())])
    assert ingest_documents(spark, f"file://{folder}", record, "pix", target) == {"pix": "ok"}
    assert target.table(spark, "pix").count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class FakeSession:
    def __init__(self, **conf):
        self.settings = conf
        self.conf = self

    def get(self, name, default=None):
        return self.settings.get(name.replace(".", "_"), default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_base(FakeSession(spark_master="yarn"))
    assert session.shared_base(FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs://x/")) == "hdfs://x"


SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def land(folder, name, keys):
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps({"k": k}) + "\n" for k in keys)


def test_stream_takes_each_file_once(spark, folder):
    table, progress = new_folder(spark, "table"), new_folder(spark, "progress")

    def run():
        return ingest_new(landed_files(spark, f"file://{folder}", SCHEMA, files_per_batch=2), table, progress)

    for i in range(3):
        land(folder, str(i), range(i * 10, i * 10 + 10))
    assert run() == 2 and ingested(spark, table, SCHEMA).count() == 30
    land(folder, "late", range(100, 105))
    assert run() == 1 and ingested(spark, table, SCHEMA).count() == 35
    assert run() == 0 and ingested(spark, table, SCHEMA).select("k").distinct().count() == 35
    assert batches(spark, table, SCHEMA).count() == 3


def test_replayed_batch_leaves_no_copies(spark, folder):
    """A crash between the write and the commit makes the batch run again."""
    import os
    table, progress = new_folder(spark, "table"), new_folder(spark, "progress")
    land(folder, "a", range(10))
    ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, progress)
    commits = progress.removeprefix("file://") + "/commits"
    for name in os.listdir(commits):
        os.remove(f"{commits}/{name}")
    ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, progress)
    assert ingested(spark, table, SCHEMA).count() == 10


def test_lost_checkpoint_stores_nothing_twice(spark, folder):
    table = new_folder(spark, "table")
    land(folder, "a", range(10))
    assert ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, new_folder(spark, "progress")) == 1
    land(folder, "b", range(10, 15))
    assert ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, new_folder(spark, "progress")) == 1
    assert ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, new_folder(spark, "progress")) == 0
    assert sorted(r["k"] for r in ingested(spark, table, SCHEMA).collect()) == list(range(15))
    assert {(r["arquivo"].rsplit("/", 1)[1], r["linhas"]) for r in ledger(spark, table).collect()} == {("a.json", 10), ("b.json", 5)}


def test_rows_of_a_broken_batch_are_not_read(spark, folder):
    """A crash after the rows and before the ledger, and then a lost checkpoint: the files are taken again."""
    table = new_folder(spark, "table")
    land(folder, "a", range(10))
    spark.read.schema(SCHEMA).json(f"file://{folder}").withColumn("arquivo", F.col("_metadata.file_path")).write.parquet(
        f"{table}/dados/fonte=lost/lote=0")
    ingest_new(landed_files(spark, f"file://{folder}", SCHEMA), table, new_folder(spark, "progress"))
    assert ingested(spark, table, SCHEMA).count() == 10
