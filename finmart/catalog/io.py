"""Scans and sinks: the given tables are written in each raw format to the shared folder, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.catalog.base import KEYS, Tables, query
from finmart.functions.dates import period_list
from finmart.functions.numbers import ptbr_integer, ptbr_number, to_number
from finmart.operators.columns import quoted
from finmart.operators.ordering import row_index
from finmart.plans.fixed_values import LOAD_LIST
from finmart.plans.publish import ingest_documents, load_list, load_originals
from finmart.session import new_folder, written
from finmart.sources import files, sinks
from finmart.sources.checked import converted, read_checked_csv
from finmart.sources.envelope import envelope, open_envelopes, unreadable_envelopes
from finmart.sources.layouts import strings
from finmart.sources.odata import PeriodService
from finmart.sources.sheets import read_workbooks, shape_sheet
from finmart.sources.workbook_writer import column_letters, write_workbooks
from finmart.streaming.ingest import ingest_new, ingested, landed_files

K = ", ".join(KEYS)
ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderpriority", T.StringType()),
    T.StructField("data", T.DateType())])
_ORDERS_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
                        CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data FROM orders"""
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType())])
_EVENTS_SQL = "SELECT event_id, user_id, event_type, value, props FROM events"


def _orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("data"))


def _orders_of(t: Tables, status: str) -> DataFrame:
    of_status = t.orders.where(F.col("o_orderstatus") == status)
    return of_status.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.to_date("o_orderdate").alias("data"))


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("data", F.col("data").cast("string"))


def _events(t: Tables) -> DataFrame:
    return t.events.select(*EVENTS.fieldNames())


@query(f"SELECT {K}, l_quantity FROM lineitem")
def scan_parquet(t: Tables) -> DataFrame:
    return files.read_parquet(t.spark, f"{t.folder}/lineitem.parquet", [*KEYS, "l_quantity"])


@query(_ORDERS_SQL)
def scan_csv_header(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    _orders(t).withColumn("data", F.date_format("data", "dd/MM/yyyy")).write.option("header", True).csv(path)
    return _shown(files.read_csv(t.spark, path, ORDERS, date_format="dd/MM/yyyy"))


@query(f"SELECT {K}, l_extendedprice, l_returnflag FROM lineitem")
def scan_csv_layout(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "positional")
    t.lineitem.select(*KEYS, "l_extendedprice", "l_returnflag").write.option("sep", ";").csv(path)
    raw = files.read_positional_csv(t.spark, path, 6)
    return raw.select(*(F.col(f"_{i}").cast("int" if k == "l_linenumber" else "long").alias(k) for i, k in enumerate(KEYS)),
                      to_number("_4").alias("l_extendedprice"), F.col("_5").alias("l_returnflag"))


@query("SELECT p_partkey, p_name || ' ação' AS nome FROM part")
def scan_csv_latin1(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "latin1")
    named = t.part.select("p_partkey", F.concat("p_name", F.lit(" ação")).alias("nome"))
    sinks.write_csv(named, path, sep=";", encoding="ISO-8859-1")
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("nome", T.StringType())])
    return files.read_csv(t.spark, path, schema, sep=";", encoding="ISO-8859-1")


@query(f"SELECT *, true AS tem_arquivo FROM ({_EVENTS_SQL})")
def scan_jsonl_dir(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "jsonl")
    _events(t).write.json(path)
    df = files.read_json_lines(t.spark, path, EVENTS, with_file=True)
    return df.withColumn("tem_arquivo", F.col("file").endswith(".json")).drop("file")


RECORD = strings("event_id", "NomeColuna", "Saldo")


def _documents(t: Tables) -> DataFrame:
    """Each event as a document of two report records."""
    def record(name: str, value: str):
        return F.struct(F.col("event_id").cast("string").alias("event_id"), F.lit(name).alias("NomeColuna"),
                        F.col(value).cast("string").alias("Saldo"))
    return t.events.select(envelope(record("valor", "value"), record("usuario", "user_id")).alias("document"))


_DOCUMENTS_SQL = """SELECT event_id, 'valor' AS "NomeColuna", value AS "Saldo" FROM events
                    UNION ALL SELECT event_id, 'usuario', CAST(user_id AS DOUBLE) FROM events"""


@query(_DOCUMENTS_SQL)
def json_envelope(t: Tables) -> DataFrame:
    records = open_envelopes(_documents(t), "document", RECORD)
    return records.select(F.col("event_id").cast("long").alias("event_id"), "NomeColuna", to_number("Saldo").alias("Saldo"))


BOOK_ROWS = 20_000


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def sheet_cells(t: Tables) -> DataFrame:
    """Customers as workbook files of at most ``BOOK_ROWS`` rows, scanned from their folder."""
    root = new_folder(t.spark, "workbooks")
    letters = {"c_custkey": "A", "c_name": "B", "c_mktsegment": "C", "c_acctbal": "D"}
    placed = t.customer.withColumns({"book": F.floor(F.col("c_custkey") / BOOK_ROWS), "place": F.col("c_custkey") % BOOK_ROWS})
    cells = as_cells(placed, F.format_string("clientes-%d.xlsx", "book"), "place", letters, 3, 0)
    written(write_workbooks(cells, root), "workbook-list")
    names = {letter: c for c, letter in letters.items()}
    rows = shape_sheet(read_workbooks(t.spark, root), names, "quadro 4", skip=3)
    return rows.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment",
                       to_number("c_acctbal").alias("c_acctbal"))


def as_cells(df: DataFrame, file: Column, position: str, letters: dict[str, str], lead: int, footer: int,
             sheet: str = "quadro 4", index: int = 3) -> DataFrame:
    """A table as cells: one workbook per ``file``, with ``lead`` title rows above and ``footer`` note rows below.

    ``position`` is the 0-based place of a row in its sheet; ``letters`` maps columns to column letters.
    """
    texts = [quoted(c).cast("string").alias(letter) for c, letter in letters.items()]
    body = df.select(file.alias("file"), (F.col(position) + lead + 1).cast("int").alias("row"), *texts).unpivot(
        ["file", "row"], list(letters.values()), "col", "value")
    first = next(iter(letters.values()))
    last = body.groupBy("file").agg(F.max("row").alias("last"))
    above = F.sequence(F.lit(1), F.lit(lead)) if lead else F.array().cast("array<int>")
    below = F.sequence(F.col("last") + 1, F.col("last") + footer) if footer else F.array().cast("array<int>")
    notes = last.select("file", F.explode(F.concat(above, below)).alias("row"))
    cells = body.unionByName(notes.withColumns({"col": F.lit(first), "value": F.lit("nota")}))
    return cells.where("value IS NOT NULL").select(
        "file", F.lit(sheet).alias("sheet"), F.lit(index).alias("sheet_index"), "row", "col", "value")


def headed_cells(df: DataFrame, file: str, sheet: str = "dados", index: int = 0) -> DataFrame:
    """A small table as the cells of one sheet: its column names in the first row, then its rows in the order of the first column."""
    letters = {c: column_letters(i) for i, c in enumerate(df.columns)}
    indexed = row_index(df, [quoted(df.columns[0])], "place")
    names = df.sparkSession.createDataFrame([(file, sheet, index, 1, letter, c) for c, letter in letters.items()],
                                            "file string, sheet string, sheet_index int, row int, col string, value string")
    return as_cells(indexed, F.lit(file), "place", letters, 1, 0, sheet, index).where("row > 1").unionByName(names)


@query("SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def sheet_shape(t: Tables) -> DataFrame:
    blanks = t.customer.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    letters = {"c_custkey": "B", "c_name": "C", "c_mktsegment": "QL", "c_acctbal": "QM", "c_nationkey": "QN"}
    # a workbook per state
    cells = as_cells(blanks, F.concat(F.lit("quadros-"), "c_nationkey"), "c_custkey", letters, 8, 7)
    names = {letter: c for c, letter in letters.items() if c != "c_nationkey"}
    rows = shape_sheet(cells, names, "quadro 4", skip=8, footer=7)
    return rows.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment",
                       to_number("c_acctbal").alias("c_acctbal"))


ROWS_PER_PAGE = 50_000


def paged(df: DataFrame, period: str, key: str) -> tuple[DataFrame, int]:
    """Add ``page``: the fullest period is cut into pages of about ``ROWS_PER_PAGE`` rows, so no page grows with the data.

    The rows of a page are brought together from at most 16 shares, which keeps the files few and a hot period spread.
    """
    fullest = df.groupBy(period).count().agg(F.max("count")).first()[0] or 0
    pages = max(1, -(-fullest // ROWS_PER_PAGE))
    cut = df.withColumn("page", F.pmod(F.xxhash64(key), F.lit(pages)))
    return cut.repartition(F.col(period), F.col("page"), F.pmod(F.spark_partition_id(), F.lit(16))), pages


def quarter_period(date: str) -> Column:
    """The last month of a date's quarter, as ``yyyyMM``."""
    return F.date_format(F.make_date(F.year(date), F.quarter(date) * 3, F.lit(1)), "yyyyMM")


@query("""SELECT strftime(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH, '%Y%m') AS "AnoMes", o_orderkey, o_custkey,
                 o_orderpriority FROM orders""")
def odata_source(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "service")
    orders, pages = paged(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", quarter_period("o_orderdate").alias("AnoMes")),
                          "AnoMes", "o_orderkey")
    orders.write.partitionBy("AnoMes", "page").option("header", True).csv(path)
    span = t.orders.agg(F.date_format(F.min("o_orderdate"), "yyyy").alias("lo"), F.date_format(F.max("o_orderdate"), "yyyy").alias("hi")).first()
    t.spark.dataSource.register(PeriodService)
    rows = (t.spark.read.format(PeriodService.name()).schema(strings("AnoMes", "o_orderkey", "o_custkey", "o_orderpriority"))
            .options(url=path + "/AnoMes={period}/page={page}", pages=pages, missing="empty",
                     periods=",".join(period_list(f"{span['lo']}-03", f"{int(span['hi']) + 1}-01")))
            .load())
    return rows.withColumns({"o_orderkey": F.col("o_orderkey").cast("long"), "o_custkey": F.col("o_custkey").cast("long")})


@query(f"SELECT *, CAST(substr(data, 1, 4) AS INTEGER) AS ano FROM ({_ORDERS_SQL})")
def sink_parquet(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "parquet")
    sinks.write_parquet(_orders(t).withColumn("ano", F.year("data")), path, partition_by=["ano"])
    return _shown(t.spark.read.parquet(path))


@query("SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM customer")
def sink_parquet_replace_self(t: Tables) -> DataFrame:
    table = sinks.Versions(new_folder(t.spark, "self"))
    table.replace(t.customer.select("c_custkey", "c_name", "c_acctbal"))
    broken = F.when(F.col("c_custkey") > 0, F.raise_error(F.lit("broken"))).otherwise(F.col("c_acctbal"))
    try:
        table.replace(table.read(t.spark).withColumn("c_acctbal", broken.cast("double")))
    except PySparkException:
        pass  # the version before stays in force
    table.replace(table.read(t.spark).withColumn("c_acctbal", F.col("c_acctbal") * 2))
    return table.read(t.spark)


@query(_ORDERS_SQL)
def sink_csv_roundtrip(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    sinks.write_csv(_orders(t), path)
    return _shown(files.read_csv(t.spark, path, ORDERS))


@query(_ORDERS_SQL)
def sink_csv_append(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "csv")
    for status in ("F", "O", "P"):
        sinks.write_csv(_orders_of(t, status), path, "append")
    return _shown(files.read_csv(t.spark, path, ORDERS))


@query(_ORDERS_SQL)
def sink_json_append(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "json")
    early = F.col("data") < F.lit("1998-01-01")
    sinks.write_json(_orders(t).where(early), path)
    sinks.write_json(_orders(t).where(~early), path)
    return _shown(files.read_json_lines(t.spark, path, ORDERS))


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer")
def document_rows(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "documents")
    df = t.customer.select("c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"))
    sinks.publish_documents(df, path)
    sinks.publish_documents(df, path)  # replaces, does not add
    return t.spark.read.schema(df.schema).json(path)


@query(" UNION ALL ".join(f"SELECT '{n}' AS tabela, count(*) AS linhas" + f", count(*) AS no_jornal FROM {n}"
                          for n in ["customer", "orders", "lineitem"]))
def load_manifest(t: Tables) -> DataFrame:
    """Three tables loaded, and loaded again under the same id."""
    target = sinks.Folder(new_folder(t.spark, "database"))
    frames = {n: getattr(t, n) for n in ["customer", "orders", "lineitem"]}
    for _ in range(2):
        _all_ok(load_originals(frames, target, load="carga-1"))
    return _loaded(t, target, [*frames])


def _all_ok(report: dict[str, str]) -> None:
    for name, outcome in report.items():
        if outcome != "ok":
            raise RuntimeError(f"{name}: {outcome}")


def _loaded(t: Tables, target: sinks.Folder, tables: list[str]) -> DataFrame:
    """Rows that the tables hold, beside the rows that the journal tells."""
    counted = [target.table(t.spark, n).agg(F.lit(n).alias("tabela"), F.count(F.lit(1)).alias("linhas")) for n in tables]
    told = target.journal(t.spark).groupBy(F.col("tabela")).agg(F.sum("linhas").alias("no_jornal"))
    return reduce(DataFrame.unionByName, counted).join(told, "tabela")


_ORIGINALS = ["part", "supplier", "customer", "nation"]


@query(" UNION ALL ".join(f"SELECT '{table}' AS tabela, count(*) AS linhas, count(*) AS no_jornal FROM {_ORIGINALS[i % 4]}"
                          for i, (_, table, _) in enumerate(LOAD_LIST)))
def load_list_restart(t: Tables) -> DataFrame:
    """The whole load list; a first run that one bad original cuts short for it is taken up again under the same id."""
    target = sinks.Folder(new_folder(t.spark, "database"))
    frames = {name: getattr(t, _ORIGINALS[i % 4]) for i, (name, *_) in enumerate(LOAD_LIST)}
    bad = t.nation.withColumn("n_name", F.raise_error(F.lit("broken")).cast("string"))
    report = load_list({**frames, "pix": bad}, target, "2022-01")
    if [name for name, outcome in report.items() if outcome != "ok"] != ["pix"]:
        raise RuntimeError(str(report))
    _all_ok(load_list(frames, target, "2022-01"))
    return _loaded(t, target, [table for _, table, _ in LOAD_LIST])


@query(_DOCUMENTS_SQL)
def ingest_json_table(t: Tables) -> DataFrame:
    path = new_folder(t.spark, "envelopes")
    _documents(t).write.text(path)
    target = sinks.Folder(new_folder(t.spark, "database"))
    report = ingest_documents(t.spark, path, RECORD, "pix", target, per_line=True)
    if report["pix"] != "ok":
        raise RuntimeError(report["pix"])
    rows = target.table(t.spark, "pix")
    return rows.select(F.col("event_id").cast("long").alias("event_id"), "NomeColuna", to_number("Saldo").alias("Saldo"))


@query(_EVENTS_SQL)
def stream_ingest(t: Tables) -> DataFrame:
    drop, table = new_folder(t.spark, "landing"), new_folder(t.spark, "ingested")
    checkpoint = new_folder(t.spark, "progress")
    early = F.col("event_type").isin("click", "view")
    _events(t).where(early).write.json(drop)
    ingest_new(landed_files(t.spark, drop, EVENTS), table, checkpoint)
    _events(t).where(~early).write.mode("append").json(drop)
    ingest_new(landed_files(t.spark, drop, EVENTS), table, checkpoint)  # only the new files
    ingest_new(landed_files(t.spark, drop, EVENTS), table, checkpoint)  # nothing new
    ingest_new(landed_files(t.spark, drop, EVENTS), table, new_folder(t.spark, "progress"))  # the checkpoint was lost
    return ingested(t.spark, table, EVENTS).drop("arquivo", "fonte", "lote")


@query("""SELECT 'ilegivel' AS tipo, count(*) AS n FROM events WHERE event_id % 7 = 0
          UNION ALL SELECT 'registro', count(*) FROM events WHERE event_id % 7 <> 0""")
def json_rejects(t: Tables) -> DataFrame:
    """Every seventh document breaks off."""
    whole = envelope(F.struct(F.col("event_id").cast("string").alias("valor"), F.col("event_type").alias("usuario")))
    documents = t.events.select("event_id", whole.alias("document")).select(
        F.when(F.col("event_id") % 7 == 0, F.expr("left(document, length(document) - 4)")).otherwise(F.col("document")).alias("document"))
    count = F.count(F.lit(1)).alias("n")
    broken = unreadable_envelopes(documents, "document", RECORD).agg(count).select(F.lit("ilegivel").alias("tipo"), "n")
    return broken.unionByName(open_envelopes(documents, "document", RECORD).agg(count).select(F.lit("registro").alias("tipo"), "n"))


_CSV_BAD = """CASE WHEN o_orderkey % 11 = 0 THEN 'campos' WHEN o_orderkey % 13 = 0 THEN 'campos' WHEN o_orderkey % 17 = 0 THEN 'valor' END"""


@query(f"""SELECT coalesce({_CSV_BAD}, 'lida') AS tipo, count(*) AS n, count(*) AS linhas_distintas FROM orders GROUP BY 1""")
def csv_rejects(t: Tables) -> DataFrame:
    """Orders as lines, some cut short, some with a field too many, some with a word for a number."""
    key = F.col("o_orderkey")
    price = F.when((key % 17 == 0) & (key % 11 != 0) & (key % 13 != 0), "n/d").otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(";", key.cast("string"), F.when(key % 11 != 0, F.col("o_orderpriority")), price,
                       F.when((key % 13 == 0) & (key % 11 != 0), F.lit("a mais")))
    path = new_folder(t.spark, "lines")
    t.orders.select(line).write.text(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType())])
    found = read_checked_csv(t.spark, path, schema, ";", header=False)
    count, apart = F.count(F.lit(1)).alias("n"), F.count_distinct("arquivo", "linha").alias("linhas_distintas")
    read = found.rows.agg(count, F.count_distinct("o_orderkey").alias("linhas_distintas")).select(
        F.lit("lida").alias("tipo"), "n", "linhas_distintas")
    return read.unionByName(found.rejects.groupBy(F.col("motivo").alias("tipo")).agg(count, apart))


@query("""SELECT 'saldo' AS coluna, count(*) FILTER (c_acctbal < 0) AS perdidas FROM customer
          UNION ALL SELECT 'estado', 0 FROM (SELECT 1)""")
def lost_number_cells(t: Tables) -> DataFrame:
    """pt-BR texts, those of debtors unreadable and blank ones no loss: what the parse lost is told in its own pass."""
    ptbr = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    texts = t.customer.select(F.when(F.col("c_acctbal") < 0, "n/d").otherwise(ptbr).alias("saldo"),
                              F.when(F.col("c_nationkey") > 0, F.col("c_nationkey").cast("string")).otherwise("").alias("estado"))
    told = Observation("perdidas")
    written(converted(texts, {"saldo": ptbr_number("saldo"), "estado": ptbr_integer("estado")}, told), "numbers")
    return t.spark.createDataFrame([(c, n) for c, n in told.get.items()], "coluna string, perdidas bigint")
