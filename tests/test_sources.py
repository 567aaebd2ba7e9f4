import json
import os
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finmart.plans.loans import loans_union
from finmart.plans.registry import appended_listings, fetch_registry
from finmart.sources import checked, envelope, files, layouts
from finmart.sources.odata import PeriodService
from finmart.sources.sheets import (
    header_names, read_workbooks, shape_sheet, sheet_table, unreadable_workbooks, workbook_cells, workbook_files)
from finmart.sources.workbook_writer import column_letters, column_number, to_workbooks, workbook_bytes, write_workbooks


def write(folder, name, text, encoding="utf-8"):
    path = pathlib.Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return "file://" + str(path)


def test_csv_dialects(spark, folder):
    latin = write(folder, "a.csv", "Mês;Valor\nAção;1,5\n", "latin-1")
    schema = layouts.strings("Mês", "Valor")
    assert tuple(files.read_csv(spark, latin, schema, ";", "ISO-8859-1").first()) == ("Ação", "1,5")
    assert files.read_csv(spark, latin, schema, ";", "ISO-8859-1").select("Valor").first()[0] == "1,5"
    other = layouts.strings("valor_total", "mes")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, latin, other, ";", "ISO-8859-1").collect()
    assert files.read_csv(spark, latin, other, ";", "ISO-8859-1", check_header=False).first()["mes"] == "1,5"
    plain = write(folder, "b.csv", "1;x;;2\n3;y;z;4\n")
    assert [tuple(r) for r in files.read_positional_csv(spark, plain, 4).collect()] == [("1", "x", None, "2"), ("3", "y", "z", "4")]
    lines = spark.createDataFrame([("1;x;;2",)], ["line"])
    assert tuple(files.parse_positional(lines, "line", 4).first()) == ("1", "x", None, "2")
    dated = T.StructType([T.StructField("DATA", T.DateType())])
    assert str(files.read_csv(spark, write(folder, "c.csv", "DATA\n2020-02-29\n"), dated).first()[0]) == "2020-02-29"


@pytest.mark.parametrize("split", ["40b", "128m"])
def test_rejected_lines_are_told_with_their_place(spark, folder, split):
    """Lines are numbered through however small the splits of a file are."""
    good = [f"{i};nome {i};{i},5" for i in range(30)]
    write(folder, "csv/a.csv", "\n".join(["k;nome;v", *good[:10], "10;curta", *good[10:20], "k;nome;v", "x;nome;1,5", *good[20:]]) + "\n")
    write(folder, "csv/b.csv", "outra;linha;aqui\n\n1;a;b;c\n2;\"com ; dentro\";3,0\n")
    schema = T.StructType([T.StructField("k", T.IntegerType()), *layouts.strings("nome", "v").fields])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = checked.read_checked_csv(spark, f"file://{folder}/csv", schema, ";")
        rows = found.rows.collect()
        rejects = {(pathlib.Path(r["arquivo"]).stem, r["linha"], r["texto"], r["motivo"]) for r in found.rejects.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(tuple(r) for r in rows) == sorted([(i, f"nome {i}", f"{i},5") for i in range(30)] + [(2, "com ; dentro", "3,0")])
    assert rejects == {("a", 12, "10;curta", "campos"), ("a", 24, "x;nome;1,5", "valor"), ("b", 1, "outra;linha;aqui", "cabecalho"),
                       ("b", 3, "1;a;b;c", "campos")}


def test_checked_latin1(spark, folder):
    path = write(folder, "l.csv", "m\u00eas;v\na\u00e7\u00e3o;1\nruim\n", "latin-1")
    found = checked.read_checked_csv(spark, path, layouts.strings("m\u00eas", "v"), ";", "ISO-8859-1")
    assert [tuple(r) for r in found.rows.collect()] == [("a\u00e7\u00e3o", "1")]
    assert [(r["linha"], r["texto"]) for r in found.rejects.collect()] == [(3, "ruim")]


def test_lost_cells(spark):
    df = spark.createDataFrame([("1,5", "7"), ("n/d", ""), (None, " "), ("", "x")], "a string, b string")
    told = checked.lost_cells(df, {"a": F.col("a").try_cast("double"), "b": F.col("b").try_cast("int")})
    assert {tuple(r) for r in told.collect()} == {("a", 2), ("b", 1)}


def test_json_lines_folder_is_one_scan(spark, folder):
    for i in range(3):
        write(folder, f"lines/{i}.json", "".join(json.dumps({"k": i, "v": j}) + "\n" for j in range(4)))
    write(folder, "lines/notes.txt", "not data")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    df = files.read_json_lines(spark, f"file://{folder}/lines", schema, with_file=True)
    assert df.count() == 12 and df.select("file").distinct().count() == 3
    write(folder, "lines/bad.json", '{"k": 9, "v": 9}\n{"k": oops\n')
    df = files.read_json_lines(spark, f"file://{folder}/lines", schema, unreadable="texto")
    rows = df.collect()
    assert [tuple(r)[:3] for r in rows if r["texto"]] == [(None, None, '{"k": oops')] and len(rows) == 14


def test_envelopes(spark, folder):
    record = layouts.strings("Data", "Total")
    write(folder, "docs/a.json", json.dumps({"value": [{"Data": "2021-01-04", "Total": "12.5"}, {"Data": None}]}, indent=2))
    write(folder, "docs/b.json", json.dumps({"value": []}))
    assert sorted(map(str, envelope.read_envelopes(spark, f"file://{folder}/docs", record).collect())) == [
        "Row(Data='2021-01-04', Total='12.5')", "Row(Data=None, Total=None)"]
    texts = spark.createDataFrame([('{"value":[{"Data":"x"}]}',), ("{broken",), (None,)], ["doc"])
    assert [r["Data"] for r in envelope.open_envelopes(texts, "doc", record).collect()] == ["x"]


def test_year_folders(spark, folder):
    for year in (2019, 2020):
        for part in "ab":
            write(folder, f"{year}/{part}.csv", f"uf;valor\nSP;{year},25\n")
    out = loans_union(spark, {y: f"file://{folder}/{y}" for y in (2019, 2020)}, layouts.strings("uf", "valor"), ["valor"])
    assert {tuple(r) for r in out.groupBy("ano").agg(F.sum("valor")).collect()} == {(2019, 4038.5), (2020, 4040.5)}


def test_workbooks(spark, folder):
    lead = [["Quadro"]] * 8
    body = [[None, f"UF{i}", i, None if i == 2 else i * 1.5] for i in range(4)]
    notes = [[None, "nota"]] * 7
    book = workbook_bytes({"quadro 1": [["x"]], "quadro 4": lead + body + notes, "a & b": [["Ano", "Valor"], [2019, "1 < 2"]]})
    (pathlib.Path(folder) / "q.xlsx").write_bytes(book)
    cells = read_workbooks(spark, f"file://{folder}").cache()
    letters = {"B": "UF", "C": "Total Municípios", "D": "x"}
    for sheet in ("quadro 4", 1):
        rows = shape_sheet(cells, letters, sheet, 8, 7).orderBy("row").drop("file", "sheet").collect()
        assert [tuple(r) for r in rows] == [(9, "UF0", "0", "0.0"), (10, "UF1", "1", "1.5"), (11, "UF2", "2", None), (12, "UF3", "3", "4.5")]
    assert header_names(cells.where("sheet_index = 2"), ["A", "B"]) == {"A": "Ano", "B": "Valor"}
    assert cells.where("sheet = 'a & b' AND row = 2 AND col = 'B'").first()["value"] == "1 < 2"
    assert [column_letters(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_shared_strings(spark, folder):
    """Workbooks saved by spreadsheet programs keep their texts in one shared table."""
    import io
    import zipfile

    source = workbook_bytes({"s": [["placeholder"]]})
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(source)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            text = old.read(name)
            if name.endswith("sheet1.xml"):
                ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
                text = f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>1</v></c><c r="B1"/></row></sheetData></worksheet>'
                new.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>no</t></si><si><r><t>Ag</t></r><r><t>ência</t></r></si></sst>")
            new.writestr(name, text)
    (pathlib.Path(folder) / "s.xlsx").write_bytes(out.getvalue())
    assert [r["value"] for r in read_workbooks(spark, f"file://{folder}").collect()] == ["Agência"]


def test_sheets_are_read_in_pieces(spark):
    """A large sheet is given out row by row, and one shared part never lies whole in memory."""
    import tracemalloc

    from finmart.sources.sheets import _workbook_cells

    book = workbook_bytes({"s": [[i, f"texto {i}", None, "x" * 50] for i in range(60_000)]})
    tracemalloc.start()
    count = sum(1 for _ in _workbook_cells(book))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert count == 180_000 and peak < 12_000_000


def test_headers_must_agree(spark, folder):
    for name, header in (("a", "Ano"), ("b", "Mes")):
        (pathlib.Path(folder) / f"{name}.xlsx").write_bytes(workbook_bytes({"s": [[header, "Valor"], [1, 2]]}))
    with pytest.raises(ValueError, match="A"):
        header_names(read_workbooks(spark, f"file://{folder}"))
    table = sheet_table(read_workbooks(spark, f"file://{folder}", "a.xlsx"), 0)
    assert table.columns == ["Ano", "Valor"] and [tuple(r) for r in table.collect()] == [("1", "2")]


def test_damaged_workbooks_are_told(spark, folder):
    good = workbook_bytes({"s": [["Ano"], [1]]})
    for name, content in (("good", good), ("cut", good[:200]), ("text", b"no workbook")):
        (pathlib.Path(folder) / f"{name}.xlsx").write_bytes(content)
    found = {pathlib.Path(r["file"]).stem for r in unreadable_workbooks(workbook_files(spark, f"file://{folder}")).collect()}
    assert found == {"cut", "text"}


def test_written_workbooks_are_the_same_again(spark, folder):
    cells = spark.createDataFrame(
        [("ano=2019/a.xlsx", "um", 0, 2, "AB", "x"), ("ano=2019/a.xlsx", "dois", 1, 1, "A", "y"), ("ano=2020/b.xlsx", "um", 0, 1, "B", "z")],
        "file string, sheet string, sheet_index int, row int, col string, value string")
    first = {r["path"]: r["bytes"] for r in write_workbooks(cells, f"file://{folder}").collect()}
    content = {p: pathlib.Path(p.removeprefix("file://")).read_bytes() for p in first}
    write_workbooks(cells, f"file://{folder}").collect()
    assert {p: pathlib.Path(p.removeprefix("file://")).read_bytes() for p in first} == content
    told = read_workbooks(spark, f"file://{folder}", carry=("ano",)).collect()
    assert {(r["ano"], r["sheet"], r["sheet_index"], r["row"], r["col"], r["value"]) for r in told} == {
        (2019, "um", 0, 2, "AB", "x"), (2019, "dois", 1, 1, "A", "y"), (2020, "um", 0, 1, "B", "z")}
    assert [column_number(x) for x in ("A", "Z", "AA", "ZZ", "AAA")] == [0, 25, 26, 701, 702]
    books = [to_workbooks(spark.range(5).coalesce(1), "s") for _ in range(2)]
    assert books[0].first()["path"] == books[1].first()["path"] and workbook_cells(books[0]).count() == 6


@pytest.fixture
def service(folder):
    for period in ("201903", "201906", "201909"):
        for page in range(2):
            write(folder, f"{period}/{page}.csv", f"CodInst,NomeInstituicao\n{page},Banco {period}\n")
    return f"file://{folder}" + "/{period}/{page}.csv"


def test_period_service(spark, service):
    schema = layouts.strings("AnoMes", "CodInst", "NomeInstituicao", "Situacao")
    spark.dataSource.register(PeriodService)
    reader = spark.read.format("period_service").schema(schema).options(url=service, periods="201903,201906,201909", pages="2")
    df = reader.load()
    assert df.rdd.getNumPartitions() == 6 and df.count() == 6
    assert tuple(df.where("AnoMes = '201906' AND CodInst = '1'").first()) == ("201906", "1", "Banco 201906", None)


def test_pages_beyond_the_stated_number_are_read(spark, service, folder):
    schema = layouts.strings("AnoMes", "CodInst", "NomeInstituicao")
    spark.dataSource.register(PeriodService)
    write(folder, "201903/2.csv", "CodInst,NomeInstituicao\n2,Banco novo\n")
    reader = spark.read.format("period_service").schema(schema).options(url=service, periods="201903,201906")
    assert reader.load().count() == 5


def test_only_named_periods_are_requested(spark, service):
    schema = layouts.strings("AnoMes", "CodInst")
    spark.dataSource.register(PeriodService)
    reader = spark.read.format("period_service").schema(schema).options(url=service, pages="2")
    with pytest.raises(Exception, match="209912"):  # the service has no such period
        reader.options(periods="201903,209912").load().count()
    df = reader.options(periods="201903,209912", missing="empty").load()
    assert df.count() == 2


def test_filters_do_not_leak_between_uses_of_a_frame(spark, service):
    spark.dataSource.register(PeriodService)
    df = spark.read.format("period_service").schema(layouts.strings("AnoMes", "CodInst")).options(
        url=service, periods="201903,201906", pages="2").load()
    assert (df.where("AnoMes = '201903'").count(), df.count()) == (2, 4)
    both = df.where("AnoMes = '201903'").unionByName(df.where("AnoMes = '201906'"))
    assert {r["AnoMes"] for r in both.collect()} == {"201903", "201906"}


def test_json_service(spark, folder):
    write(folder, "201903.json", json.dumps({"value": [{"CodInst": 1, "Saldo": 2.5}, {"CodInst": 2}]}))
    spark.dataSource.register(PeriodService)
    df = spark.read.format("period_service").schema(layouts.strings("AnoMes", "CodInst", "Saldo")).options(
        url=f"file://{folder}" + "/{period}.json", periods="201903", payload="json").load()
    assert {tuple(r) for r in df.collect()} == {("201903", "1", "2.5"), ("201903", "2", None)}


def test_registry_listings(spark, service, folder):
    fetched = fetch_registry(spark, service, "2019-03", "2019-10", pages=2, schema=layouts.strings("AnoMes", "CodInst", "NomeInstituicao"))
    assert fetched.count() == 6
    text = "CodInst,Nome\n1,A\nCodInst,Nome\n1,B\n2,C\n"
    raw = files.read_csv(spark, write(folder, "listing/l.csv", text), layouts.strings("CodInst", "Nome"))
    assert appended_listings(raw).count() == 3
    assert os.path.exists(folder)
