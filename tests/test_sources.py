import io
import zipfile

import pandas as pd

from appraise.session import scratch_path
from appraise.sources.files import read_csv, read_headerless, write_dated
from appraise.sources.workbook import parse_xlsx, read_workbooks, write_workbooks, xlsx_bytes


def test_xlsx_roundtrip_bytes():
    pdf = pd.DataFrame({"Type": ["AVANZA 1.3 G M/T", "a&b <c>"], "tahun": [2019, 2020],
                        "price": [1.5, None]})
    rows = parse_xlsx(xlsx_bytes(pdf))
    assert rows[0] == ["Type", "tahun", "price"]
    assert rows[1] == ["AVANZA 1.3 G M/T", "2019", "1.5"]
    assert rows[2][:2] == ["a&b <c>", "2020"]


def test_shared_strings_workbook():
    ns = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/sharedStrings.xml",
                   f'<sst xmlns="{ns}"><si><t>Type</t></si><si><t>AVANZA</t></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet xmlns="{ns}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c>'
                   f'<c r="B1" t="inlineStr"><is><t>tahun</t></is></c></row><row r="2">'
                   f'<c r="A2" t="s"><v>1</v></c><c r="B2"><v>2018</v></c></row>'
                   f'</sheetData></worksheet>')
    assert parse_xlsx(buf.getvalue()) == [["Type", "tahun"], ["AVANZA", "2018"]]


def test_workbooks_scan(spark):
    df = spark.createDataFrame([(f"T{i}", 2000 + i % 20, float(i)) for i in range(300)],
                               "Type string, tahun int, price double")
    path = scratch_path(spark, "wb-test")
    assert write_workbooks(df.repartition(3), path) == 3
    back = read_workbooks(spark, path, "Type string, tahun int, price double", with_path=True)
    assert back.select("path").distinct().count() == 3
    assert back.drop("path").exceptAll(df).count() == 0 and back.count() == 300


def test_csv_semicolon_and_headerless(spark):
    df = spark.createDataFrame([("A;x", 1), ("B", 2)], "Type string, tahun int")
    path = scratch_path(spark, "csv-test")
    write_dated(df, path, "20240101", model_type="toyota", sep=";")
    back = read_csv(spark, f"{path}/model_type=toyota/run_date=20240101",
                    "Type string, tahun int", sep=";")
    assert sorted(map(tuple, back.collect())) == [("A;x", 1), ("B", 2)]
    p2 = scratch_path(spark, "pred")
    spark.createDataFrame([(1.5,), (2.5,)], "v double").write.csv(p2)
    assert sorted(r["prediksi"] for r in read_headerless(spark, p2, "prediksi double").collect()) \
        == [1.5, 2.5]


def test_file_bodies_and_listing(spark):
    from appraise.sources.files import list_objects, read_bodies
    df = spark.createDataFrame([("a", 1), ("b", 2)], "Type string, tahun int")
    path = scratch_path(spark, "bodies")
    df.coalesce(1).write.option("header", True).csv(path)
    listing = list_objects(spark, f"{path}/*.csv").collect()
    bodies = read_bodies(spark, f"{path}/*.csv").collect()
    assert len(listing) == len(bodies) == 1
    assert listing[0]["length"] == len(bodies[0]["content"])
    assert bytes(bodies[0]["content"]).decode().splitlines()[0] == "Type,tahun"


def test_header_csv_is_read_by_name(spark):
    import pytest
    path = scratch_path(spark, "byname")
    spark.createDataFrame([(2019, "AVANZA 1.3 G M/T", 1.5e8)], "tahun int, Type string, price double") \
        .write.option("header", True).csv(path)
    back = read_csv(spark, path, "price double, Type string, tahun int").first()
    assert (back["price"], back["Type"], back["tahun"]) == (1.5e8, "AVANZA 1.3 G M/T", 2019)
    with pytest.raises(ValueError):
        read_csv(spark, path, "price double, cc string")


def test_dynamic_overwrite_keeps_other_partitions(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    path = scratch_path(spark, "dyn")
    a = spark.createDataFrame([("x", 1)], "Type string, tahun int")
    write_dated(a, path, "20240101", model_type="toyota")
    write_dated(a, path, "20240102", model_type="toyota")
    write_dated(a.union(a), path, "20240102", model_type="toyota")
    day1 = read_csv(spark, f"{path}/model_type=toyota/run_date=20240101", "Type string, tahun int")
    day2 = read_csv(spark, f"{path}/model_type=toyota/run_date=20240102", "Type string, tahun int")
    assert (day1.count(), day2.count()) == (1, 2)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_workbooks_are_bounded_and_stream(spark, tmp_path, monkeypatch):
    """A large partition becomes several workbooks; a sheet is parsed and handed on row by row."""
    from appraise.sources import workbook

    monkeypatch.setattr(workbook, "BOOK_ROWS", 70)
    monkeypatch.setattr(workbook, "BATCH_ROWS", 30)
    df = spark.range(200).selectExpr("id", "concat('a<&>', id) AS t", "id / 8 AS v").coalesce(1)
    path = str(tmp_path / "books")
    assert workbook.write_workbooks(df, path) == 3
    sizes = sorted(len(parse_xlsx(f.read_bytes())) - 1 for f in (tmp_path / "books").iterdir())
    assert sizes == [60, 70, 70]
    back = workbook.read_workbooks(spark, path, "id bigint, t string, v double")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    rows = workbook.sheet_rows((tmp_path / "books" / sorted(f.name for f in (tmp_path / "books").iterdir())[0]).read_bytes())
    assert next(rows) == ["id", "t", "v"] and iter(rows) is rows
