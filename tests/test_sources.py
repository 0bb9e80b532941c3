import json

import pytest
from pyspark.sql import functions as F

from panelwright.operators import schema
from panelwright.sources import dictionaries, files, microdata, sinks, sniff, tables


def write(folder, name, text, encoding):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))


@pytest.fixture(scope="module")
def drops(tmp_path_factory):
    root = tmp_path_factory.mktemp("drops")
    write(root, "a/SDEMT__x_2024_trim1.csv", "ent,mun,CD_A\n01,001,año\n02,002,b\n", "utf-8")
    write(root, "a/SDEMT__y_2024_trim2.CSV", "ent;mun;PER\n1;1;224\n", "utf-8-sig")
    write(root, "b/COE1__x_2024_trim1__2.csv", "ent|PER|name\n3|305|niño\n", "utf-16")
    write(root, "b/hogt_z.csv", "ent\tPER\tname\n4\t124\tpeña “x”\n", "cp1252")
    write(root, "other.csv", 'ent,"a,b"\n5,"x, ""y"""\n', "utf-8")
    write(root, "skip.txt", "ent\n1\n", "utf-8")
    return root


def test_manifest(spark, drops):
    found = {r["name"]: r for r in files.manifest(spark, str(drops)).collect()}
    assert set(found) == {"SDEMT__x_2024_trim1.csv", "SDEMT__y_2024_trim2.CSV", "COE1__x_2024_trim1__2.csv", "hogt_z.csv", "other.csv"}
    one = found["SDEMT__x_2024_trim1.csv"]
    assert (one["encoding"], one["delimiter"], one["header"], one["module"], one["anio"], one["trimestre"]) == (
        "utf-8", ",", ["ent", "mun", "CD_A"], "SDEMT", 2024, 1
    )
    assert (found["SDEMT__y_2024_trim2.CSV"]["encoding"], found["SDEMT__y_2024_trim2.CSV"]["delimiter"]) == ("utf-8-sig", ";")
    assert found["SDEMT__y_2024_trim2.CSV"]["header"] == ["ent", "mun", "PER"]
    two_byte = found["COE1__x_2024_trim1__2.csv"]
    assert (two_byte["encoding"], two_byte["delimiter"], two_byte["header"], two_byte["anio"]) == ("utf-16le", "|", ["ent", "PER", "name"], None)
    assert (found["hogt_z.csv"]["encoding"], found["hogt_z.csv"]["delimiter"]) == ("cp1252", "\t")
    assert found["other.csv"]["header"] == ["ent", "a,b"] and found["other.csv"]["module"] is None


def test_read_micro_csv(spark, drops, rows):
    table = microdata.read_micro_csv(spark, files.manifest(spark, str(drops)))
    assert table.columns[:3] == ["anio", "trimestre", "anio_trimestre"]
    assert table.columns[3:] == ["a,b", "CD_A", "ent", "irregular", "mun", "name", "PER"]
    assert dict(table.dtypes)["anio"] == "int" and dict(table.dtypes)["ent"] == "string"
    got = {r["ent"]: r for r in table.collect()}
    assert (got["01"]["anio_trimestre"], got["01"]["CD_A"]) == ("2024T1", "año")
    assert (got["1"]["anio_trimestre"], got["1"]["PER"]) == ("2024T2", "224")
    assert (got["3"]["anio"], got["3"]["trimestre"], got["3"]["name"]) == (2005, 3, "niño")
    assert (got["4"]["anio_trimestre"], got["4"]["name"]) == ("2024T1", "peña “x”")
    assert (got["5"]["anio_trimestre"], got["5"]["a,b"]) == (None, 'x, "y"')
    assert len(got) == 6


def test_wide_encodings(spark, tmp_path, rows):
    write(tmp_path, "SDEMT_a_2024_trim1.csv", "ent,name\n1,niño\n2,x\n", "utf-32")
    write(tmp_path, "SDEMT_b_2024_trim2.csv", "ent,name\n" + "".join(f"{i},ñ{i}\n" for i in range(40)), "utf-16-le")
    write(tmp_path, "SDEMT_c_2024_trim3.csv", b"\xfe\xff" + "ent;name\r\n7;ñ\r\n".encode("utf-16-be"), None)
    table = microdata.read_micro_csv(spark, files.manifest(spark, str(tmp_path)))
    assert table.count() == 43
    assert rows(table.filter("trimestre <> 2"), "trimestre", "ent", "name") == [(1, "1", "niño"), (1, "2", "x"), (3, "7", "ñ")]


def test_case_of_columns(spark, drops, tmp_path):
    write(tmp_path, "SDEMT_1.csv", "CD_A,x\n1,2\n", "utf-8")
    write(tmp_path, "SDEMT_2.csv", "cd_a,x\n3,4\n", "utf-8")
    merged = microdata.read_micro_csv(spark, files.manifest(spark, str(tmp_path)))
    assert len(merged.columns) == 6
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        apart = microdata.read_micro_csv(spark, files.manifest(spark, str(tmp_path)))
        assert apart.columns[3:] == ["CD_A", "cd_a", "irregular", "x"]
        assert {(r["CD_A"], r["cd_a"]) for r in apart.collect()} == {("1", None), (None, "3")}
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_unreadable_file_is_isolated(spark, drops):
    listed = files.discover(spark, str(drops)).select("path", "name", "length")
    ghost = spark.createDataFrame([(f"file:{drops}/none.csv", "none.csv", 1)], listed.schema)
    heads = files.csv_manifest(files.with_heads(listed.unionByName(ghost)))
    bad = [r for r in heads.collect() if r["error"]]
    assert [r["name"] for r in bad] == ["none.csv"] and heads.count() == 6
    assert microdata.read_micro_csv(spark, heads).count() == 6
    groups = schema.header_group_files(heads)
    assert groups.filter("error is not null").count() == 1


def test_top_folder(spark, drops):
    found = files.discover(spark, str(drops)).withColumn("top", files.top_folder(str(drops)))
    assert {r["name"][:5]: r["top"] for r in found.collect()} == {"SDEMT": "a", "COE1_": "b", "hogt_": "b", "other": "root"}


def test_sniffing_truncated_and_empty(spark):
    heads = [("ñ" * 50).encode()[:-1], b"", b"\x00" * 60 + b"a", "ñ,".encode("latin-1") + b" x"]
    df = spark.createDataFrame([(i, bytearray(h)) for i, h in enumerate(heads)], "i int, h binary").orderBy("i")
    assert [r[0] for r in df.select(sniff.sniff_encoding("h")).collect()] == ["utf-8", "utf-8", "utf-16", "cp1252"]
    lines = spark.createDataFrame([(i, t) for i, t in enumerate(["a;b", "a,b;c", "abc", "", None])], "i int, t string").orderBy("i")
    assert [r[0] for r in lines.select(sniff.sniff_delimiter("t")).collect()] == [";", ",", ",", ",", ","]


def test_dictionaries(spark, tmp_path):
    cats = [{"valor": "1", "categoria": "Uno", "casos": "2", "porcentaje": "3"}]
    row = {"tabla": "SDEMT124", "variable": "P1", "categorias": cats, "etiqueta": "x"}
    write(tmp_path, "d/x_diccionario_SDEMT124.json", json.dumps([row, {"tabla": "SDEMT124", "variable": "P2", "categorias": None}]), "utf-8")
    write(tmp_path, "d/e/x_diccionario_all.json", json.dumps({"a": [row], "note": "text", "b": [row]}), "utf-8")
    write(tmp_path, "x_diccionario_test_1.json", json.dumps([row]), "utf-8")
    write(tmp_path, "x_diccionario_bad.json", "{nope", "utf-8")
    got = dictionaries.read_dictionary(spark, str(tmp_path))
    assert got.filter("error is null").count() == 4
    assert [r["path"].split("/")[-1] for r in got.filter("error is not null").collect()] == ["x_diccionario_bad.json"]
    assert got.filter("variable = 'P2'").first()["categorias"] == []


def test_sinks_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(2024, 1, "a", [("1", "é")]), (2024, 2, "b", []), (2023, 4, 'c "q", d', None)],
        "anio int, trimestre int, v string, cats array<struct<valor:string,categoria:string>>",
    )
    sinks.write_master(df, f"{tmp_path}/master")
    back = spark.read.parquet(f"{tmp_path}/master")
    assert rows(back, "anio", "trimestre", "v") == rows(df, "anio", "trimestre", "v")
    sinks.write_master(df.filter("anio = 2023").withColumn("v", F.lit("new")), f"{tmp_path}/master")
    assert rows(spark.read.parquet(f"{tmp_path}/master"), "anio", "v") == [(2023, "new"), (2024, "a"), (2024, "b")]
    sinks.write_csv(df, f"{tmp_path}/csv")
    text = tables.read_panel_csv(spark, f"{tmp_path}/csv", "anio int, trimestre int, v string, cats string")
    assert rows(text.withColumn("v", F.col("v")), "anio", "v")[0][0] == 2023 and text.count() == 3
    sinks.write_json(df, f"{tmp_path}/json")
    again = spark.read.schema(df.schema).json(f"{tmp_path}/json")
    assert rows(again) == rows(df)


def test_readers(spark, tmp_path):
    write(tmp_path, "p.csv", "estado,anio,fecha\nA,2020,2020-03-31\n", "utf-8-sig")
    panel = tables.read_panel_csv(spark, f"{tmp_path}/p.csv", "estado string, anio int, fecha date")
    assert str(panel.first()["fecha"]) == "2020-03-31"
    write(tmp_path, "latin.csv", "estado\naño\n", "latin-1")
    assert tables.read_panel_csv(spark, f"{tmp_path}/latin.csv", "estado string", "ISO-8859-1").first()[0] == "año"
    write(tmp_path, "cells.csv", "source,row_idx,col_idx,value\ns,0,1,x\n", "utf-8")
    assert tuple(tables.read_cells(spark, f"{tmp_path}/cells.csv").first()) == ("s", 0, 1, "x")
    panel.write.parquet(f"{tmp_path}/p.parquet")
    assert tables.scan(spark, f"{tmp_path}/p.parquet", ["anio"], 1).collect()[0][0] == 2020
    sheet = spark.createDataFrame([("05/04/2024", "1.5")], ["Fecha ", "Ingreso obrero - patronal nacional"])
    got = tables.read_monthly(sheet, tables.INSURANCE_SERIES, dayfirst=True).first()
    assert (str(got[0]), got[1]) == ("2024-04-05", 1.5)
    with pytest.raises(ValueError, match="Impuesto"):
        tables.read_monthly(sheet, tables.TAX_SERIES)
