from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelwright.functions.text import NATION
from panelwright.operators import aggregates, filters, joins, labels, profile, reshape, schema, series

# --- joins ---------------------------------------------------------------------------


def test_lookup_routes_agree(spark, rows, monkeypatch):
    # A key with a third of the rows, a null key, a key without a match.
    fact = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 7).cast("string")).alias("k"), "id"
    )
    lookup = spark.createDataFrame([("hot", "H"), ("1", "one"), ("2", None)], "k string, v string")
    small = rows(joins.join_lookup(fact, lookup, ["k"]))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    large = joins.join_lookup(fact, lookup, ["k"])
    assert rows(large) == small and len(small) == 900
    assert rows(joins.join_lookup(fact, lookup, ["k"], "inner")) == [r for r in small if r[0] in ("hot", "1", "2")]


def test_size_check(spark):
    df = spark.createDataFrame([("a" * 100,), (None,)], "s string")
    assert joins.fits_broadcast(df) and not joins.fits_broadcast(df, max_rows=1) and not joins.fits_broadcast(df, max_bytes=100)


def test_settled_uses_the_named_folder(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = len(list(folder.rglob("part-*")))
    assert joins.settled(spark.range(3)).count() == 3
    assert len(list(folder.rglob("part-*"))) > before


def test_catalog_lookups(spark, rows):
    catalog = spark.createDataFrame(
        [("1", "Aguas", "1", "Uno"), ("01", "Zeta", "001", "Una"), ("2", "Baja", "2", "Dos"), (None, "Nada", None, "Nada")],
        "CVE_ENT string, NOM_ENT string, CVE_MUN string, NOM_MUN string",
    )
    data = spark.createDataFrame([("01", "001"), ("1", "2"), ("2", "02"), (None, "1"), ("99", None)], "ent string, mun string")
    got = rows(joins.label_state(data, catalog), "ent", "ent_nombre")
    assert got == sorted([("01", "Aguas"), ("1", "Aguas"), ("2", "Baja"), (None, None), ("99", None)], key=repr)
    named = joins.label_municipality(data, catalog)
    assert rows(named, "ent", "mun_nombre") == sorted([("01", "Una"), ("1", None), ("2", "Dos"), (None, None), ("99", None)], key=repr)
    assert joins.label_municipality(data, catalog, drop_codes=True).columns == ["mun_nombre"]


def test_repeated_keys_fail(spark):
    one = spark.createDataFrame([(date(2024, 3, 31), 1.0)], "fecha date, a double")
    two = spark.createDataFrame([(date(2024, 3, 31), 1.0), (date(2024, 3, 31), 2.0)], "fecha date, b double")
    with pytest.raises(Exception, match="more than one row"):
        joins.join_on_date(one, two).collect()
    with pytest.raises(Exception, match="more than one row"):
        joins.join_many_to_one(one, two, ["fecha"]).collect()
    assert joins.join_on_date(one, one.withColumnRenamed("a", "b")).collect()[0]["b"] == 1.0


def test_with_total_and_shares(spark, rows):
    df = spark.createDataFrame([("x", "d1", 1.0), ("y", "d1", 3.0), ("x", "d2", 0.0), ("x", "d3", 5.0)], "e string, d string, v double")
    total = spark.createDataFrame([("d1", 4.0), ("d2", 0.0)], "d string, v double")
    assert rows(joins.with_total(df, total, ["d"], "v"), "e", "d", "share_pct") == sorted(
        [("x", "d1", 25.0), ("y", "d1", 75.0), ("x", "d2", None), ("x", "d3", None)], key=repr
    )
    shares = series.share_of_total(df, "v", by=["d"])
    assert rows(shares.groupBy("d").agg(F.sum("share_pct"))) == [("d1", 100.0), ("d3", 100.0)]
    assert series.share_of_total(df.filter("v = 0"), "v").count() == 0


# --- grids ---------------------------------------------------------------------------


def cells(spark, grid, source="s"):
    flat = [(source, r, c, v) for (r, c), v in grid.items() if v is not None]
    return spark.createDataFrame(flat, "source string, row_idx int, col_idx int, value string")


GRID = {
    (4, 1): "2018R", (4, 3): "2019p", (5, 1): "T1", (5, 2): "Anual", (5, 3): "T2", (5, 5): "otro", (4, 4): "2020",
    (6, 0): " Millones ", (7, 0): "A ", (7, 1): "1.5", (7, 2): "x", (8, 0): "B", (8, 3): "4", (9, 1): "9",
    (10, 0): "Índice", (11, 0): " ", (11, 1): "7",
    (14, 0): "Otra", (15, 0): "A", (15, 5): "8", (7, 4): "0",
}


def test_grid_to_long(spark, rows):
    long = reshape.grid_to_long(cells(spark, GRID), title_rows=(7, 11, 15), n=3)
    tidy = reshape.tidy_panel(long, "vab", keep_title_row=True)
    got = rows(tidy, "metric", "estado", "anio", "periodo", "fecha", "valor", "es_acumulado", "title_row")
    mar18, dec18, jun19 = date(2018, 3, 31), date(2018, 12, 31), date(2019, 6, 30)
    expected = []
    for metric, estado, values, row in (("Millones", "A", {"T1": 1.5}, 7), ("Millones", "B", {"T2": 4.0}, 7), ("Otra", "A", {"otro": 8.0}, 15)):
        for anio, periodo, fecha, total in ((2018, "T1", mar18, False), (2018, "Anual", dec18, True), (2019, "T2", jun19, False), (2019, "otro", None, False)):
            expected.append((metric, estado, anio, periodo, fecha, values.get(periodo), total, row))
    # The empty block is skipped; column 4 has no period, so its year is not carried on.
    assert got == sorted(expected, key=repr)


def test_grid_order_does_not_matter_and_sheets_stay_apart(spark, rows):
    both = cells(spark, GRID).unionByName(cells(spark, {**GRID, (7, 0): "C"}, "t"))
    long = reshape.grid_to_long(both, title_rows=(7, 11, 15), n=3)
    assert rows(long.filter("source = 's'")) == rows(reshape.grid_to_long(cells(spark, GRID).orderBy(F.rand(1)), (7, 11, 15), 3))
    assert {r[0] for r in long.filter("source = 't'").select("estado").collect()} == {"C", "B", "A"}


def test_grid2(spark, rows):
    grid = {
        (0, 2): "Segundo trimestre del 2025", (0, 3): "Segundo trimestre del 2025", (1, 2): "Hombre", (1, 3): "Mujer",
        (2, 0): "Con acceso", (2, 1): "A", (2, 2): "5", (2, 3): "x", (3, 0): "Sin acceso", (3, 1): "A", (3, 3): "7",
    }
    got = reshape.tidy_health(reshape.grid2_to_long(cells(spark, grid)))
    assert list(reshape.HEALTH_COLUMNS) == got.columns
    assert rows(got, "acceso_salud", "sexo", "periodo", "fecha_fin_trimestre", "valor") == sorted([
        ("Con acceso", "Hombre", "2025Q2", date(2025, 6, 30), 5.0), ("Con acceso", "Mujer", "2025Q2", date(2025, 6, 30), None),
        ("Sin acceso", "Mujer", "2025Q2", date(2025, 6, 30), 7.0),
    ], key=repr)


def test_pivot_and_melt_are_inverse(spark, rows):
    long = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("b", 2021, 3.0)], "k string, y int, v double")
    wide = reshape.pivot_years(long, "k", "y", "v", [2020, 2021])
    back = reshape.melt(wide, ["k"], ["2020", "2021"])
    assert rows(back.select("k", F.col("name").cast("int"), "value")) == rows(long)
    assert reshape.melt(wide, ["k"], ["2020", "2021"], keep_nulls=True).count() == 4


def test_zero_fill_keeps_the_flag(spark, rows):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, 5.0)], "i int, valor double")
    assert rows(reshape.zero_fill(df)) == [(1, 0.0, True), (2, 0.0, False), (3, 5.0, False)]


# --- schema --------------------------------------------------------------------------


def test_names_and_requirements(spark):
    df = spark.createDataFrame([(1, 2)], ["ï»¿estado", " b "])
    assert schema.clean_names(df).columns == ["estado", "b"]
    assert schema.clean_names(df, first="Fecha").columns == ["Fecha", "b"]
    assert schema.resolve(df, " B ") == " b " and schema.resolve(df, "zz") is None
    with pytest.raises(ValueError, match="zz"):
        schema.require(df, ["zz", " b "])


def test_union_does_not_depend_on_order(spark, rows):
    a = spark.createDataFrame([("1", "x")], "b string, anio string")
    c = spark.createDataFrame([("2", "y")], "C string, a string")
    one, other = schema.union_by_name([a, c]), schema.union_by_name([c, a])
    assert one.columns == other.columns == ["anio", "a", "b", "C"]
    assert rows(one) == rows(other) and one.count() == 2


def test_unique_names_in_a_large_group(spark):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("path"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("stem"), F.lit("t").alias("tag"))
    named = schema.unique_names(df, "path", "stem", "tag")
    names = {r["name"] for r in named.filter("stem = 'hot'").collect()}
    assert named.count() == n and names == {"hot__t.csv"} | {f"hot__t__{i}.csv" for i in range(2, 2001)}


# --- aggregates and filters ------------------------------------------------------------


def test_to_quarterly(spark, rows):
    monthly = spark.createDataFrame(
        [("2024-01-01", 1.0), ("2024-02-01", 2.0), ("2024-08-01", None), ("2024-12-31", 5.0), (None, 9.0)], "d string, v double"
    ).withColumn("d", F.col("d").cast("date"))
    got = rows(aggregates.to_quarterly(monthly, "d", {"v": "ISR"}))
    assert sorted(got) == [(date(2024, 3, 31), 3.0, 2), (date(2024, 6, 30), 0.0, 0), (date(2024, 9, 30), 0.0, 1), (date(2024, 12, 31), 5.0, 1)]
    assert aggregates.to_quarterly(monthly, "d", ["v"], complete_only=True).count() == 0
    unfilled = aggregates.to_quarterly(monthly, "d", ["v"], fill=None).filter("month(fecha) = 6")
    assert unfilled.first()["v"] is None


def test_reference_period(spark):
    def chosen(*values):
        return filters.reference_period(spark.createDataFrame([(v,) for v in values], "periodo string")).first()[0]

    assert chosen("T1", "Anual", "T4") == "T4" and chosen("Anual", "12 Meses", "T1", "T1") == "12 Meses"
    assert chosen("Anio", "Año", "x") == "Año" and chosen("b", "a", "b", "a", "c") == "a" and chosen("b", "b", "a", None) == "b"


def test_single_partner_and_counts(spark, rows):
    df = spark.createDataFrame([("m", "i"), ("m", "i"), ("n", "i"), ("n", "j"), (None, "k"), ("o", None)], "a string, b string")
    assert rows(aggregates.single_partner(df, "a", "b")) == [("m", "i", 1)]
    assert rows(aggregates.single_partner(df, "b", "a")) == [("j", "n", 1)]
    assert rows(aggregates.null_counts(df, ["a", "b"])) == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in aggregates.value_counts(df, "b", 2, dropna=False).collect()] == [("i", 3), ("j", 1)]
    assert rows(aggregates.pair_counts(df, "a", "b"))[0] == ("m", "i", 2)


# --- profiles against brute force ------------------------------------------------------


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 2.0, 2.0], [1.0, 2.0], [5.0, 1.0, 1e12, -3.0, 2.5], [float(i % 7) for i in range(500)], [float((i * 7919) % 1000) / 3 for i in range(1001)],
])
def test_exact_quantiles(spark, values):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = profile.exact_quantiles(df, ["x"], probs).first()["quantiles"]
    assert got == pytest.approx(np.quantile(values, probs).tolist(), rel=1e-12, abs=1e-12)


def test_describe_and_modes_against_pandas(spark):
    import pandas as pd

    data = pd.DataFrame({"a": [1.0, 2.0, 2.0, 3.0, 3.0, 9.0], "b": [None, 4.0, 4.0, 5.0, None, 7.5]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in data.itertuples(index=False)], "a double, b double")
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        d = data[c].describe()
        assert list(got[c])[1:] == pytest.approx([d["count"], d["mean"], d["std"], d["min"], d["25%"], d["50%"], d["75%"], d["max"]])
    centre = {r["column"]: r for r in profile.center_stats(df, ["a", "b"], 1).collect()}
    assert centre["a"]["modes"] == [2.0] and centre["b"]["modes"] == [4.0]
    assert {r["column"]: r["modes"] for r in profile.center_stats(df, ["a", "b"]).collect()} == {"a": [2.0, 3.0], "b": [4.0]}


def test_temporal_profile(spark):
    days = ["2024-01-01", "2024-01-01", "2024-01-11", "2024-01-31", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.col("d").cast("date"))
    assert tuple(profile.temporal_profile(df, "d").first()) == (date(2024, 1, 1), date(2024, 1, 31), 4, 10)
    assert profile.temporal_profile(df.limit(1), "d").first()["median_gap_days"] is None


# --- series ----------------------------------------------------------------------------


def panel(spark):
    ends = [date(y, m, 31 if m in (3, 12) else 30) for y in (2020, 2021, 2022) for m in (3, 6, 9, 12)]
    return spark.createDataFrame([(d, float(i + 1), 0.0 if i == 0 else 2.0) for i, d in enumerate(ends)], "fecha date, a double, b double")


def test_yoy_is_keyed_by_date(spark, rows):
    whole = panel(spark)
    gap = whole.filter("fecha <> date'2020-09-30'")
    growth = {r["fecha"]: r for r in series.yoy(gap, ["a", "b"]).collect()}
    assert len(growth) == 7 and date(2021, 9, 30) not in growth
    assert growth[date(2021, 6, 30)]["a_yoy"] == pytest.approx(6 / 2 - 1)
    assert growth[date(2021, 3, 31)]["b_yoy"] is None


def test_index_and_peak(spark):
    first = series.base100(panel(spark), ["a", "b"]).orderBy("fecha").first()
    assert first["a_idx"] == 100.0 and first["b_idx"] is None
    top = series.pct_of_max(panel(spark).withColumn("e", F.lit("x")), "a", ["e"]).agg(F.max("pct_of_max"), F.min("pct_of_max")).first()
    assert top[0] == 100.0 and top[1] == pytest.approx(100 / 12)


def test_deflation_prefers_the_level_table(spark, rows):
    columns = "estado string, anio int, periodo string, metric string, valor double, title_row int"
    wages = spark.createDataFrame(
        [("A", 2020, "T1", "Millones de pesos a precios corrientes", 50.0, 7), ("A", 2020, "T2", "Millones de pesos a precios corrientes", None, 7),
         ("B", 2020, "T1", "Millones de pesos a precios corrientes", 9.0, 7), ("A", 2020, "T1", "Participación", 1.0, 41)], columns)
    prices = spark.createDataFrame(
        [("A", 2020, "T1", "Variación porcentual del índice de precios implícitos", 3.0, 279), ("A", 2020, "T1", "Índice de precios implícitos base 2018=100", 125.0, 245),
         ("A", 2020, "T2", "INDICE DE PRECIOS IMPLICITOS", 110.0, 245), ("B", 2020, "T1", "Índice de precios implícitos", 0.0, 245)], columns)
    out = series.add_deflated(wages, prices)
    assert out.count() == 5
    real = out.filter(F.col("metric") == series.REAL_METRIC).collect()
    assert [(r["estado"], r["periodo"], r["valor"]) for r in real] == [("A", "T1", 40.0)]


# --- labels ------------------------------------------------------------------------------


def dictionary(spark):
    category = "array<struct<valor:string,categoria:string,casos:string,porcentaje:string>>"
    return spark.createDataFrame(
        [
            ("COE2T224", "p1", [("1", "old", "", ""), ("2", "two", "", ""), ("a", "lower", "", ""), (" ", "blank", "", ""), ("3", " ", "", "")], "f1", 0),
            ("COE2T424", "P1", [("01", "new", "", "")], "f2", 0),
            ("COE2T424", "p1", [("7", "first", "", ""), ("7", "last", "", "")], "f2", 1),
            ("COE2T424", "empty", [], "f2", 2),
            ("COE2T424", "absent", [("1", "x", "", "")], "f2", 3),
            ("COE2T424", "miss", [("zz", "never", "", "")], "f2", 4),
            ("SDEMT424", "p1", [("1", "other base", "", "")], "f3", 0),
        ],
        f"tabla string, variable string, categorias {category}, file_ord string, row_ord int",
    )


def coded(spark):
    values = [" 1 ", "01", "001", "2", "a", "A", "-1", "7", None, "", "9"]
    return spark.createDataFrame([(i, v, "q", "e") for i, v in enumerate(values)], "i int, P1 string, miss string, empty string")


def test_many_long_lists_are_one_join(spark):
    names = ["v1", "v2", "v3", "v4"]
    rows = [(f"SDEMT124", v, [(str(k), f"{v} is {k}", "", "") for k in range(300)]) for v in names]
    merged = labels.merge_dictionary(spark.createDataFrame(rows, "tabla string, variable string, categorias array<struct<valor:string,categoria:string,casos:string,porcentaje:string>>"))
    codes = [[None, "1", "01", " 7", "x", "299", "300", "0007", ""][(i * (k + 2)) % 9] for i in range(500) for k in range(4)]
    df = spark.createDataFrame([(i, *codes[4 * i : 4 * i + 4]) for i in range(500)], "_c0 long, v1 string, v2 string, v3 string, v4 string")
    joined, mapped = labels.apply_labels(df, merged, "SDEMT"), labels.apply_labels(df, merged, "SDEMT", map_codes=10_000)
    assert sorted(joined.columns) == sorted(mapped.columns)
    order = sorted(mapped.columns)
    assert sorted(map(repr, joined.select(order).collect())) == sorted(map(repr, mapped.select(order).collect()))
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # of codes with the dictionary, and of the table with its labelled combinations


@pytest.mark.parametrize("map_codes", [256, 0])
def test_labels(spark, map_codes):
    merged = labels.merge_dictionary(dictionary(spark))
    out = labels.apply_labels(coded(spark), merged, "COE2T", map_codes=map_codes)
    assert sorted(out.columns) == sorted(["i", "P1", "miss", "empty", "P1_label", "miss_label"])
    assert [r["P1_label"] for r in out.orderBy("i").collect()] == ["new", "new", "new", "two", "lower", "lower", None, "last", None, None, None]
    again = labels.apply_labels(out, merged, "COE2T", map_codes=map_codes)
    assert sorted(map(tuple, again.select(*sorted(out.columns)).collect()), key=repr) == sorted(map(tuple, out.select(*sorted(out.columns)).collect()), key=repr)
    assert labels.apply_labels(coded(spark), merged, "NONE").columns == coded(spark).columns


def test_label_diagnostics(spark, rows):
    merged = labels.merge_dictionary(dictionary(spark))
    missing = labels.missing_variables(labels.dictionary_variables(dictionary(spark)), merged, coded(spark), "COE2T")
    assert rows(missing) == [("ABSENT", "not in table"), ("EMPTY", "no categories")]
    assert rows(labels.label_quality(coded(spark), merged, "COE2T")) == [("MISS", ["q"], ["ZZ", "zz"])]
    assert labels.label_quality(coded(spark), merged, "NONE").count() == 0


def test_nation_is_named_once():
    assert NATION.startswith("Estados Unidos")
