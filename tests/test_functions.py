from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwright.functions import codes, periods, text


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("c")).collect()]


@pytest.mark.parametrize("rule, expected", [
    (periods.period_month, [3, 6, 9, 12, 6, 9, 12, 12, None, None, None, 3]),
    (periods.period_month_exact, [3, 12, 12, 12, 6, 9, 12, 12, 12, 12, 12, 12]),
    (periods.period_month_loose, [3, 12, 12, 12, 12, 12, 12, 12, 12, 12, 12, 12]),
])
def test_three_period_rules(spark, rule, expected):
    values = ["T1", " t2", "3er Trim", "4º", "6 Meses", "9 Meses", "Anual", "Año", "12 Meses", "", None, "1er trimestre"]
    assert apply(spark, rule, values) == expected


def test_cumulative_flag(spark):
    assert apply(spark, periods.is_cumulative, ["T1", "6 Meses", "Anual", "x", None]) == [False, True, True, False, False]


def test_years_and_quarter_texts(spark):
    assert apply(spark, periods.clean_year, ["2018R", "2019p", " 12 ", "", None, "a20201"]) == [2018, 2019, None, None, None, 2020]
    texts = ["Segundo trimestre del 2025", " Cuarto trimestre del 1999 ", "Quinto del año", "", None]
    assert apply(spark, periods.quarter_from_text, texts) == [2, 4, None, None, None]
    assert apply(spark, periods.year_from_text, texts) == [2025, 1999, None, None, None]


def test_dates_never_raise(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 4), (2024, 13), (None, 1), (2024, None)], "y int, q int")
    got = [tuple(r) for r in df.select(
        periods.quarter_end("y", "q"), periods.month_end("y", "q"), periods.month_start("y", "q"), periods.quarter_label("y", "q")
    ).collect()]
    assert got[0] == (date(2024, 3, 31), date(2024, 1, 31), date(2024, 1, 1), "2024Q1")
    assert got[1] == (date(2024, 12, 31), date(2024, 4, 30), date(2024, 4, 1), "2024Q4")
    assert got[2][:3] == (None, None, None)
    assert got[3] == (None, None, None, None) and got[4] == (None, None, None, None)


def test_text_dates(spark):
    assert apply(spark, periods.excel_or_text_date, ["45657", "45657.5", "2024-12-31", "x", None]) == [
        date(2024, 12, 31), date(2024, 12, 31), date(2024, 12, 31), None, None
    ]
    first = lambda c: periods.parse_date(c, dayfirst=True)
    assert apply(spark, first, ["05/04/2024", "2024-04-05", "31/31/2024", "", None]) == [date(2024, 4, 5), date(2024, 4, 5), None, None, None]
    assert apply(spark, periods.parse_date, ["05/04/2024"]) == [date(2024, 5, 4)]


def test_names_and_codes(spark):
    assert apply(spark, codes.module_of, ["SDEMT__x.csv", "coe1_x", "COE2", "vivt_COE1T", "other", None]) == [
        "SDEMT", "COE1T", "COE2T", "VIVT", None, None
    ]
    names = ["SDEMT__x_2024_trim1.csv", "COE1__x_2024_trim1__2.csv", "a_2024_TRIM3", "other.csv", None]
    year = apply(spark, lambda c: codes.yq_from_name(c)[0], names)
    quarter = apply(spark, lambda c: codes.yq_from_name(c)[1], names)
    assert year == [2024, None, 2024, None, None] and quarter == [1, None, 3, None, None]
    per = ["124", "24", "", "p-305", None]
    assert apply(spark, lambda c: codes.yq_from_per(c)[0], per) == [2024, 2024, 2000, 2005, None]
    assert apply(spark, lambda c: codes.yq_from_per(c)[1], per) == [1, 0, 0, 3, None]
    assert apply(spark, lambda c: codes.digit_key(c, 2), ["1", "01", " 7-", "1234", "", None]) == ["01", "01", "07", "1234", "00", None]


def test_table_codes(spark):
    got = apply(spark, codes.table_code, ["COE2T424", "coe1324", " sdem124 ", "HOGT", "x-1", None])
    assert [tuple(g) for g in got] == [
        ("COE2T", 4, 24, 20244), ("COE1T", 3, 24, 20243), ("SDEMT", 1, 24, 20241), ("HOGT", 0, 0, 20000), ("X1", 0, 0, 20000), ("", 0, 0, 20000)
    ]


def test_code_variants(spark):
    values = [" 1 ", "01", "001", "a", "A", "-1", "0", "100", "0100", "", "  ", None]
    assert apply(spark, codes.code_variants, values) == [
        ["1", "01"], ["01", "1"], ["001", "1", "01"], ["a", "A"], ["A"], ["-1"], ["0", "00"], ["100"], ["0100", "100"], [], [], []
    ]


def test_text_cleaning(spark):
    assert apply(spark, text.slugify, ["Índice de volumen físico base 2018=100", "  ¡Año! ", "", None]) == [
        "indice_de_volumen_fisico_base_2018_100", "ano", "", ""
    ]
    assert apply(spark, codes.safe_name, [" a b/ñ.csv ", "x__y-1.2"]) == ["a_b_.csv", "x__y-1.2"]
    assert apply(spark, text.squeeze, ["  a \n\t b ", ""]) == ["a b", ""]
    assert apply(spark, text.norm_header, ["﻿CVE  ENT ", None]) == ["cve ent", ""]


def test_mojibake(spark):
    broken = ["Índice".encode().decode("latin-1"), "VariaciÃ³n", "Índice – guion", "año", "plain", None]
    assert apply(spark, text.fix_mojibake, broken) == ["Índice", "Variación", "Índice – guion", "año", "plain", None]
    assert apply(spark, text.decode_cp1252, ["\x93a\x94 \x81"]) == ["“a” \x81"]


def test_numbers_and_labels(spark):
    assert apply(spark, text.to_double, ["1.5", " 2 ", "x", "", None]) == [1.5, 2.0, None, None, None]
    assert apply(spark, text.unit_class, ["Millones de pesos", "Unidades", "Índice x", "otro", None]) == ["money", "count", "index", "other", "other"]
    assert apply(spark, lambda c: text.metric_like(c, "índice"), ["INDICE a", "Índice", "x", None]) == [True, True, False, False]
    assert apply(spark, text.is_national, [text.NATION, "x", None]) == [True, False, False]
    assert apply(spark, text.fmt_money, [1234567.4], "double") == ["$1,234,567"]
    assert apply(spark, text.fmt_pct, [12.345, None], "double")[0] == "12.3%"
    assert apply(spark, text.fmt_count, [1e9], "double") == ["1,000,000,000"]
