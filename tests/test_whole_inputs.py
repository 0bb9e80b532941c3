"""Cases that caps, prefixes, size switches or null keys would cut."""

import math

import pytest
from pyspark.sql import functions as F

from panelwright.functions import codes, text
from panelwright.operators import codebook, filters, joins, profile, regression, reshape, schema, series
from panelwright.sources import files, microdata, sniff


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("href, want", [
    ("../../../../../../y", "https://h/a/y"), ("../" * 9 + "y", "https://h/y"), ("../y", "https://h/a/b/c/d/e/f/y"), ("#top", "https://h/a/b/c/d/e/f/g/x.html?q=1#top"),
    ("x/./y", "https://h/a/b/c/d/e/f/g/x/y"), ("..", "https://h/a/b/c/d/e/f/"), (".", "https://h/a/b/c/d/e/f/g/"), ("?z", "https://h/a/b/c/d/e/f/g/x.html?z"),
    ("v?u=x/../y", "https://h/a/b/c/d/e/f/g/v?u=x/../y"), ("/r/../s#f", "https://h/s#f"), ("//k/p", "https://k/p"), ("http://o/a/../b", "http://o/a/../b"),
    ("", "https://h/a/b/c/d/e/f/g/x.html?q=1"),
])
def test_absolute_url(spark, href, want):
    assert one(spark, codebook.absolute_url(F.lit("https://h/a/b/c/d/e/f/g/x.html?q=1"), F.lit(href))) == want


def pages(spark, *html):
    return spark.createDataFrame([(i, "https://h/p", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_references_of_every_name_and_code_point(spark):
    html = "&euro; &#128512; &ccedil; &frac12; &#x1F600; &#0000065; &#55296; &#9999999; &bogus; &amp;lt; &LT;"
    got = codebook.decoded_pages(pages(spark, html)).select(codebook.strip_tags("_page").alias("t")).first()["t"]
    assert got == "€ 😀 ç ½ 😀 A &#55296; &#9999999; &bogus; &lt; <"


def test_links_that_are_not_closed(spark):
    got = codebook.anchors(pages(spark, "<a href=/1>one <a href='/2'>two</a><a href='/3'>three")).orderBy("pos").collect()
    assert [(r.href, r.text) for r in got] == [("/1", "one"), ("/2", "two"), ("/3", "three")]


def test_table_inside_a_cell(spark):
    html = """<h3>Categorías</h3><table><tr><th>Valor</th><th>Categoría</th></tr><tr><td>1</td><td>one <table><tr><td>in</td><td>ner</td></tr></table> end</td></tr>
    <tr><td>2</td><td>two</td></tr></table>"""
    got = codebook.categories(pages(spark, html)).first()["categorias"]
    assert [(c.valor, c.categoria) for c in got] == [("1", "one in ner end"), ("2", "two")]


def test_long_codes_and_compound_letters(spark):
    assert one(spark, codes.plain_code(F.lit("0" * 20 + "1" * 23))) == "1" * 23
    assert [one(spark, codes.plain_code(F.lit(c))) for c in ("-007", "-0", "000", "a")] == ["-7", "0", "0", "A"]
    assert one(spark, text.slugify(F.lit("ﬁn ½ Ａño Ĳ"))) == "fin_12_ano_ij"


def test_encoding_of_a_whole_sample(spark):
    cut = F.lit(bytearray(b"A,B\ncaf\xe9"))
    assert one(spark, sniff.sniff_encoding(cut, True)) == "cp1252"
    assert one(spark, sniff.sniff_encoding(cut, False)) == "utf-8"
    for end in (b"\xc3", b"\xe2\x82", b"\xf0\x9f\x98", b""):
        assert one(spark, sniff.sniff_encoding(F.lit(bytearray(b"abc" + end)), False)) == "utf-8"
    assert one(spark, sniff.sniff_encoding(F.lit(bytearray(b"\xe9abcdef")), False)) == "cp1252"


def test_whole_header_blank_line_and_blanks_in_paths(spark, tmp_path):
    folder = tmp_path / "enoe 2024 ñ"
    folder.mkdir()
    names = [f"COLUMN_{i:05d}" for i in range(20_000)]
    (folder / "SDEMT__x_2024_trim1.csv").write_text(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    (folder / "COE1__x_2024_trim1.csv").write_text("\n  \nA,per,A\n1,124,2\n")
    found = {r.module: r for r in files.manifest(spark, str(tmp_path)).collect()}
    assert found["SDEMT"].error is None and found["SDEMT"].header == names
    assert found["COE1T"].header == ["A", "per", "A"]
    table = microdata.read_micro_csv(spark, files.manifest(spark, str(tmp_path)).filter("module = 'COE1T'"))
    row = table.first().asDict()
    assert row["A"] == "1" and row["A_2"] == "2"


def test_extra_fields_and_quoted_line_ends_stay(spark, tmp_path):
    (tmp_path / "SDEMT__x_2024_trim1.csv").write_text('A,per\n"one\ntwo",124\n3,124,more\n')
    rows = microdata.read_micro_csv(spark, files.manifest(spark, str(tmp_path))).collect()
    assert sorted((r.A, r.irregular) for r in rows) == [("3", "3,124,more"), ("one\ntwo", None)]


def test_cutoff_and_years_come_from_the_caller_or_the_data(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 2023, DATE'2023-01-01', 1.0), ('a', 2026, DATE'2026-01-01', 2.0) AS t(k, anio, fecha, v)")
    assert filters.cutoff(rows).count() == 2 and filters.cutoff(rows, last="2024-12-31").count() == 1
    assert reshape.pivot_years(rows, "k", "anio", "v").columns == ["k", "2023", "2024", "2025", "2026"]


def test_null_groups_stay(spark):
    rows = spark.sql("SELECT * FROM VALUES (CAST(NULL AS STRING), 1.0), (NULL, 3.0), ('a', 5.0) AS t(g, v)")
    assert sorted(r.share_pct for r in series.share_of_total(rows, "v", ["g"]).collect()) == [25.0, 75.0, 100.0]
    assert sorted(r.pct_of_max for r in series.pct_of_max(rows, "v", ["g"]).collect()) == [100 / 3, 100.0, 100.0]
    names = spark.sql("SELECT * FROM VALUES ('p1', NULL, 't'), ('p2', NULL, 't'), ('p3', 's', NULL) AS t(path, stem, tag)")
    assert sorted(r.name for r in schema.unique_names(names, "path", "stem", "tag").collect()) == ["__t.csv", "__t__2.csv", "s__.csv"]


def test_repeated_totals_fail(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, 10.0) AS t(k, v)")
    totals = spark.sql("SELECT * FROM VALUES (1, 20.0), (1, 40.0) AS t(k, v)")
    with pytest.raises(Exception, match="more than one row"):
        joins.with_total(rows, totals, ["k"], "v").collect()


def test_one_rule_for_p_values_at_every_size(spark):
    tail, _ = regression._student_t()
    sizes = [999_999.0, 1_000_001.0, 1e8]
    got = [r.p for r in spark.createDataFrame([(2.0, n) for n in sizes], "t double, n double").select(tail("t", "n").alias("p")).collect()]
    normal = math.erfc(2 / math.sqrt(2))
    # The difference from the normal law shrinks as 1 / n, without a jump where a rule could have changed.
    assert all(0 < p - normal < 1 / n for p, n in zip(got, sizes)) and abs(got[0] - got[1]) < 1e-10


def test_column_of_nulls_has_center_stats(spark):
    rows = spark.sql("SELECT * FROM VALUES (1.0D, CAST(NULL AS DOUBLE)), (3.0D, NULL) AS t(a, b)")
    got = {r["column"]: r for r in profile.center_stats(rows, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["median"]) == (2, 2.0, 2.0)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["modes"]) == (0, None, None)


def test_quantiles_of_values_far_apart(spark):
    values = [i / 997 for i in range(2000)] + [1e200, 1e300, -1e300, 1e-300, 0.0, -0.5]
    got = profile.describe(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    ordered = sorted(values)

    def at(p):
        k = p * (len(ordered) - 1)
        low = ordered[int(k)]
        return low + (ordered[min(int(k) + 1, len(ordered) - 1)] - low) * (k - int(k))

    assert [got.q25, got.q50, got.q75] == pytest.approx([at(0.25), at(0.5), at(0.75)], rel=1e-12)
    odd = [float("nan"), float("inf"), float("-inf"), 1.0, 2.0, 3.0, 4.0]
    assert profile.describe(spark.createDataFrame([(v,) for v in odd], "v double"), ["v"]).first().q50 == 3.0
