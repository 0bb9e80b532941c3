import json

from panelwright.operators import codebook

FULL = """<html><head><script>document.write('<h2>bad (X)</h2>')</script></head><body><!-- <h2>no</h2> -->
<h2>Sexo &amp; <i>edad</i> (P1)</h2>
<h3>Vision general</h3><p>texto</p><table><tr><td>Válido</td><td>10</td></tr><tr><td>no válido</td><td>2</td></tr>
<tr><td>TIPO</td><td>Discreta</td></tr><tr><td>solo</td></tr><tr><td>Tipo</td><td>Continua</td></tr></table>
<h4>Preguntas e instrucciones</h4><div><strong>Pregunta literal</strong><p>&#191;Cu&#xe1;l es &lt;tu&gt; <b>sexo</b>?</p></div>
<h3>Categorías</h3><table><tr><th>Valor</th><th>Categoría</th></tr><tr><td>1</td><td>Hombre</td><td>5</td><td>50%</td></tr>
<tr><td>2</td><td>Mujer</td></tr><tr><td>Sysmiss</td><td></td></tr></table>
<h3>Definición</h3>Texto suelto <p>uno</p><table><tr><td>no</td></tr></table><div>dos</div><h3>Universe</h3><p>Todos</p>
<p><strong>Fuente</strong></p><p>Censo</p></body></html>"""
LOOSE = """<h2>Sin código</h2><table><tr><td>Formato</td><td>F2</td></tr></table>
<table><tr><td>Valor</td><td>Categoría</td></tr><tr><td>a</td><td>A</td></tr></table>
<span>Pregunta literal:</span><br>  <div>Universo de todos</div>"""


def pages(spark):
    base = "https://x.example/cat/1/variable/F2/V1"
    return spark.createDataFrame(
        [(1, f"{base}?name=P1&file_name=COE2T324", FULL), (2, base, LOOSE), (3, f"{base}?name=Z", None), (4, base, "")], "page_id bigint, url string, html string"
    )


def test_codebook(spark):
    book = codebook.codebook(pages(spark))
    assert book.columns == list(codebook.CODEBOOK_COLUMNS)
    got = {r["variable"] or r["url_variable"][-2:]: r for r in book.filter("error = ''").collect()}
    one = got["P1"]
    assert (one["tabla"], one["etiqueta"], one["valido"], one["no_valido"], one["tipo"], one["rango"]) == ("COE2T324", "Sexo & edad", "10", "2", "Continua", "")
    assert one["pregunta"] == "¿Cuál es <tu> sexo ?"
    assert [tuple(c) for c in one["categorias"]] == [("1", "Hombre", "5", "50%"), ("2", "Mujer", "", "")]
    assert json.loads(one["categorias_json"])[0]["categoria"] == "Hombre"
    assert one["definicion"] == "Texto suelto uno dos" and one["universo"].startswith("Todos") and one["fuente"] == "Censo"
    two = got["V1"]
    assert (two["etiqueta"], two["formato"], two["pregunta"], two["definicion"]) == ("Sin código", "F2", "", "")
    assert [c["valor"] for c in two["categorias"]] == ["a"]
    bad = book.filter("error <> ''").collect()
    assert len(bad) == 2 and all(r["etiqueta"] == "" and r["categorias"] == [] for r in bad)


def test_links(spark, rows):
    html = (
        "<a href='/variable/V1?name=a%20b'>x</a><a class='k' href=\"/variable/V2?x=1&amp;name=c\">y</a><a href='/variable/V3?name=c'>z</a>"
        "<a href='/variable/V4?name='>e</a><a href='/other?name=q'>o</a><a name='n'>no href</a>"
    )
    df = spark.createDataFrame([(1, "https://x.example/a/b", html)], "page_id bigint, url string, html string")
    assert rows(codebook.links(df)) == [(1, "a b", "https://x.example/variable/V1?name=a%20b"), (1, "c", "https://x.example/variable/V3?name=c")]


def test_absolute_url(spark):
    from pyspark.sql import functions as F

    base = "https://x.example/a/b/c?q=1#f"
    cases = {
        "d": "https://x.example/a/b/d", "./d": "https://x.example/a/b/d", "../d": "https://x.example/a/d", "../../d?x=1": "https://x.example/d?x=1",
        "/d": "https://x.example/d", "//y.example/d": "https://y.example/d", "?z=2": "https://x.example/a/b/c?z=2", "http://z/": "http://z/",
    }
    df = spark.createDataFrame(list(cases.items()), "href string, want string")
    assert [r for r in df.select("href", "want", codebook.absolute_url(F.lit(base), F.col("href")).alias("got")).collect() if r["got"] != r["want"]] == []


def test_file_ids(spark, rows):
    df = spark.createDataFrame(
        [
            (1, "https://x.example/data-dictionary/F7?file_name=T1", ""),
            (2, "https://x.example/", "<a href='/data-dictionary/F8?file_name=T1'>T1</a><a href='/data-dictionary/F9?file_name=T2'>T3</a>"),
        ],
        "page_id bigint, url string, html string",
    )
    assert rows(codebook.file_ids(df)) == [("T1", "F7"), ("T2", "F9"), ("T3", "F9")]


def test_heading_inside_a_table_is_text_of_its_cell(spark):
    html = "<h2>T (C)</h2><h3>Categorías</h3><table><tr><th>Valor</th><th>Categoría</th></tr><tr><td>1</td><td><h4>Universo</h4> one</td></tr><tr><td>2</td><td>two</td></tr></table><h3>Universo</h3>all"
    df = spark.createDataFrame([(1, "https://x.example/a", html)], "page_id bigint, url string, html string")
    got = codebook.codebook(df).first()
    assert [(c["valor"], c["categoria"]) for c in got["categorias"]] == [("1", "Universo one"), ("2", "two")] and got["universo"] == "all"


def test_links_are_decoded_where_their_page_is_not(spark, rows):
    html = "<p>caf&eacute; &amp; &notareference; <a href='/v?x=1&amp;n=&#233;'>caf&eacute; &lt;b&gt; &#x41;</a>"
    df = spark.createDataFrame([(1, "https://x.example/a", html), (2, "https://x.example/a", None)], "page_id bigint, url string, html string")
    assert rows(codebook.anchors(df)) == [(1, "https://x.example/a", 0, "/v?x=1&n=é", "café <b> A")]


def test_every_name_is_decoded(spark):
    from html.entities import html5

    names = sorted(n[:-1] for n in html5 if n.endswith(";") and not set(html5[n]) & set("<>&"))
    df = spark.createDataFrame([(i, "https://x.example/a", f"x&{n};y&{n}") for i, n in enumerate(names)], "page_id bigint, url string, html string")
    got = {r.page_id: r._page for r in codebook.decoded_pages(df).select("page_id", "_page").collect()}
    assert got == {i: f"x{html5[n + ';']}y&{n}" for i, n in enumerate(names)}
    # A look-up compares the names of one shelf.
    assert max(map(len, codebook._shelves())) < 32


def test_sections_from_one_parse(spark, rows):
    headings = {"definicion": codebook.DEFINITION_HEADINGS, "universo": codebook.UNIVERSE_HEADINGS, "fuente": codebook.SOURCE_HEADINGS}
    together = codebook.sections(pages(spark), headings)
    assert rows(together, "page_id", "universo") == rows(codebook.section(pages(spark), codebook.UNIVERSE_HEADINGS))
    assert rows(together.filter("page_id = 1")) == [(1, "Texto suelto uno dos", "Todos Fuente Censo", "Censo")]


def test_rows_and_cells_that_are_not_closed(spark):
    html = "<h3>Categorías</h3><table><tr><td>1<td>a <b>b</b> < c<tr><TD class=x>2</TD>\n<td></td></tr><trx><td>3</td><tdx>no</tdx><td>z</table><td>out</td>"
    df = spark.createDataFrame([(1, "https://x.example/a", html)], "page_id bigint, url string, html string")
    got = codebook.categories(df).first()["categorias"]
    assert [(c["valor"], c["categoria"], c["casos"]) for c in got] == [("1", "a b < c", ""), ("2", "", "3")]


def test_pages_of_a_small_file_are_dealt_out(spark, tmp_path):
    from suite.inputs import part_pages

    spark.sql("SELECT id AS p_partkey, 'n' AS p_name, 'b' AS p_brand, 't' AS p_type, 1 AS p_size FROM range(200)").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    sizes = part_pages(spark, str(tmp_path)).rdd.glom().map(len).collect()
    assert sum(sizes) == 200 and len(sizes) >= 4 * spark.sparkContext.defaultParallelism and max(sizes) <= 20
