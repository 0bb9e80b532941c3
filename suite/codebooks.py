"""Codebook extraction over page tables."""

from pyspark.sql import functions as F

from panelwright.operators import codebook
from suite.inputs import index_pages, part_pages, table


def _anchors(spark, sf):
    """Every link of the raw pages, made absolute."""
    found = codebook.anchors(table(spark, sf, "pages"))
    full = codebook.absolute_url(F.col("url"), F.col("href"))
    return found.select("page_id", "pos", "text", full.alias("link"))


def _links(spark, sf):
    return codebook.links(index_pages(spark, sf))


def _file_ids(spark, sf):
    return codebook.file_ids(index_pages(spark, sf).unionByName(part_pages(spark, sf)))


def _titles(spark, sf):
    title = F.regexp_extract("_page", "(?is)<title>(.*?)</title>", 1)
    split = codebook.split_title(F.concat(title, F.lit(" (T"), F.col("page_id").cast("string"), F.lit(") ")))
    return codebook.decoded_pages(table(spark, sf, "pages")).select(
        "page_id", F.md5(split["label"]).alias("label"), split["code"].alias("code"), F.md5(codebook.split_title(title)["label"]).alias("whole")
    )


def _overview(spark, sf):
    return codebook.overview(part_pages(spark, sf))


def _question(spark, sf):
    return codebook.question(part_pages(spark, sf))


def _sections(spark, sf):
    pages = part_pages(spark, sf)
    headings = {"definicion": codebook.DEFINITION_HEADINGS, "universo": codebook.UNIVERSE_HEADINGS, "fuente": codebook.SOURCE_HEADINGS}
    return codebook.sections(pages, headings).unpivot("page_id", list(headings), "section", "text").select("page_id", "text", "section")


def _categories(spark, sf):
    return codebook.categories(part_pages(spark, sf)).select("page_id", F.to_json("categorias").alias("json"), F.size("categorias").alias("n"))


def _codebook(spark, sf):
    return codebook.codebook(part_pages(spark, sf)).drop("categorias")


def _raw_codebook(spark, sf):
    """Pages that are not variable pages are kept with an error, not dropped."""
    return codebook.codebook(table(spark, sf, "pages")).select("url_variable", "etiqueta", "pregunta", "categorias_json", "error")


_CATS = """'[{"valor":"1","categoria":"' || p_brand || '","casos":"' || p_size || '","porcentaje":"50%"},{"valor":"2","categoria":"' || p_type || '","casos":"","porcentaje":""}]'"""
_QUESTION = "CASE p_partkey % 3 WHEN 0 THEN '¿Cuál es ' || p_name || ' ?' WHEN 1 THEN 'Marca ' || p_brand ELSE '' END"
_UNIVERSE = "CASE WHEN p_partkey % 2 = 0 THEN 'Tamaño ' || p_size ELSE '' END"
_URL = "'https://data.example.org/cat/index.php/catalog/9/variable/F1/V' || p_partkey || '?file_name=SDEMT124&name=P' || p_partkey"

QUERIES = {
    "page_anchors": (
        _anchors,
        r"""WITH a AS (SELECT page_id, url, html, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS text,
        generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">', 1), 1) AS i FROM pages)
        SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, text, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS link FROM a""",
    ),
    "variable_links": (
        _links,
        """SELECT o_orderkey AS page_id, 'v ' || o_orderkey AS name, 'https://data.example.org/cat/catalog/9/variable/F2/V1?name=v%20' || o_orderkey || '&x=1' AS link FROM orders
        UNION ALL SELECT o_orderkey, 'b', 'https://data.example.org/cat/variable/V3?name=b' FROM orders""",
    ),
    "file_ids": (_file_ids, "SELECT 'T' || o_orderkey AS file_name, 'F' || o_orderkey AS file_id FROM orders"),
    "split_title": (
        _titles,
        r"""WITH t AS (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_extract(html, '<title>((?:.|\n)*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS t FROM pages)
        SELECT page_id, md5(t) AS label, 'T' || page_id AS code, md5(t) AS whole FROM t""",
    ),
    "overview_table": (
        _overview,
        """SELECT p_partkey AS page_id, CAST(p_size AS VARCHAR) AS valido, '0' AS no_valido, 'Discreta' AS tipo, '0' AS decimales,
        CAST(length(p_name) AS VARCHAR) AS ancho, '' AS rango, '' AS formato FROM part""",
    ),
    "literal_question": (_question, f"SELECT p_partkey AS page_id, {_QUESTION} AS pregunta FROM part"),
    "category_rows": (_categories, f"SELECT p_partkey AS page_id, {_CATS} AS json, 2 AS n FROM part"),
    "section_text": (
        _sections,
        f"""SELECT p_partkey AS page_id, 'definicion' AS section, 'Parte ' || p_name || ' fin' AS text FROM part
        UNION ALL SELECT p_partkey, 'universo', {_UNIVERSE} FROM part UNION ALL SELECT p_partkey, 'fuente', 'CENSO ' || p_type FROM part""",
    ),
    "codebook": (
        _codebook,
        f"""SELECT 'SDEMT124' AS tabla, 'P' || p_partkey AS variable, p_name || ' & ' || p_type AS etiqueta, {_QUESTION} AS pregunta,
        CAST(p_size AS VARCHAR) AS valido, '0' AS no_valido, 'Discreta' AS tipo, '0' AS decimales, CAST(length(p_name) AS VARCHAR) AS ancho, '' AS rango, '' AS formato,
        'Parte ' || p_name || ' fin' AS definicion, {_UNIVERSE} AS universo, 'CENSO ' || p_type AS fuente, {_CATS} AS categorias_json, {_URL} AS url_variable, '' AS error FROM part""",
    ),
    "codebook_quarantine": (
        _raw_codebook,
        """SELECT url AS url_variable, '' AS etiqueta, '' AS pregunta, '[]' AS categorias_json, 'page has no title' AS error FROM pages""",
    ),
}
