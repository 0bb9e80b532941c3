"""Variable codebooks from tables of HTML pages (page_id, url, html).

Everything stays inside the JVM. A page is cut once into sections, before each heading,
and a section into parts, at both ends of its tables. Titles, tables, questions and
section texts are slices of those, so the patterns that take them apart see a few hundred
characters and not the page.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.text import squeeze
from panelwright.operators.joins import keep_first

# References that would look like markup, decoded after tags are gone.
MARKUP_ENTITIES = (("lt", "<"), ("gt", ">"), ("amp", "&"))


def _references() -> dict[str, str]:
    # Rule: the names that HTML defines; markup characters stay in named form for now.
    found = {}
    for name, text in html5.items():
        if name.endswith(";"):
            for reference, char in reversed(MARKUP_ENTITIES):
                text = text.replace(char, f"&{reference};")
            found[name[:-1]] = text
    return found


ENTITIES = _references()
# The names are dealt out by checksum, so that a look-up compares a few of them and not all.
SHELVES = 256


def _shelves() -> list[dict[str, str]]:
    shelves = [{} for _ in range(SHELVES)]
    for name, text in ENTITIES.items():
        shelves[crc32(name.encode()) % SHELVES][name] = text
    return shelves


# Attributes of the overview table: output column, label shown, accepted spelling.
OVERVIEW_ATTRIBUTES = (
    ("valido", "Válido", r"(?iu)^válido$"),
    ("no_valido", "No válido", r"(?iu)^no\s+válido$"),
    ("tipo", "Tipo", r"(?i)^tipo$"),
    ("decimales", "Decimal", r"(?i)^decimal(es)?$"),
    ("ancho", "Ancho", r"(?i)^ancho$"),
    ("rango", "Rango", r"(?i)^rango$"),
    ("formato", "Formato", r"(?i)^formato$"),
)
# Headings of the sections.
OVERVIEW_HEADINGS = ("Visión general", "Vision general")
CATEGORY_HEADINGS = ("Categorías", "Categories")
DEFINITION_HEADINGS = ("Definición", "Definition")
UNIVERSE_HEADINGS = ("Universo", "Universe")
SOURCE_HEADINGS = ("Source of information", "Fuente de información", "Fuente")
QUESTION_HEADING = "Preguntas e instrucciones"
QUESTION_LABEL = r"(?i)pregunta\s+literal"
OTHER_SECTIONS = r"(?iu)^(categorías|categories|contexto|descripción|definición|universo|source|fuente)\b"
# First cells of rows that are not categories.
NOT_CATEGORIES = ("valor", "sysmiss")
# Output columns of the codebook, in order.
CODEBOOK_COLUMNS = (
    "tabla", "variable", "etiqueta", "pregunta", "valido", "no_valido", "tipo", "decimales", "ancho", "rango",
    "formato", "definicion", "universo", "fuente", "categorias", "categorias_json", "url_variable", "error",
)
CATEGORY_TYPE = "array<struct<valor:string,categoria:string,casos:string,porcentaje:string>>"

HEADING = r"(?is)<(h[234])\b[^>]*>(.*?)</\1\s*>"
# Where a page is cut into sections, and a section into parts.
SECTION, PART = r"(?i)(?=<h[234]\b)", r"(?i)(?=</?table\b)"
# A page with a table or a heading inside a table, and the tags that what is inside loses, so that it is text of the cell that holds it.
NESTED = r"(?i)<table\b(?>[^<]|<(?!/?table\b|h[234]\b))*+<(?:table|h[234])\b"
INNER, INNER_HEADING = r"(?is)</?(?:table|thead|tbody|tfoot|tr|td|th)\b[^>]*>", r"(?is)</?h[234]\b[^>]*>"
REFERENCE = r"^(#0*\d{1,7}|#[xX]0*[0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]*);"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_html(c: Column | str) -> Column:
    """The page without comments, scripts and styles, whose text could look like tags."""
    return F.regexp_replace(_col(c), r"(?is)<(?:!--.*?-->|(script|style)\b.*?</\1\s*>)", " ")


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that a lambda inside it reads many times and that is to be computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _decoded(text: Column) -> Column:
    """Named and numeric references as characters; those of < > & stay, in named form."""
    # No name or text holds these two characters.
    entry, pair = F.lit("\x01"), F.lit("\x02")
    shelves = F.array(*[F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in shelf.items())), entry, pair) for shelf in _shelves()])

    def named(ref: Column) -> Column:
        return F.try_element_at(F.get(shelves, F.pmod(F.crc32(ref.cast("binary")), F.lit(SHELVES)).cast("int")), ref)

    def numbered(ref: Column) -> Column:
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.regexp_replace(ref, "^#[xX]", ""), 16, 10)).otherwise(F.conv(F.substring(ref, 2, 40), 10, 10)).cast("long")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        markup = F.when(number == 0x3C, "&lt;").when(number == 0x3E, "&gt;").when(number == 0x26, "&amp;")
        return F.when(valid, F.coalesce(markup, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")))

    def written(piece: Column) -> Column:
        def of(ref: Column) -> Column:
            char = F.when(ref == "", F.lit(None).cast("string")).when(ref.startswith("#"), numbered(ref)).otherwise(named(ref))
            return F.coalesce(F.concat(char, F.substring(piece, F.length(ref) + 2, F.length(piece))), F.concat(F.lit("&"), piece))

        return _once(F.regexp_extract(piece, REFERENCE, 1), of)

    def joined(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), written), ""))

    return _once(text, lambda t: F.when(t.contains("&"), _once(F.split(t, "&"), joined)).otherwise(t))


def decoded_pages(pages: DataFrame) -> DataFrame:
    """Adds ``_page``: cleaned, with every reference but those of < > & decoded."""
    return pages.withColumn("_page", _decoded(clean_html("html")))


def plain_markup(c: Column) -> Column:
    """< > & written out, once tags are gone."""
    for name, char in MARKUP_ENTITIES:
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    return c


def strip_tags(c: Column | str) -> Column:
    """Text of a decoded fragment: tags become blanks, blanks are squeezed."""
    return squeeze(plain_markup(F.regexp_replace(_col(c), "<[^>]*>", " ")))


def _flat_tables(page: Column) -> Column:
    """A page whose tables hold no heading and no table: what they hold is plain text of their cells."""
    def step(acc: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)^<table\b"), piece.rlike(r"(?i)^</table\b")
        before = acc["depth"]
        depth = F.when(opens, before + 1).when(closes, F.greatest(before - 1, F.lit(0))).otherwise(before)
        text = (
            F.when(depth >= 2, F.regexp_replace(piece, INNER, " "))
            .when(closes & (before >= 2), F.regexp_replace(piece, r"(?i)^</table\b[^>]*>", " "))
            .otherwise(piece)
        )
        return F.struct(depth.alias("depth"), F.array_append(acc["parts"], F.when(depth >= 1, F.regexp_replace(text, INNER_HEADING, " ")).otherwise(text)).alias("parts"))

    begin = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("parts"))
    flat = F.aggregate(F.split(page, PART), begin, step, lambda acc: F.array_join(acc["parts"], ""))
    return F.when(page.rlike(NESTED), flat).otherwise(page)


def _sections(page: Column) -> Column:
    """array of (level, name, parts): what a page holds before its first heading and from each one to the next."""
    def section(piece: Column) -> Column:
        name = F.lower(squeeze(F.regexp_replace(F.regexp_extract(piece, "^" + HEADING, 2), "<[^>]*>", " ")))
        return F.struct(F.substring(piece, 3, 1).alias("level"), name.alias("name"), F.split(piece, PART).alias("parts"))

    return F.transform(F.split(page, SECTION), section)


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Adds ``_sections`` of the decoded page, in which tables hold neither tables nor headings."""
    flat = decoded_pages(pages).withColumn("_page", _flat_tables(F.col("_page")))
    return flat.withColumn("_sections", _sections(F.col("_page"))).drop("_page")


def _named(section: Column, names: Sequence[str]) -> Column:
    return reduce(lambda out, name: out | section["name"].contains(name.lower()), names, F.lit(False))


def _from_first(sections: Column, test: Callable[[Column], Column]) -> Column:
    """The sections from the first that passes a test; null without one."""
    def tail(all_: Column) -> Column:
        at = F.array_position(F.transform(all_, test), F.lit(True)).cast("int")
        return _once(at, lambda i: F.when(i > 0, F.slice(all_, F.greatest(i, F.lit(1)), F.size(all_))))

    return _once(sections, tail)


def _first(sections: Column, test: Callable[[Column], Column]) -> Column:
    return F.get(F.filter(sections, test), F.lit(0))


def _is_table(part: Column) -> Column:
    return F.lower(F.substring(part, 1, 6)) == "<table"


def _tables(sections: Column) -> Column:
    return F.filter(F.flatten(F.transform(sections, lambda s: s["parts"])), _is_table)


def _first_table(names: Sequence[str]) -> Column:
    """The first table behind a heading that contains one of the names."""
    return F.get(_tables(_from_first(F.col("_sections"), lambda s: _named(s, names))), F.lit(0))


def table_rows(table: Column) -> Column:
    """array<array<string>>: the data cells of every row that has two or more."""
    rows = F.regexp_extract_all(table, F.lit(r"(?i)<tr\b[^<]*+(?:<(?!tr\b|/table)[^<]*+)*+"), 0)
    cells = F.transform(
        rows, lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?i)<td\b[^>]*>([^<]*+(?:<(?!/?td\b|/td|/tr|/table)[^<]*+)*+)"), 1), strip_tags
        )
    )
    return F.filter(cells, lambda cs: F.size(cs) >= 2)


def _overview_rows() -> Column:
    def has_label(table: Column) -> Column:
        shown = [name for _, name, _ in OVERVIEW_ATTRIBUTES]
        return _once(strip_tags(table), lambda text: reduce(lambda out, name: out | text.contains(name), shown, F.lit(False)))

    any_table = F.get(F.filter(_tables(F.col("_sections")), has_label), F.lit(0))
    return table_rows(F.coalesce(_first_table(OVERVIEW_HEADINGS), any_table))


def _overview_values(rows: Column) -> list[Column]:
    def value(pattern: str) -> Column:
        # A repeated label: the last row counts.
        found = F.filter(rows, lambda cs: F.get(cs, F.lit(0)).rlike(pattern))
        return F.coalesce(F.get(F.try_element_at(found, F.lit(-1)), F.lit(1)), F.lit(""))

    return [value(pattern).alias(name) for name, _, pattern in OVERVIEW_ATTRIBUTES]


def overview(pages: DataFrame) -> DataFrame:
    """The seven overview attributes of each page, '' where it has none."""
    rows = parsed_pages(pages).withColumn("_rows", _overview_rows())
    return rows.select("page_id", *_overview_values(F.col("_rows")))


def _question_part() -> Column:
    """From the end of the question label to the next heading."""
    sections = F.col("_sections")
    scope = F.coalesce(_from_first(sections, lambda s: _named(s, [QUESTION_HEADING])), sections)
    labelled = _first(F.transform(scope, lambda s: F.array_join(s["parts"], "")), lambda html: html.rlike(QUESTION_LABEL))
    label = "(?s)" + QUESTION_LABEL + r"\s*:?\s*(?:</[^>]+>\s*)*(.*)$"
    return F.coalesce(F.regexp_extract(labelled, label, 1), F.lit(""))


def _question_texts(part: Column) -> Column:
    """Texts of the elements and bare text nodes of a fragment, in order."""
    element = r"(?is)<(p|div|span|td|li|strong|b|em|i)\b[^>]*>.*?</\1\s*>|<[^>]*>|[^<]+"
    texts = F.transform(F.regexp_extract_all(part, F.lit(element), 0), strip_tags)
    return F.filter(texts, lambda t: (t != "") & ~t.rlike("^" + QUESTION_LABEL) & ~t.rlike(r"^[:.\s]+$"))


def _question_value(texts: Column) -> Column:
    first = F.get(texts, F.lit(0))
    return F.when(first.isNull() | first.rlike(OTHER_SECTIONS), "").otherwise(first)


def question(pages: DataFrame) -> DataFrame:
    """The first text after the 'Pregunta literal' label, before the next heading or section."""
    part = parsed_pages(pages).withColumn("_part", _question_part())
    return part.withColumn("_texts", _question_texts(F.col("_part"))).select(
        "page_id", _question_value(F.col("_texts")).alias("pregunta")
    )


def _category_rows() -> Column:
    def is_category_table(table: Column) -> Column:
        head = F.regexp_extract_all(table, F.lit(r"(?is)<th\b[^>]*>(.*?)</th"), 1)
        first_row = F.regexp_extract_all(F.regexp_extract(table, r"(?is)<tr\b.*?</tr", 0), F.lit(r"(?is)<td\b[^>]*>(.*?)</td"), 1)
        cells = F.transform(F.when(F.size(head) > 0, head).otherwise(first_row), lambda t: F.lower(strip_tags(t)))
        return F.exists(cells, lambda t: t.contains("valor")) & F.exists(cells, lambda t: t.contains("categor"))

    any_table = F.get(F.filter(_tables(F.col("_sections")), is_category_table), F.lit(0))
    return table_rows(F.coalesce(_first_table(CATEGORY_HEADINGS), any_table))


def _category_structs(rows: Column) -> Column:
    kept = F.filter(rows, lambda cs: ~F.lower(F.get(cs, F.lit(0))).isin(*NOT_CATEGORIES))
    names = ("valor", "categoria", "casos", "porcentaje")
    found = F.transform(
        kept, lambda cs: F.struct(*[F.coalesce(F.get(cs, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)])
    )
    return F.coalesce(found, F.array().cast(CATEGORY_TYPE))


def categories(pages: DataFrame) -> DataFrame:
    """array of (valor, categoria, casos, porcentaje) per page; short rows are padded with ''."""
    rows = parsed_pages(pages).withColumn("_rows", _category_rows())
    return rows.select("page_id", _category_structs(F.col("_rows")).alias("categorias"))


# Fixed pattern: a title that ends in a code.
TITLE_CODE = r"^(.*)\(([^)]+)\)\s*$"


def split_title(c: Column | str) -> Column:
    """``Label (CODE)`` of a decoded page -> struct(label, code); without a code all is label."""
    text = strip_tags(_col(c))
    pattern = TITLE_CODE
    return _once(text, lambda t: F.struct(
        F.trim(F.when(t.rlike(pattern), F.regexp_extract(t, pattern, 1)).otherwise(t)).alias("label"),
        F.regexp_extract(t, pattern, 2).alias("code"),
    ))


def _prose(section: Column) -> Column:
    return F.array_join(F.filter(section["parts"], lambda p: ~_is_table(p)), " ")


def _section_text(name: str) -> Column:
    """Text of the section under the first heading with this name, or after a bold label; tables and lists are left out."""
    sections = F.col("_sections")
    own = F.regexp_replace(_prose(_first(sections, lambda s: _named(s, [name]))), "^" + HEADING, "")
    label = rf"(?isu)<strong\b[^>]*>[^<]*{name}[^<]*</strong\s*>"
    behind = _first(F.transform(sections, _prose), lambda html: html.rlike(label))
    bold = F.regexp_extract(behind, label + r"\s*(?:</[^>]+>)?(.*?)(?=<strong\b|$)", 1)
    prose = F.regexp_replace(F.coalesce(own, bold), r"(?is)<(ul|ol|dl)\b.*?</\1\s*>", " ")
    return F.coalesce(strip_tags(prose), F.lit(""))


def _section_value(names: Sequence[str]) -> Column:
    # The first text that is not empty counts; later names are not looked for then.
    return F.coalesce(*[_once(_section_text(n), lambda t: F.nullif(t, F.lit(""))) for n in names], F.lit(""))


def sections(pages: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Paragraph text from a heading to the next, a column for each output name; the first heading that yields text wins.

    All are read from one parse of a page.
    """
    return parsed_pages(pages).select("page_id", *[_section_value(headings).alias(out) for out, headings in names.items()])


def section(pages: DataFrame, names: Sequence[str], out: str = "section") -> DataFrame:
    """``sections`` of one output column."""
    return sections(pages, {out: names})


def _folded(path: Column) -> Column:
    """A path without its ``.`` and ``..`` steps."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    # A path that ends in a step ends in its folder.
    end = F.when(last.isin(".", ".."), F.when(F.size(kept) > 0, "/").otherwise("")).otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), end)


def absolute_url(base: Column, href: Column) -> Column:
    """A link seen from its page; ``.`` and ``..`` steps of the path are folded, queries and fragments kept as they are."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_replace(base, "#.*$", "")
    base_path = F.regexp_replace(F.substring(page, F.length(origin) + 1, F.length(page)), r"\?.*$", "")
    folder = F.regexp_replace(base_path, "[^/]*$", "")
    path, rest = F.regexp_extract(href, "^[^?#]*", 0), F.regexp_extract(href, "(?s)[?#].*$", 0)
    from_root = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), path))
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", page)
        .when(href.startswith("#"), F.concat(page, href))
        .when(href.startswith("?"), F.concat(origin, base_path, href))
        .otherwise(F.concat(origin, F.when(from_root.rlike(r"/\.\.?(?:/|$)"), _folded(from_root)).otherwise(from_root), rest))
    )


def anchors(pages: DataFrame, containing: str = "") -> DataFrame:
    """(page_id, url, pos, href, text): every link of every page, in page order.

    A link that is not closed ends where the next one begins, or with the page.

    ``containing`` drops anchors without that text before they are taken apart.
    """
    found = F.regexp_extract_all(clean_html("html"), F.lit(r"(?is)<a\b[^>]*?href\s*=.*?(?=</a\s*>|<a\b|\z)"), 0)
    # Only the links are decoded, not their pages.
    link = pages.select("page_id", "url", F.posexplode(found).alias("pos", "_raw")).select("page_id", "url", "pos", _decoded(F.col("_raw")).alias("a"))
    link = link.filter(F.col("a").contains(containing)) if containing else link
    raw = F.regexp_extract("a", r"(?is)^<a\b[^>]*?href\s*=\s*[\"']?([^\"'\s>]*)", 1)
    return link.select("page_id", "url", "pos", plain_markup(raw).alias("href"), strip_tags("a").alias("text"))


def links(pages: DataFrame, path_test: str = "/variable/", param: str = "name") -> DataFrame:
    """(page_id, name, link): links whose path holds ``path_test``, keyed by a query parameter.

    A repeated name within a page keeps its last link.
    """
    full = absolute_url(F.col("url"), F.col("href"))
    query = F.regexp_extract("href", rf"[?&]{param}=([^&#]*)", 1)
    name = F.trim(F.coalesce(F.try_url_decode(query), query))
    return (
        anchors(pages, path_test)
        .filter(F.col("href").contains(path_test) & F.col("href").contains(f"{param}="))
        .select("page_id", "pos", name.alias("name"), full.alias("link"))
        .filter("name != ''")
        .groupBy("page_id", "name")
        .agg(F.max_by("link", "pos").alias("link"))
    )


def file_ids(pages: DataFrame) -> DataFrame:
    """(file_name, file_id): from a page's own address first, then its links, then link text."""
    own = pages.select(
        F.regexp_extract("url", r"[?&]file_name=([^&#]*)", 1).alias("file_name"),
        F.regexp_extract("url", r"/data-dictionary/(F\d+)\b", 1).alias("file_id"),
        F.lit(0).alias("rank"), "page_id", F.lit(-1).alias("pos"),
    )
    linked = anchors(pages, "/data-dictionary/").filter(F.col("href").contains("/data-dictionary/")).withColumn(
        "file_id", F.regexp_extract("href", r"/data-dictionary/(F\d+)\b", 1)
    )
    by_param = linked.select(
        F.regexp_extract("href", r"[?&]file_name=([^&#]*)", 1).alias("file_name"), "file_id",
        F.lit(1).alias("rank"), "page_id", "pos",
    )
    by_text = linked.filter(F.col("href").contains("?file_name=")).select(
        F.col("text").alias("file_name"), "file_id", F.lit(2).alias("rank"), "page_id", "pos"
    )
    found = own.unionByName(by_param).unionByName(by_text).filter("file_name != '' and file_id != ''")
    return keep_first(found, ["file_name"], ["rank", "page_id", "pos"]).select("file_name", "file_id")


def with_error(df: DataFrame, key: Column, message: str) -> DataFrame:
    """Quarantine instead of failure: ``error`` names the problem of rows without a key output."""
    bad = key.isNull() | (key == "")
    return df.withColumn("error", F.when(bad, F.lit(message)).otherwise(""))


def codebook_schema(df: DataFrame) -> DataFrame:
    """The eighteen published columns in order; what is missing becomes ''."""
    def column(name: str) -> Column:
        if name == "categorias":
            empty = F.array().cast(CATEGORY_TYPE)
            return F.coalesce(F.col(name), empty) if name in df.columns else empty
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")
    return df.select(*[column(c).alias(c) for c in CODEBOOK_COLUMNS])


def codebook(pages: DataFrame, tabla: Column | None = None, variable: Column | None = None) -> DataFrame:
    """One codebook row per variable page.

    Table and variable default to the ``file_name`` and ``name`` parameters of the
    page address, the variable also to the code in the title.
    """
    own_table = F.regexp_extract("url", r"[?&]file_name=([^&#]*)", 1)
    own_name = F.nullif(F.regexp_extract("url", r"[?&]name=([^&#]*)", 1), F.lit(""))
    first = _first(F.col("_sections"), lambda s: (s["level"] == "2") & F.lower(F.substring(F.get(s["parts"], F.lit(0)), 1, 3)).eqNullSafe("<h2"))
    title = split_title(F.coalesce(F.regexp_extract(F.get(first["parts"], F.lit(0)), "^" + HEADING, 2), F.lit("")))
    # What several output columns read is computed in a step before them.
    staged = parsed_pages(pages).select(
        "*",
        title.alias("_title"),
        _overview_rows().alias("_overview"),
        _category_rows().alias("_categories"),
        _question_part().alias("_part"),
    ).withColumn("_texts", _question_texts(F.col("_part")))
    parsed = staged.select(
        (own_table if tabla is None else tabla).alias("tabla"),
        (F.coalesce(own_name, F.col("_title.code")) if variable is None else variable).alias("variable"),
        F.col("_title.label").alias("etiqueta"),
        _question_value(F.col("_texts")).alias("pregunta"),
        *_overview_values(F.col("_overview")),
        _section_value(DEFINITION_HEADINGS).alias("definicion"),
        _section_value(UNIVERSE_HEADINGS).alias("universo"),
        _section_value(SOURCE_HEADINGS).alias("fuente"),
        _category_structs(F.col("_categories")).alias("categorias"),
        F.col("url").alias("url_variable"),
    ).withColumn("categorias_json", F.to_json("categorias"))
    return codebook_schema(with_error(parsed, F.col("etiqueta"), "page has no title"))
