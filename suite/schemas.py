"""Unions, headers, coverage, names and casts over whole tables."""

from pyspark.sql import functions as F

from panelwright.functions.text import norm_header
from panelwright.operators import reshape, schema
from suite.inputs import pick, pick_sql, table

HEADERS = ("ent|mun|per", "Ent | MUN|per", "ent|per", "mun|ent|per", "ent|mun|per|extra")


def _manifest(spark, sf):
    """One manifest row per order, with one of five headers; some files unreadable."""
    k = F.col("o_orderkey")
    header = F.split(pick(k, *HEADERS), r"\|")
    return table(
        spark, sf, "orders",
        F.concat(F.lit("/in/"), F.lpad(k.cast("string"), 12, "0"), F.lit(".csv")).alias("path"),
        header.alias("header"), F.transform(header, norm_header).alias("header_norm"),
        pick(k, ",", ";", "|", "\t", ",").alias("delimiter"),
        F.when(F.col("o_orderstatus") == "P", "cannot decode").alias("error"),
    )


def _groups(spark, sf):
    g = schema.header_groups(_manifest(spark, sf))
    return g.select(F.array_join("header_norm", "|").alias("header"), "n_files", "sample_header", "delimiter", "kind")


def _group_files(spark, sf):
    f = schema.header_group_files(_manifest(spark, sf))
    return f.select("path", F.array_join("header_norm", "|").alias("header"), "n_files", "kind", "error")


def _coverage(spark, sf):
    return schema.coverage(_manifest(spark, sf), ["anio", "ent", "mun", "MUN", "per", "extra"])


def _union(spark, sf):
    """lineitem split by return flag, each part short of some columns, stacked again."""
    items = table(spark, sf, "lineitem")
    parts = [
        items.filter("l_returnflag = 'A'").drop("l_tax", "l_discount"),
        items.filter("l_returnflag = 'N'").drop("l_suppkey").select("l_tax", "l_orderkey", "l_returnflag", "l_discount", "l_quantity"),
        items.filter("l_returnflag = 'R'"),
    ]
    whole = schema.union_by_name(parts)
    names = F.lit(",".join(whole.columns)).alias("column_order")
    return whole.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("n_tax"), F.count("l_discount").alias("n_discount"),
        F.count("l_suppkey").alias("n_supp"), F.sum("l_quantity").alias("quantity"),
    ).select("*", names)


def _concat(spark, sf):
    """Duplicates stay: documents stacked with their labels' rows and themselves."""
    docs = table(spark, sf, "documents", "doc_id", "lang")
    labels = table(spark, sf, "labels", "doc_id", "quality")
    return reshape.union_rows([docs, labels, docs]).groupBy("lang", "quality").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


def _canonical(spark, sf):
    k = F.col("o_orderkey")
    raw = table(
        spark, sf, "orders", F.concat(pick(k, "", " ", "x"), F.year("o_orderdate").cast("string")).alias("anio"),
        F.quarter("o_orderdate").cast("double").alias("trimestre"), "o_orderkey", "o_orderstatus",
    )
    typed = schema.canonical_cast(raw)
    types = F.lit(",".join(t for _, t in typed.dtypes)).alias("types")
    return typed.groupBy("anio", "trimestre", "o_orderstatus").agg(F.max(F.length("o_orderkey")).alias("longest"), F.count(F.lit(1)).alias("n")).select("*", types)


def _period_meta(spark, sf):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("SDEMT_x_"), F.year("o_orderdate").cast("string"), F.lit("_trim"), F.quarter("o_orderdate").cast("string"), pick(k, ".csv", "__2.csv"))
    raw = table(
        spark, sf, "orders", name.alias("file"),
        F.concat(F.quarter("o_orderdate").cast("string"), F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise("05")).alias("PER"),
        F.col("o_orderstatus").alias("st"),
    )
    return schema.add_period_meta(raw, "file").groupBy("anio", "trimestre", "anio_trimestre", "st").agg(F.count(F.lit(1)).alias("n"))


def _unique(spark, sf):
    files = table(spark, sf, "documents", "doc_id", F.concat(F.col("source"), F.lit(" año")).alias("stem"), F.col("lang").alias("tag"))
    return schema.unique_names(files, "doc_id", "stem", "tag").select("doc_id", "name")


_MANIFEST_SQL = f"""files AS (SELECT '/in/' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.csv' AS path,
  {pick_sql('o_orderkey', *HEADERS)} AS raw, {pick_sql('o_orderkey', ',', ';', '|', chr(9), ',')} AS d, o_orderstatus = 'P' AS bad FROM orders),
normal AS (SELECT *, lower(replace(raw, ' ', '')) AS header FROM files)"""

QUERIES = {
    "header_groups": (
        _groups,
        f"""WITH {_MANIFEST_SQL} SELECT header, count(*) AS n_files, replace(arg_min(raw, path), '|', ' | ') AS sample_header,
        arg_min(d, path) AS delimiter, CASE WHEN count(*) > 1 THEN 'group' ELSE 'single' END AS kind FROM normal WHERE NOT bad GROUP BY 1""",
    ),
    "header_group_files": (
        _group_files,
        f"""WITH {_MANIFEST_SQL}, g AS (SELECT header, count(*) AS n FROM normal WHERE NOT bad GROUP BY 1)
        SELECT path, header, n AS n_files, CASE WHEN n > 1 THEN 'group' ELSE 'single' END AS kind, NULL AS error FROM normal JOIN g USING (header) WHERE NOT bad
        UNION ALL SELECT path, NULL, NULL, NULL, 'cannot decode' FROM normal WHERE bad""",
    ),
    "column_coverage": (
        _coverage,
        f"""WITH {_MANIFEST_SQL}, carried AS (SELECT unnest(string_split(raw, '|')) AS c FROM files)
        SELECT v.columna, (SELECT count(*) FROM carried WHERE c = v.columna) AS archivos_con_col, (SELECT count(*) FROM files) AS total_archivos
        FROM (VALUES ('anio'), ('ent'), ('mun'), ('MUN'), ('per'), ('extra')) v(columna)""",
    ),
    "union_by_name": (
        _union,
        """SELECT l_returnflag, count(*) AS n, count(CASE WHEN l_returnflag <> 'A' THEN 1 END) AS n_tax,
        count(CASE WHEN l_returnflag <> 'A' THEN 1 END) AS n_discount, count(CASE WHEN l_returnflag <> 'N' THEN 1 END) AS n_supp,
        sum(l_quantity) AS quantity,
        'l_discount,l_extendedprice,l_linenumber,l_linestatus,l_orderkey,l_partkey,l_quantity,l_returnflag,l_shipdate,l_suppkey,l_tax' AS column_order
        FROM lineitem GROUP BY 1""",
    ),
    "concat_rows": (
        _concat,
        """SELECT lang, NULL AS quality, 2 * count(*) AS n, CAST(2 * sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1
        UNION ALL SELECT NULL, quality, count(*), CAST(sum(doc_id) AS BIGINT) FROM labels GROUP BY 2""",
    ),
    "canonical_cast": (
        _canonical,
        """SELECT CASE WHEN o_orderkey % 3 < 2 THEN CAST(year(o_orderdate) AS INTEGER) END AS anio, CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
        o_orderstatus, max(length(CAST(o_orderkey AS VARCHAR))) AS longest, count(*) AS n, 'int,int,string,string' AS types FROM orders GROUP BY 1, 2, 3""",
    ),
    "period_meta": (
        _period_meta,
        """SELECT anio, trimestre, anio || 'T' || trimestre AS anio_trimestre, st, count(*) AS n FROM (
        SELECT o_orderstatus AS st, CASE WHEN o_orderkey % 2 = 0 AND year(o_orderdate) >= 2000 THEN CAST(year(o_orderdate) AS INTEGER)
          WHEN o_orderstatus <> 'P' THEN 2005 END AS anio,
        CASE WHEN o_orderkey % 2 = 0 AND year(o_orderdate) >= 2000 OR o_orderstatus <> 'P' THEN CAST(quarter(o_orderdate) AS INTEGER) END AS trimestre
        FROM orders) GROUP BY ALL""",
    ),
    "unique_names": (
        _unique,
        """SELECT doc_id, source || '_a_o__' || lang || CASE WHEN k > 1 THEN '__' || k ELSE '' END || '.csv' AS name FROM (
        SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS k FROM documents)""",
    ),
}
