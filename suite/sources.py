"""Readers and sniffers over data derived from the given tables."""

from pyspark.sql import functions as F

from panelwright.sources import dictionaries, files, sniff, tables
from suite.inputs import pick, pick_sql, table

ENCODINGS = ("utf-8", "utf-8-sig", "utf-16le", "utf-16be", "utf-32le", "utf-32be", "utf-16")


def _scan(spark, sf):
    rows = tables.scan(spark, f"{sf}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return rows.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))


def _monthly(spark, sf):
    """A monthly sheet: untrimmed date name, day-first text dates, amounts as text."""
    day = F.col("o_orderdate").cast("date")
    sheet = table(spark, sf, "orders", "o_orderdate", "o_totalprice").groupBy(F.trunc(day, "month").alias("m")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n")
    ).select(
        F.date_format("m", "dd/MM/yyyy").alias("Fecha "), F.round("total", 2).cast("string").alias(" Ingreso"), F.col("n").alias("Pedidos\n")
    )
    return tables.read_monthly(sheet, {"Ingreso": "ingreso", "Pedidos": "pedidos"}, dayfirst=True)


def _encodings(spark, sf):
    """Every document written in one of eight ways, and the way read back from its bytes."""
    t, k = F.col("text"), F.col("doc_id")
    mark = lambda h: F.unhex(F.lit(h))
    way = F.pmod(k, F.lit(8))
    latin = F.encode(F.regexp_replace(F.concat(F.lit("año; "), t), r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    head = (
        F.when(way == 0, F.encode(t, "UTF-8")).when(way == 1, F.concat(mark("EFBBBF"), F.encode(t, "UTF-8")))
        .when(way == 2, F.concat(mark("FFFE"), F.encode(t, "UTF-16LE"))).when(way == 3, F.concat(mark("FEFF"), F.encode(t, "UTF-16BE")))
        .when(way == 4, F.concat(mark("FFFE0000"), F.encode(t, "UTF-8"))).when(way == 5, F.concat(mark("0000FEFF"), F.encode(t, "UTF-8")))
        .when(way == 6, F.encode(F.concat(F.lpad(F.lit(""), 60, "x"), t), "UTF-16LE")).otherwise(latin)
    )
    return table(spark, sf, "documents", "doc_id", sniff.sniff_encoding(head).alias("encoding"))


def _delimiters(spark, sf):
    sep = pick(F.col("o_orderkey"), ",", ";", "|", "\t")
    quoted = F.concat(F.lit('"'), F.col("o_orderstatus"), sep, F.lit('x"'))
    line = F.concat_ws("", F.lit("key"), sep, quoted, sep, F.col("o_orderpriority"), sep, F.lit("total"))
    rows = table(spark, sf, "orders", line.alias("line")).withColumn("delimiter", sniff.sniff_delimiter("line"))
    fields = rows.withColumn("fields", sniff.header_fields("line", "delimiter"))
    return fields.groupBy("delimiter", F.array_join("fields", "~").alias("fields")).agg(F.count(F.lit(1)).alias("n"))


def _dictionaries(spark, sf):
    """One JSON text per customer: a list, an object of lists, or broken."""
    k = F.col("c_custkey")
    row = F.concat(
        F.lit('{"tabla": " SDEMT'), F.lit('124", "variable": "'), F.col("c_mktsegment"), F.lit(' ", "extra": 1, "categorias": [{"valor": "'),
        F.col("c_nationkey").cast("string"), F.lit('", "categoria": "é", "casos": "1", "porcentaje": ""}, {"valor": "x", "categoria": "y"}]}'),
    )
    value = (
        F.when(F.pmod(k, F.lit(3)) == 0, F.concat(F.lit("\n["), row, F.lit(","), row, F.lit("]")))
        .when(F.pmod(k, F.lit(3)) == 1, F.concat(F.lit('{"a": ['), row, F.lit('], "b": ['), row, F.lit("]}")))
        .otherwise("{broken")
    )
    rows = dictionaries.parse_dictionaries(table(spark, sf, "customer", k.cast("string").alias("path"), value.alias("value")))
    cat = F.get("categorias", F.lit(0))["valor"]
    return rows.groupBy("tabla", "variable", cat.alias("valor"), F.size("categorias").alias("n_cat"), "error").agg(F.count(F.lit(1)).alias("n"))


MANIFEST_MODULES = ("SDEMT", "COE1T", "COE2T", "HOGT", "VIVT")


def _manifest(spark, sf):
    """A file head for every order, in five encodings and four separators, under a name that tells module and period."""
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    sep = pick(k, ",", ";", "|", "\t")
    line = F.concat(F.lit("  \n"), F.concat_ws("", F.lit("CD_A"), sep, F.lit('"per'), sep, F.lit('x"'), sep, F.lit("año")), F.lit("\n1"), sep, F.lit("2"))
    way = F.pmod(k, F.lit(5))
    mark = lambda h: F.unhex(F.lit(h))
    head = (
        F.when(way == 0, F.encode(line, "UTF-8")).when(way == 1, F.concat(mark("EFBBBF"), F.encode(line, "UTF-8")))
        .when(way == 2, F.concat(mark("FFFE"), F.encode(line, "UTF-16LE"))).when(way == 3, F.concat(mark("FEFF"), F.encode(line, "UTF-16BE")))
        .otherwise(F.encode(line, "ISO-8859-1"))
    )
    name = F.concat(pick(k, *MANIFEST_MODULES), F.lit("__x_20"), F.date_format(day, "yy"), F.lit("_trim"), F.quarter(day).cast("string"), F.lit(".csv"))
    heads = table(spark, sf, "orders", k.cast("string").alias("path"), name.alias("name"), F.octet_length(head).cast("long").alias("length"), head.alias("head"), F.lit(None).cast("string").alias("error"))
    found = files.csv_manifest(heads)
    return found.groupBy("encoding", "delimiter", F.array_join("header", "~").alias("header"), "module", "anio", "trimestre").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "parquet_scan": (_scan, "SELECT l_returnflag, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY 1"),
    "monthly_sheet": (
        _monthly,
        """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS fecha, round(sum(o_totalprice), 2) AS ingreso,
        CAST(count(*) AS DOUBLE) AS pedidos FROM orders GROUP BY 1""",
    ),
    "sniff_encoding": (
        _encodings,
        f"SELECT doc_id, list_extract([{', '.join(repr(e) for e in (*ENCODINGS, 'cp1252'))}], CAST(doc_id % 8 AS INTEGER) + 1) AS encoding FROM documents",
    ),
    "sniff_delimiter": (
        _delimiters,
        f"""SELECT d AS delimiter, 'key~' || o_orderstatus || d || 'x~' || o_orderpriority || '~total' AS fields, count(*) AS n
        FROM (SELECT *, {pick_sql('o_orderkey', ',', ';', '|', chr(9))} AS d FROM orders) GROUP BY ALL""",
    ),
    "dictionary_json": (
        _dictionaries,
        """SELECT CASE WHEN c_custkey % 3 = 2 THEN '' ELSE 'SDEMT124' END AS tabla, CASE WHEN c_custkey % 3 = 2 THEN '' ELSE c_mktsegment END AS variable,
        CASE WHEN c_custkey % 3 < 2 THEN CAST(c_nationkey AS VARCHAR) END AS valor, CASE WHEN c_custkey % 3 = 2 THEN 0 ELSE 2 END AS n_cat,
        CASE WHEN c_custkey % 3 = 2 THEN 'unreadable dictionary' END AS error,
        CAST(sum(CASE WHEN c_custkey % 3 = 2 THEN 1 ELSE 2 END) AS BIGINT) AS n FROM customer GROUP BY ALL""",
    ),
    "csv_manifest": (
        _manifest,
        f"""SELECT {pick_sql('o_orderkey', 'utf-8', 'utf-8-sig', 'utf-16le', 'utf-16be', 'cp1252')} AS encoding, d AS delimiter,
        'CD_A~per' || d || 'x~año' AS header, {pick_sql('o_orderkey', *MANIFEST_MODULES)} AS module, CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS anio,
        CAST(quarter(o_orderdate) AS INTEGER) AS trimestre, count(*) AS n
        FROM (SELECT *, {pick_sql('o_orderkey', ',', ';', '|', chr(9))} AS d FROM orders) GROUP BY ALL""",
    ),
}
