"""Inputs of the registered queries, derived from the given tables by Spark.

Each builder has a SQL twin, a list of common table expressions, for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.periods import month_end, period_month
from panelwright.functions.text import NATION
from panelwright.plans.marts import JOBS, NOMINAL, REAL, UNITS, VALUE_ADDED, WAGES


def table(spark: SparkSession, sf: str, name: str, *cols: str | Column) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*cols) if cols else df


def pick(index: Column, *values: str | None) -> Column:
    """The value at a position that repeats with the list's length."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def pick_sql(index: str, *values: str | None) -> str:
    quoted = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"list_extract([{quoted}]::VARCHAR[], CAST(({index}) % {len(values)} AS INTEGER) + 1)"


def spread(df: DataFrame) -> DataFrame:
    """The same rows in equal shares for all cores: a file of a few MB is read by one task, however long its rows take."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


QUARTER_END = "last_day(date_trunc('quarter', {0}) + INTERVAL 2 MONTH)"


# --- the fiscal series: one row per shipping quarter --------------------------------

def fiscal_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """(fecha, VAB_Informal, ISR, IVA, IMSS) from lineitem, one aggregate."""
    price = F.col("l_extendedprice")
    items = table(spark, sf, "lineitem", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    return items.groupBy(F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("q")).agg(
        F.sum(price).alias("VAB_Informal"),
        F.sum(price * F.col("l_discount")).alias("ISR"),
        F.sum(price * F.col("l_tax")).alias("IVA"),
        F.sum("l_quantity").alias("IMSS"),
    ).select(F.last_day(F.add_months("q", 2)).alias("fecha"), "VAB_Informal", "ISR", "IVA", "IMSS")


FISCAL_SQL = f"""fiscal AS (
  SELECT {QUARTER_END.format('l_shipdate')} AS fecha,
         sum(l_extendedprice) AS VAB_Informal, sum(l_extendedprice * l_discount) AS ISR,
         sum(l_extendedprice * l_tax) AS IVA, sum(l_quantity) AS IMSS
  FROM lineitem GROUP BY 1)"""


def fiscal_by_flag(spark: SparkSession, sf: str) -> DataFrame:
    """The same series for each return flag."""
    price = F.col("l_extendedprice")
    items = table(spark, sf, "lineitem", "l_returnflag", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_quantity")
    return items.groupBy("l_returnflag", F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("q")).agg(
        F.sum(price).alias("VAB_Informal"),
        F.sum(price * F.col("l_discount")).alias("ISR"),
        F.sum(price * F.col("l_tax")).alias("IVA"),
        F.sum("l_quantity").alias("IMSS"),
    ).select("l_returnflag", F.last_day(F.add_months("q", 2)).alias("fecha"), "VAB_Informal", "ISR", "IVA", "IMSS")


FISCAL_FLAG_SQL = f"""fiscal AS (
  SELECT l_returnflag, {QUARTER_END.format('l_shipdate')} AS fecha,
         sum(l_extendedprice) AS VAB_Informal, sum(l_extendedprice * l_discount) AS ISR,
         sum(l_extendedprice * l_tax) AS IVA, sum(l_quantity) AS IMSS
  FROM lineitem GROUP BY 1, 2)"""


# --- the tidy table: nations as states ----------------------------------------------

BROKEN_VARIATION = "Variación porcentual anual".encode().decode("latin-1")
# (indicator, metric, title row, value in Spark SQL and DuckDB alike) over s, n, b, anio
TIDY_METRICS = (
    (VALUE_ADDED, REAL, 7, "s * 100 / (101 + 2 * (anio - 1995))"),
    (VALUE_ADDED, "Índice de volumen físico base 2018=100", 75, "n * 2.0e0"),
    (VALUE_ADDED, BROKEN_VARIATION, 109, "n - 40.0e0"),
    (VALUE_ADDED, NOMINAL, 177, "s"),
    (VALUE_ADDED, "Índice de precios implícitos base 2018=100", 245, "(101 + 2 * (anio - 1995)) * 1.0e0"),
    (VALUE_ADDED, "Variación porcentual del índice de precios implícitos", 279, "3.0e0"),
    (WAGES, NOMINAL, 7, "b"),
    (WAGES, "Índice de valor 2018=100", 75, "b / (n + 0.37e0)"),
    (JOBS, UNITS, 7, "n * 1.0e0"),
)


def orders_by_nation(spark: SparkSession, sf: str) -> DataFrame:
    """(estado, anio, q, s, n, b): price, count and customer balance of orders.

    Orders are summed per customer and quarter before they meet the customers, so a
    customer with very many orders reaches the join as a few rows.
    """
    orders = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("anio"), F.quarter("o_orderdate").alias("q")
    ).agg(F.sum("o_totalprice").alias("s"), F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf, "customer", "c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_acctbal")
    per_nation = per_customer.join(customers, "c_custkey").groupBy("n_nationkey", "anio", "q").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum(F.col("c_acctbal") * F.col("n")).alias("b")
    )
    names = table(spark, sf, "nation", "n_nationkey", F.col("n_name").alias("estado"))
    return per_nation.join(names, "n_nationkey").select("estado", "anio", "q", "s", "n", "b")


def tidy(spark: SparkSession, sf: str) -> DataFrame:
    """Tidy table of nations and the whole, with quarters and running totals."""
    q = F.col("q")
    periods = F.array_compact(F.array(
        F.concat(F.lit("T"), q.cast("string")),
        F.when(q <= 2, "6 Meses"), F.when(q <= 3, "9 Meses"), F.lit("Anual"),
    ))
    spread = orders_by_nation(spark, sf).withColumn("periodo", F.explode(periods)).withColumn(
        "estado", F.explode(F.array("estado", F.lit(NATION)))
    )
    sums = spread.groupBy("estado", "anio", "periodo").agg(*[F.sum(c).alias(c) for c in ("s", "n", "b")])
    metrics = F.array(*[
        F.struct(F.lit(i).alias("indicador"), F.lit(m).alias("metric"), F.lit(t).alias("title_row"), F.expr(f"double({v})").alias("valor"))
        for i, m, t, v in TIDY_METRICS
    ])
    return sums.select("estado", "anio", "periodo", F.inline(metrics)).select(
        "estado", "anio", "periodo", month_end("anio", period_month("periodo")).alias("fecha"),
        "metric", "indicador", F.lit("orders").alias("fuente"), "valor", "title_row",
    )


TIDY_SQL = f"""base AS (
  SELECT n_name AS estado, year(o_orderdate) AS anio, quarter(o_orderdate) AS q,
         sum(o_totalprice) AS s, count(*) AS n, sum(c_acctbal) AS b
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
periods AS (SELECT * FROM (VALUES (1,'T1'),(2,'T2'),(3,'T3'),(4,'T4'),(1,'6 Meses'),(2,'6 Meses'),
  (1,'9 Meses'),(2,'9 Meses'),(3,'9 Meses'),(1,'Anual'),(2,'Anual'),(3,'Anual'),(4,'Anual')) v(q, periodo)),
months AS (SELECT * FROM (VALUES ('T1',3),('T2',6),('T3',9),('T4',12),('6 Meses',6),('9 Meses',9),('Anual',12)) v(periodo, mes)),
both_levels AS (SELECT estado, anio, q, s, n, b FROM base
  UNION ALL SELECT '{NATION}', anio, q, s, n, b FROM base),
sums AS (SELECT estado, anio, periodo, sum(s) AS s, CAST(sum(n) AS BIGINT) AS n, sum(b) AS b
  FROM both_levels JOIN periods USING (q) GROUP BY 1, 2, 3),
tidy AS (
""" + "\n  UNION ALL ".join(
    f"SELECT estado, CAST(anio AS INTEGER) AS anio, periodo, last_day(make_date(CAST(anio AS INTEGER), mes, 1)) AS fecha, "
    f"'{m}' AS metric, '{i}' AS indicador, 'orders' AS fuente, CAST({v} AS DOUBLE) AS valor, {t} AS title_row "
    "FROM sums JOIN months USING (periodo)"
    for i, m, t, v in TIDY_METRICS
) + ")"


# --- sheets as cell tables ----------------------------------------------------------

GRID_TITLES = (7, 33, 59, 85, 111)
GRID_ROWS = 25


def order_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One stacked sheet per order status: a block per priority, a row per nation, a column per quarter."""
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderpriority",
        F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"),
    ).agg(F.sum("o_totalprice").alias("v"))
    customers = table(spark, sf, "customer", "c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    sums = per_customer.join(customers, "c_custkey").groupBy(
        F.concat(F.lit("sheet "), "o_orderstatus").alias("source"), "o_orderpriority", "n_nationkey", "y", "q"
    ).agg(F.sum("v").alias("v"))
    names = table(spark, sf, "nation", "n_nationkey", "n_name")
    block = F.substring("o_orderpriority", 1, 1).cast("int")
    title = block * 26 - 19
    col = (F.col("y") - 1995) * 4 + F.col("q")

    def cell(row: Column, column: Column, value: Column) -> Column:
        return F.struct(row.cast("int").alias("row_idx"), column.cast("int").alias("col_idx"), value.alias("value"))

    cells = F.array(
        cell(F.lit(4), col, F.when(F.col("q") == 1, F.concat(F.col("y").cast("string"), F.lit("R")))),
        cell(F.lit(5), col, F.concat(F.lit("T"), F.col("q").cast("string"))),
        cell(title - 1, F.lit(0), F.concat(F.lit(" "), F.col("o_orderpriority"))),
        cell(title + F.col("n_nationkey"), F.lit(0), F.concat(F.col("n_name"), F.lit(" "))),
        cell(title + F.col("n_nationkey"), col, F.col("v").cast("string")),
    )
    every = sums.join(names, "n_nationkey").select("source", F.inline(cells)).filter("value is not null")
    return every.groupBy("source", "row_idx", "col_idx").agg(F.max("value").alias("value"))


GRID_SQL = """sums AS (
  SELECT 'sheet ' || o_orderstatus AS source, o_orderpriority AS metric, n_name AS estado,
         year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(o_totalprice) AS v
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3, 4, 5),
labels AS (SELECT DISTINCT source, metric, estado FROM sums),
used AS (SELECT source, q, y, max(CASE WHEN q = 1 THEN y END) OVER (PARTITION BY source ORDER BY y, q) AS yf
  FROM (SELECT DISTINCT source, y, q FROM sums))"""


def survey_cells(spark: SparkSession, sf: str) -> DataFrame:
    """One two-row-header sheet per region: segments and nations as labels, quarter and status as columns."""
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderdate")
    per_customer = orders.groupBy(
        F.col("o_custkey").alias("c_custkey"), "o_orderstatus",
        F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"),
    ).agg(F.count(F.lit(1)).alias("v"))
    customers = table(spark, sf, "customer", "c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    sums = per_customer.join(customers, "c_custkey").groupBy("n_nationkey", "c_mktsegment", "o_orderstatus", "y", "q").agg(
        F.sum("v").alias("v")
    )
    names = table(spark, sf, "nation")
    segments = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    segment = F.array_position(F.array(*[F.lit(s) for s in segments]), F.col("c_mktsegment"))
    row = F.col("n_nationkey") * 5 + segment + 1
    col = (F.col("y") - 1995) * 12 + F.col("q") * 3 + F.array_position(F.array(F.lit("F"), F.lit("O"), F.lit("P")), F.col("o_orderstatus")) - 2
    ordinal = F.get(F.array(*[F.lit(w) for w in ("Primer", "Segundo", "Tercer", "Cuarto")]), F.col("q") - 1)

    def cell(r: Column, c: Column, value: Column) -> Column:
        return F.struct(r.cast("int").alias("row_idx"), c.cast("int").alias("col_idx"), value.alias("value"))

    cells = F.array(
        cell(F.lit(0), col, F.concat(ordinal, F.lit(" trimestre del "), F.col("y").cast("string"))),
        cell(F.lit(1), col, F.col("o_orderstatus")),
        cell(row, F.lit(0), F.col("c_mktsegment")),
        cell(row, F.lit(1), F.col("n_name")),
        cell(row, col, F.col("v").cast("string")),
    )
    every = sums.join(names, "n_nationkey").select(F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("source"), F.inline(cells))
    return every.groupBy("source", "row_idx", "col_idx").agg(F.max("value").alias("value"))


# --- code dictionary and coded table ------------------------------------------------

def dictionary_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary rows seen in each order quarter: priorities, statuses, and a variable without categories."""
    orders = table(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_orderstatus")
    seen = orders.groupBy(
        F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"), "o_orderpriority", "o_orderstatus"
    ).agg(F.count(F.lit(1)).alias("n"))
    stamp = F.concat(F.lit(" "), F.col("y").cast("string"), F.lit("/"), F.col("q").cast("string"))

    def category(valor: Column, text: Column) -> Column:
        return F.struct(
            valor.alias("valor"), F.concat(text, stamp).alias("categoria"), F.lit("").alias("casos"), F.lit("").alias("porcentaje")
        )

    tabla = F.concat(F.lit("sdem"), F.col("q").cast("string"), F.date_format(F.make_date("y", F.lit(1), F.lit(1)), "yy"))
    rows = F.array(
        F.struct(F.lit("PRIO").alias("variable"), category(F.substring("o_orderpriority", 1, 1), F.substring("o_orderpriority", 3, 20)).alias("c")),
        F.struct(F.lit("Estatus").alias("variable"), category(F.col("o_orderstatus"), F.concat(F.lit("status "), F.col("o_orderstatus"))).alias("c")),
        F.struct(F.lit("vacia").alias("variable"), category(F.lit(" "), F.lit("blank")).alias("c")),
        F.struct(F.lit("clave").alias("variable"), category(F.lit("zzz"), F.lit("never used")).alias("c")),
        F.struct(F.lit("ausente").alias("variable"), category(F.lit("1"), F.lit("one")).alias("c")),
    )
    # The few categories of a quarter form one dictionary row, as in the published files.
    return seen.select(tabla.alias("tabla"), F.inline(rows)).groupBy("tabla", "variable").agg(
        F.array_sort(F.collect_set("c")).alias("categorias")
    )


def coded_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as an all-string coded table."""
    return table(
        spark, sf, "orders",
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(pick(F.col("o_orderkey"), "0", "", " ", "00"), F.substring("o_orderpriority", 1, 1)).alias("prio"),
        F.lower("o_orderstatus").alias("estatus"),
        F.concat(F.lit("k"), F.pmod(F.col("o_custkey"), F.lit(20)).cast("string")).alias("clave"),
        F.lit("x").alias("vacia"),
    )


DICTIONARY_SQL = """seen AS (
  SELECT DISTINCT year(o_orderdate) AS y, quarter(o_orderdate) AS q, o_orderpriority AS p, o_orderstatus AS s FROM orders),
ranked AS (SELECT *, (2000 + y % 100) * 10 + q AS rank, ' ' || y || '/' || q AS stamp FROM seen),
merged AS (
  SELECT 'PRIO' AS variable, z || p[1:1] AS code, arg_max(p[3:22] || stamp, rank) AS label, max(rank) AS rank
  FROM ranked, (VALUES (''), ('0')) v(z) GROUP BY 1, 2
  UNION ALL SELECT 'ESTATUS', s, arg_max('status ' || s || stamp, rank), max(rank) FROM ranked GROUP BY 1, 2
  UNION ALL SELECT 'CLAVE', v.c, arg_max('never used' || stamp, rank), max(rank) FROM ranked, (VALUES ('zzz'), ('ZZZ')) v(c) GROUP BY 1, 2
  UNION ALL SELECT 'AUSENTE', v.c, arg_max('one' || stamp, rank), max(rank) FROM ranked, (VALUES ('1'), ('01')) v(c) GROUP BY 1, 2)"""


# --- codebook pages -----------------------------------------------------------------

def part_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One variable page per part: headings, overview and category tables, question, sections."""
    key = F.col("p_partkey").cast("string")
    code = F.concat(F.lit("P"), key)
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td> "), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))
    shown = lambda h: F.concat(F.lit(f"<h3>{h}</h3>\n"))
    question_part = F.when(
        F.pmod("p_partkey", F.lit(3)) == 0,
        F.concat(F.lit("<p><strong>Pregunta literal</strong></p><p>&iquest;Cu&aacute;l es <b>"), F.col("p_name"), F.lit("</b>?</p>")),
    ).when(
        F.pmod("p_partkey", F.lit(3)) == 1,
        F.concat(F.lit("<div><span>Pregunta literal:</span> Marca "), F.col("p_brand"), F.lit("</div><p>otro</p>")),
    ).otherwise("<div>Pregunta literal</div><p>Categorías de la variable</p>")
    html = F.concat(
        F.lit("<html><head><script>var t='<h2>no</h2>';</script></head><body><!-- <h2>no</h2> --><nav><a href='/x'>x</a></nav><h2>"),
        F.col("p_name"), F.lit(" &amp; "), F.col("p_type"), F.lit(" ("), code, F.lit(")</h2>\n"),
        shown("Visión general"), F.lit("<table class='v'>"),
        row(F.lit("Válido"), F.col("p_size").cast("string")), row(F.lit("No  válido"), F.lit("0")),
        row(F.lit("Tipo"), F.lit("<b>Discreta</b>")), row(F.lit("Decimales"), F.lit("0")), row(F.lit("Ancho"), F.length("p_name").cast("string")),
        F.lit("</table>"),
        shown("Preguntas e instrucciones"), question_part,
        shown("Categorías"), F.lit("<table><tr><th>Valor</th><th>Categoría</th></tr>"),
        row(F.lit("Valor"), F.lit("Categoría")),
        row(F.lit("1"), F.col("p_brand"), F.col("p_size").cast("string"), F.lit("50%")),
        row(F.lit("2"), F.col("p_type")), row(F.lit("Sysmiss"), F.lit("0")), F.lit("</table>"),
        shown("Definici&oacute;n"), F.lit("<p>Parte\n "), F.col("p_name"), F.lit("</p><ul><li>skip</li></ul><p>fin</p>"),
        F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.concat(shown("Universe"), F.lit("<p>Tamaño "), F.col("p_size").cast("string"), F.lit("</p>"))).otherwise(""),
        shown("Fuente"), F.lit("<div>CE&#78;&#x53;O "), F.col("p_type"), F.lit("</div></body></html>"),
    )
    # Small rows are dealt out, before they become pages.
    parts = spread(table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return parts.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("https://data.example.org/cat/index.php/catalog/9/variable/F1/V"), key,
                 F.lit("?file_name=SDEMT124&name="), code).alias("url"),
        html.alias("html"),
    )


def index_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One index page per order: links to variables (one name twice) and to dictionary files."""
    key = F.col("o_orderkey").cast("string")
    html = F.concat(
        F.lit("<ul><li><a class=n href=\"/cat/catalog/9/variable/F2/V1?name=v%20"), key, F.lit("&amp;x=1\">uno</a></li>"),
        F.lit("<li><a href='variable/V2?name=b'>dos</a></li><li><a href='../variable/V3?name=b'>tres</a></li>"),
        F.lit("<li><a href='/other?name=c'>no</a></li><li><a href='/variable/V4?id=1'>no</a></li>"),
        F.lit("<a href='/cat/catalog/9/data-dictionary/F"), key, F.lit("?file_name=T"), key, F.lit("'>T"), key, F.lit("</a></ul>"),
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"), F.lit("https://data.example.org/cat/catalog/").alias("url"), html.alias("html")
    )
