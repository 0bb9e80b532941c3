"""Lookups, labels and joins over whole tables."""

from pyspark.sql import functions as F

from panelwright.operators import aggregates, joins, labels, series
from suite.inputs import DICTIONARY_SQL, coded_orders, dictionary_rows, fiscal_quarters, FISCAL_SQL, TIDY_SQL, table, tidy


def _state(spark, sf):
    catalog = table(spark, sf, "nation", F.col("n_nationkey").cast("string").alias("CVE_ENT"), F.col("n_name").alias("NOM_ENT"))
    facts = table(
        spark, sf, "customer", "c_acctbal",
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_nationkey") + 90).otherwise(F.col("c_nationkey")).cast("string").alias("ent"),
    )
    named = joins.label_state(facts, catalog)
    return named.groupBy("ent_nombre").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def _municipality(spark, sf):
    catalog = table(
        spark, sf, "supplier", F.concat(F.lit("0"), F.col("s_nationkey").cast("string")).alias("e"), "s_nationkey",
        F.pmod("s_suppkey", F.lit(40)).cast("string").alias("CVE_MUN"), F.col("s_name").alias("NOM_MUN"),
    ).select(F.when(F.col("s_nationkey") < 10, F.col("e")).otherwise(F.col("s_nationkey").cast("string")).alias("CVE_ENT"), "CVE_MUN", "NOM_MUN")
    facts = table(spark, sf, "customer", F.col("c_nationkey").cast("string").alias("ent"), F.pmod("c_custkey", F.lit(40)).cast("string").alias("mun"), "c_custkey")
    return joins.label_municipality(facts, catalog, drop_codes=True)


def _many_to_one(spark, sf):
    items = table(spark, sf, "lineitem", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    parts = table(spark, sf, "part", "p_partkey", "p_brand", "p_retailprice")
    joined = joins.join_many_to_one(items, parts, ["p_partkey"])
    return joined.groupBy("p_brand").agg(F.round(F.sum(F.col("l_quantity") * F.col("p_retailprice")), 1).alias("value"), F.count(F.lit(1)).alias("n"))


def _salted(spark, sf):
    """The salted route, on the same join."""
    items = table(spark, sf, "lineitem", F.col("l_partkey").alias("p_partkey"), "l_quantity", "l_orderkey", "l_linenumber")
    parts = table(spark, sf, "part", F.when(F.col("p_size") > 10, F.col("p_partkey")).alias("p_partkey"), "p_brand")
    joined = joins.join_salted(items, parts, ["p_partkey"], salts=8)
    return joined.groupBy("p_brand").agg(F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n"))


def _on_date(spark, sf):
    q = F.trunc(F.col("o_orderdate").cast("date"), "quarter")
    orders = table(spark, sf, "orders", "o_orderdate", "o_totalprice", "o_orderstatus")
    dated = orders.groupBy(F.last_day(F.add_months(q, 2)).alias("fecha"))
    price = dated.agg(F.round(F.sum("o_totalprice"), 2).alias("price"))
    late = orders.groupBy(F.expr("CASE WHEN year(o_orderdate) > 1995 THEN last_day(add_months(trunc(CAST(o_orderdate AS DATE), 'quarter'), 2)) END AS fecha"))
    open_ = late.agg(F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))
    return joins.join_on_date(fiscal_quarters(spark, sf).select("fecha", "IMSS"), price, open_)


def _with_total(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", F.year("o_orderdate").alias("anio"), "o_totalprice")
    parts = aggregates.sum_by(orders, ["o_orderpriority", "anio"], "o_totalprice", "valor")
    # The total of one year is filed under no year: the years' parts find none.
    total = aggregates.sum_by(orders.withColumn("anio", F.when(F.col("anio") != 1997, F.col("anio"))), ["anio"], "o_totalprice", "valor")
    shared = joins.with_total(parts, total, ["anio"], "valor", "participacion_pct")
    return shared.select("o_orderpriority", "anio", F.round("valor", 2).alias("valor"), F.round("participacion_pct", 8).alias("participacion_pct"))


def _merge(spark, sf):
    merged = labels.merge_dictionary(dictionary_rows(spark, sf))
    return merged.select("variable", "code", "label", "rank", "base")


def _labelled(map_codes):
    def run(spark, sf):
        merged = labels.merge_dictionary(dictionary_rows(spark, sf))
        rows = labels.apply_labels(coded_orders(spark, sf), merged, "SDEMT", map_codes=map_codes)
        return rows.groupBy("prio", "estatus", "prio_label", "estatus_label", "clave_label").agg(F.count(F.lit(1)).alias("n"))
    return run


_LABEL_SQL = f"""WITH {DICTIONARY_SQL}, coded AS (SELECT list_extract(['0', '', ' ', '00'], CAST(o_orderkey % 4 AS INTEGER) + 1) || o_orderpriority[1:1] AS prio,
  o_orderpriority[1:1] AS k, lower(o_orderstatus) AS estatus FROM orders)
SELECT prio, estatus, p.label AS prio_label, e.label AS estatus_label, NULL AS clave_label, count(*) AS n
FROM coded LEFT JOIN merged p ON p.variable = 'PRIO' AND p.code = k LEFT JOIN merged e ON e.variable = 'ESTATUS' AND e.code = upper(estatus) GROUP BY ALL"""


def _missing(spark, sf):
    rows = dictionary_rows(spark, sf)
    return labels.missing_variables(labels.dictionary_variables(rows), labels.merge_dictionary(rows), coded_orders(spark, sf), "SDEMT")


def _quality(spark, sf):
    merged = labels.merge_dictionary(dictionary_rows(spark, sf))
    q = labels.label_quality(coded_orders(spark, sf), merged, "SDEMT")
    return q.select("variable", F.array_join("unmapped_codes", ",").alias("unmapped_codes"), F.array_join("known_codes", ",").alias("known_codes"))


def _deflate(spark, sf):
    rows = tidy(spark, sf)
    wages = rows.filter("indicador = 'remuneraciones_comercio_informal'")
    prices = rows.filter("indicador = 'vab_comercio_informal'")
    return series.add_deflated(wages, prices).select("estado", "anio", "periodo", "metric", F.round("valor", 2).alias("valor"))


def _deflate_items(spark, sf):
    """Line items at constant prices by a quarterly index of list prices, row by row."""
    index = fiscal_quarters(spark, sf).select("fecha", (F.col("VAB_Informal") / F.col("IMSS") / 30).alias("valor"), F.lit(1).alias("title_row"))
    day = F.col("l_shipdate").cast("date")
    items = table(spark, sf, "lineitem", F.last_day(F.add_months(F.trunc(day, "quarter"), 2)).alias("fecha"), F.col("l_extendedprice").alias("valor"), "l_returnflag")
    real = series.deflate(items, index, keys=["fecha"])
    return real.groupBy("l_returnflag").agg(F.round(F.sum("valor"), 1).alias("real"), F.count(F.lit(1)).alias("n"))


QUERIES = {
    "label_state": (
        _state,
        """SELECT n_name AS ent_nombre, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey AND c_mktsegment <> 'BUILDING' GROUP BY 1""",
    ),
    "label_municipality": (
        _municipality,
        """SELECT c_custkey, m.name AS mun_nombre FROM customer LEFT JOIN (SELECT s_nationkey AS e, s_suppkey % 40 AS m, min(s_name) AS name
        FROM supplier GROUP BY 1, 2) m ON c_nationkey = m.e AND c_custkey % 40 = m.m""",
    ),
    "join_many_to_one": (
        _many_to_one,
        """SELECT p_brand, round(sum(l_quantity * p_retailprice), 1) AS value, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
    ),
    "join_salted_lookup": (
        _salted,
        """SELECT p_brand, sum(l_quantity) AS quantity, count(*) AS n FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10 GROUP BY 1""",
    ),
    "join_on_date": (
        _on_date,
        f"""WITH {FISCAL_SQL}, o AS (SELECT last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS fecha, round(sum(o_totalprice), 2) AS price,
        count_if(o_orderstatus = 'O') AS n_open FROM orders GROUP BY 1) SELECT fecha, IMSS, price, n_open FROM fiscal JOIN o USING (fecha) WHERE year(fecha) > 1995""",
    ),
    "with_total": (
        _with_total,
        """WITH p AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS anio, sum(o_totalprice) AS valor FROM orders GROUP BY 1, 2)
        SELECT o_orderpriority, anio, round(valor, 2) AS valor,
        CASE WHEN anio <> 1997 THEN round(100 * valor / sum(valor) OVER (PARTITION BY anio), 8) END AS participacion_pct FROM p""",
    ),
    "merge_dictionary": (_merge, f"WITH {DICTIONARY_SQL} SELECT variable, code, label, CAST(rank AS INTEGER) AS rank, 'SDEMT' AS base FROM merged"),
    "apply_labels": (_labelled(256), _LABEL_SQL),
    "apply_labels_joined": (_labelled(0), _LABEL_SQL),
    "missing_variables": (
        _missing, "SELECT variable, reason FROM (VALUES ('AUSENTE', 'not in table'), ('VACIA', 'no categories')) v(variable, reason) WHERE EXISTS (FROM orders)",
    ),
    "label_quality": (
        _quality,
        """SELECT 'CLAVE' AS variable, string_agg(c, ',' ORDER BY c) AS unmapped_codes, 'ZZZ,zzz' AS known_codes
        FROM (SELECT DISTINCT 'k' || (o_custkey % 20) AS c FROM orders ORDER BY 1 LIMIT 10)""",
    ),
    "deflate_wages": (
        _deflate,
        f"""WITH {TIDY_SQL} SELECT estado, anio, periodo, metric, round(valor, 2) AS valor FROM tidy WHERE indicador = 'remuneraciones_comercio_informal'
        UNION ALL SELECT estado, anio, periodo, 'Remuneraciones a precios de 2018 (deflactadas con Índice de precios implícitos del VAB)',
        round(valor * 100 / (101 + 2 * (anio - 1995)), 2) FROM tidy
        WHERE indicador = 'remuneraciones_comercio_informal' AND metric = 'Millones de pesos a precios corrientes'""",
    ),
    "deflate_items": (
        _deflate_items,
        f"""WITH {FISCAL_SQL} SELECT l_returnflag, round(sum(l_extendedprice * 100.0 / (VAB_Informal / IMSS / 30)), 1) AS real, count(*) AS n FROM lineitem
        JOIN fiscal ON fecha = last_day(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH) GROUP BY 1""",
    ),
}
