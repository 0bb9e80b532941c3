"""Grids, pivots and filters over whole tables."""

from pyspark.sql import functions as F

from panelwright.operators import filters, reshape
from suite.inputs import GRID_ROWS, GRID_SQL, GRID_TITLES, TIDY_SQL, order_cells, survey_cells, table, tidy


def _grid(spark, sf):
    cells = order_cells(spark, sf)
    long = reshape.grid_to_long(cells, GRID_TITLES, GRID_ROWS)
    panel = reshape.tidy_panel(long, "pedidos")
    return panel.select(
        "estado", "anio", "periodo", "fecha", "metric", "indicador", "fuente", F.round("valor", 2).alias("valor"), "es_acumulado"
    )


def _grid2(spark, sf):
    return reshape.tidy_health(reshape.grid2_to_long(survey_cells(spark, sf)))


def _ffill(spark, sf):
    """Statuses as merged header cells: one sheet per customer, one row per month."""
    day = F.col("o_orderdate").cast("date")
    cells = table(
        spark, sf, "orders", F.col("o_custkey").cast("string").alias("source"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("row_idx"), F.col("o_orderkey").cast("int").alias("col_idx"),
        F.when(F.col("o_orderstatus") != "P", F.concat("o_orderstatus", day.cast("string"))).alias("value"),
    )
    return reshape.ffill_right(cells).groupBy("filled").agg(F.count(F.lit(1)).alias("n"))


def _pivot(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", F.year("o_orderdate").alias("anio"), "o_totalprice")
    wide = reshape.pivot_years(orders, "o_orderpriority", "anio", "o_totalprice")
    return wide.select("o_orderpriority", *[F.round(f"`{y}`", 2).alias(f"y{y}") for y in wide.columns if y != "o_orderpriority"])


def _melt(keep):
    def run(spark, sf):
        wide = table(
            spark, sf, "orders", "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
            F.col("o_custkey").cast("double").alias("cust"),
        )
        return reshape.melt(wide, ["o_orderkey"], ["price", "cust"], keep_nulls=keep)
    return run


def _sorted(spark, sf):
    rows = reshape.tidy_select(tidy(spark, sf))
    return filters.sort_by(rows, ["estado", "indicador", "metric", "fecha", "periodo"]).select(
        "estado", "anio", "periodo", "fecha", "metric", "indicador", "fuente", F.round("valor", 2).alias("valor")
    )


def _slice(spark, sf):
    rows = filters.panel_slice(tidy(spark, sf), "vab_comercio_informal", "Millones de pesos a precios corrientes", national=True)
    return filters.cutoff(rows, last="1999-12-31").select("periodo", "fecha", F.round("valor", 2).alias("valor"))


def _keys(spark, sf):
    rows = table(
        spark, sf, "lineitem", F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("flag"), "l_discount", "l_tax", "l_quantity"
    )
    kept = filters.require_keys(rows, ["flag"], nonzero=["l_discount", "l_tax"])
    return kept.groupBy("flag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


def _reference_mode(spark, sf):
    return filters.reference_period(table(spark, sf, "orders"), "o_orderpriority")


def _reference_t4(spark, sf):
    return filters.at_reference_period(tidy(spark, sf)).groupBy("periodo", "metric").agg(F.count(F.lit(1)).alias("n"))


def _latest(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey", F.year("o_orderdate").alias("anio"))
    overall = filters.latest_year(orders).select("o_orderkey", F.lit("overall").alias("scope"))
    return overall.unionByName(filters.latest_year(orders, by=["o_custkey"]).select("o_orderkey", F.lit("customer").alias("scope")))


def _top(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    overall = filters.top_n(orders, 10, order).withColumn("scope", F.lit("overall"))
    return overall.unionByName(filters.top_n(orders, 3, order, by=["o_orderpriority"]).withColumn("scope", F.lit("priority")))


QUERIES = {
    "grid_to_long": (
        _grid,
        f"""WITH {GRID_SQL} SELECT l.estado, CAST(u.yf AS INTEGER) AS anio, 'T' || u.q AS periodo,
        last_day(make_date(CAST(u.yf AS INTEGER), CAST(u.q * 3 AS INTEGER), 1)) AS fecha, l.metric, 'pedidos' AS indicador, l.source AS fuente,
        round(s.v, 2) AS valor, false AS es_acumulado
        FROM labels l JOIN used u ON l.source = u.source AND u.yf IS NOT NULL
        LEFT JOIN sums s ON s.source = l.source AND s.metric = l.metric AND s.estado = l.estado AND s.y = u.y AND s.q = u.q""",
    ),
    "grid2_to_long": (
        _grid2,
        """SELECT n_name AS estado, c_mktsegment AS acceso_salud, o_orderstatus AS sexo, CAST(year(o_orderdate) AS INTEGER) AS anio,
        CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
        list_extract(['Primer','Segundo','Tercer','Cuarto'], quarter(o_orderdate)) || ' trimestre del ' || year(o_orderdate) AS trimestre_texto,
        year(o_orderdate) || 'Q' || quarter(o_orderdate) AS periodo,
        last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS fecha_fin_trimestre, CAST(count(*) AS DOUBLE) AS valor
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
    ),
    "ffill_right": (
        _ffill,
        """SELECT filled, count(*) AS n FROM (SELECT last_value(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END IGNORE NULLS)
        OVER (PARTITION BY o_custkey, year(o_orderdate), month(o_orderdate) ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled
        FROM orders) GROUP BY 1""",
    ),
    "pivot_years": (
        _pivot,
        "SELECT o_orderpriority, " + ", ".join(
            f"round(sum(CASE WHEN year(o_orderdate) = {y} THEN o_totalprice END), 2) AS y{y}" for y in range(1995, 2002)
        ) + " FROM orders GROUP BY 1",
    ),
    "melt_keep_nulls": (
        _melt(True),
        """SELECT o_orderkey, 'price' AS name, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value FROM orders
        UNION ALL SELECT o_orderkey, 'cust', o_custkey FROM orders""",
    ),
    "melt_drop_nulls": (
        _melt(False),
        """SELECT o_orderkey, 'price' AS name, o_totalprice AS value FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT o_orderkey, 'cust', o_custkey FROM orders""",
    ),
    "tidy_select_sorted": (
        _sorted, f"WITH {TIDY_SQL} SELECT estado, anio, periodo, fecha, metric, indicador, fuente, round(valor, 2) AS valor FROM tidy",
    ),
    "panel_slice_cutoff": (
        _slice,
        f"""WITH {TIDY_SQL} SELECT periodo, fecha, round(valor, 2) AS valor FROM tidy WHERE estado = 'Estados Unidos Mexicanos'
        AND indicador = 'vab_comercio_informal' AND metric = 'Millones de pesos a precios corrientes' AND fecha <= DATE '1999-12-31'""",
    ),
    "require_keys": (
        _keys,
        """SELECT l_returnflag AS flag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
        WHERE l_linenumber <> 3 AND l_discount <> 0 AND l_tax <> 0 GROUP BY 1""",
    ),
    "reference_period_mode": (
        _reference_mode, "SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
    ),
    "reference_period_t4": (
        _reference_t4, f"WITH {TIDY_SQL} SELECT periodo, metric, count(*) AS n FROM tidy WHERE periodo = 'T4' GROUP BY 1, 2",
    ),
    "latest_year": (
        _latest,
        """SELECT o_orderkey, 'overall' AS scope FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)
        UNION ALL SELECT o_orderkey, 'customer' FROM (SELECT *, max(year(o_orderdate)) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE year(o_orderdate) = m""",
    ),
    "top_n": (
        _top,
        """(SELECT o_orderkey, o_orderpriority, o_totalprice, 'overall' AS scope FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
        UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice, 'priority' FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
        ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k <= 3""",
    ),
}
