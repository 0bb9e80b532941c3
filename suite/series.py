"""Panel operators on quarterly series, and the flagship chain."""

from pyspark.sql import functions as F

from panelwright.operators import aggregates, joins, series
from suite.inputs import FISCAL_FLAG_SQL, TIDY_SQL, fiscal_by_flag, orders_by_nation, table, tidy


def revenue_panel(spark, sf):
    """Quarterly order revenue per region with its share, growth and index.

    Orders are summed per customer first; nations and regions are joined to the sums.
    """
    day = F.last_day(F.add_months(F.make_date("anio", F.col("q") * 3 - 2, F.lit(1)), 2))
    nations = table(spark, sf, "nation", F.col("n_name").alias("estado"), "n_regionkey")
    regions = table(spark, sf, "region", F.col("r_regionkey").alias("n_regionkey"), "r_name")
    by_region = (
        orders_by_nation(spark, sf).withColumn("fecha", day).groupBy("estado", "fecha").agg(F.sum("s").alias("s"))
        .join(nations, "estado").join(regions, "n_regionkey")
    )
    panel = aggregates.to_quarterly(by_region, "fecha", {"s": "revenue"}, by=["r_name"]).drop("n_months")
    shared = series.share_of_total(panel, "revenue", by=["fecha"])
    growth = series.yoy(panel, ["revenue"], by=["r_name"])
    index = series.base100(panel, ["revenue"], by=["r_name"])
    keys = ["r_name", "fecha"]
    return shared.join(index, keys).join(growth, keys, "left").select(
        "r_name", "fecha", F.round("revenue", 2).alias("revenue"), F.round("share_pct", 8).alias("share_pct"),
        F.round("revenue_idx", 6).alias("revenue_idx"), F.round("revenue_yoy", 8).alias("revenue_yoy"),
    )


REVENUE_SQL = """WITH p AS (SELECT r_name, date_trunc('quarter', o_orderdate) AS q, sum(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)
SELECT p.r_name, last_day(p.q + INTERVAL 2 MONTH) AS fecha, round(p.v, 2) AS revenue, round(100 * p.v / sum(p.v) OVER (PARTITION BY p.q), 8) AS share_pct,
  round(100 * p.v / first_value(p.v) OVER (PARTITION BY p.r_name ORDER BY p.q), 6) AS revenue_idx, round(p.v / b.v - 1, 8) AS revenue_yoy
FROM p LEFT JOIN p b ON b.r_name = p.r_name AND b.q = p.q - INTERVAL 1 YEAR"""


def _yoy(spark, sf):
    # One quarter loses its date: it has no growth, nor has the quarter a year later.
    panel = fiscal_by_flag(spark, sf).withColumn("fecha", F.expr("CASE WHEN NOT (year(fecha) = 1997 AND month(fecha) = 6) THEN fecha END"))
    out = series.yoy(panel, ["ISR", "IMSS"], by=["l_returnflag"])
    return out.select("l_returnflag", "fecha", F.round("ISR_yoy", 8).alias("isr"), F.round("IMSS_yoy", 8).alias("imss"))


def _base100(spark, sf):
    out = series.base100(fiscal_by_flag(spark, sf), ["IVA"], by=["l_returnflag"])
    return out.select("l_returnflag", "fecha", F.round("IVA_idx", 6).alias("iva"))


def _pct_max(spark, sf):
    out = series.pct_of_max(fiscal_by_flag(spark, sf), "IMSS", ["l_returnflag"])
    return out.select("l_returnflag", "fecha", F.round("pct_of_max", 8).alias("pct"))


def _share(spark, sf):
    customers = table(spark, sf, "customer", "c_mktsegment", "c_nationkey", "c_acctbal")
    sums = aggregates.sum_by(customers, ["c_mktsegment", "c_nationkey"], "c_acctbal", "valor")
    grouped = series.share_of_total(sums, "valor", by=["c_nationkey"])
    whole = series.share_of_total(aggregates.sum_by(customers, ["c_mktsegment"], "c_acctbal", "valor"), "valor")
    cols = ["c_mktsegment", F.round("valor", 2).alias("valor"), F.round("share_pct", 8).alias("share_pct")]
    return grouped.select("c_nationkey", *cols).unionByName(whole.select(F.lit(None).cast("int").alias("c_nationkey"), *cols))


def _rank(spark, sf):
    orders = table(spark, sf, "orders", "o_custkey", F.year("o_orderdate").alias("anio"), "o_totalprice")
    sums = aggregates.sum_by(orders, ["o_custkey", "anio"], "o_totalprice", "valor").withColumn("valor", F.round("valor", 2))
    yearly = series.rank_by(sums, "valor", "o_custkey", 5, by=["anio"])
    whole = aggregates.sum_by(orders, ["o_custkey"], "o_totalprice", "valor").withColumn("valor", F.round("valor", 2))
    top = series.rank_by(whole, "valor", "o_custkey", 10).withColumn("anio", F.lit(None).cast("int"))
    return yearly.unionByName(top)


def _gaps(spark, sf):
    days = table(spark, sf, "orders", "o_orderpriority", F.col("o_orderdate").cast("date").alias("d")).distinct()
    return series.gap_days(days, "d", by=["o_orderpriority"]).groupBy("o_orderpriority", "gap_days").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "revenue_panel": (revenue_panel, REVENUE_SQL),
    "yoy_growth": (
        _yoy,
        f"""WITH {FISCAL_FLAG_SQL}, k AS (SELECT * FROM fiscal WHERE NOT (year(fecha) = 1997 AND month(fecha) = 6))
        SELECT a.l_returnflag, a.fecha, round(a.ISR / b.ISR - 1, 8) AS isr, round(a.IMSS / b.IMSS - 1, 8) AS imss
        FROM k a JOIN k b ON a.l_returnflag = b.l_returnflag AND year(a.fecha) = year(b.fecha) + 1 AND month(a.fecha) = month(b.fecha)""",
    ),
    "base100_index": (
        _base100,
        f"""WITH {FISCAL_FLAG_SQL} SELECT l_returnflag, fecha, round(100 * IVA / first_value(IVA) OVER (PARTITION BY l_returnflag ORDER BY fecha), 6) AS iva FROM fiscal""",
    ),
    "pct_of_max": (
        _pct_max, f"WITH {FISCAL_FLAG_SQL} SELECT l_returnflag, fecha, round(100 * IMSS / max(IMSS) OVER (PARTITION BY l_returnflag), 8) AS pct FROM fiscal",
    ),
    "share_of_total": (
        _share,
        """WITH s AS (SELECT c_nationkey, c_mktsegment, sum(c_acctbal) AS v FROM customer GROUP BY 1, 2), t AS (SELECT *, sum(v) OVER (PARTITION BY c_nationkey) AS t FROM s)
        SELECT c_nationkey, c_mktsegment, round(v, 2) AS valor, round(100 * v / t, 8) AS share_pct FROM t WHERE t > 0
        UNION ALL SELECT NULL, c_mktsegment, round(sum(v), 2), round(100 * sum(v) / (SELECT sum(v) FROM s), 8) FROM s GROUP BY 2""",
    ),
    "rank_by": (
        _rank,
        """WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anio, round(sum(o_totalprice), 2) AS valor FROM orders GROUP BY 1, 2),
        w AS (SELECT o_custkey, NULL AS anio, round(sum(o_totalprice), 2) AS valor FROM orders GROUP BY 1)
        SELECT o_custkey, anio, valor, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY anio ORDER BY valor DESC, o_custkey) AS k FROM y) WHERE k <= 5
        UNION ALL SELECT o_custkey, anio, valor, k FROM (SELECT *, row_number() OVER (ORDER BY valor DESC, o_custkey) AS k FROM w) WHERE k <= 10""",
    ),
    "gap_days": (
        _gaps,
        """WITH d AS (SELECT DISTINCT o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders)
        SELECT o_orderpriority, gap_days, count(*) AS n FROM (SELECT o_orderpriority, CAST(d - lag(d) OVER (PARTITION BY o_orderpriority ORDER BY d) AS INTEGER) AS gap_days FROM d) GROUP BY 1, 2""",
    ),
}
