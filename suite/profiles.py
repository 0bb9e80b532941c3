"""Aggregates and profiles over whole tables."""

from pyspark.sql import functions as F

from panelwright.operators import aggregates, joins, profile
from suite.inputs import FISCAL_SQL, fiscal_quarters, table


def _quarterly(spark, sf):
    """Order totals by quarter for each status; the gaps of undated rows and of empty quarters are filled with 0."""
    orders = table(
        spark, sf, "orders", "o_orderstatus", F.expr("CASE WHEN NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'F') THEN o_orderdate END AS o_orderdate"),
        F.col("o_totalprice").alias("Impuesto Sobre la Renta"), F.when(F.quarter("o_orderdate") != 3, F.col("o_totalprice")).alias("iva"),
    )
    q = aggregates.to_quarterly(orders, "o_orderdate", {"Impuesto Sobre la Renta": "ISR", "iva": "IVA"}, by=["o_orderstatus"])
    return q.select("o_orderstatus", "fecha", F.round("ISR", 2).alias("ISR"), F.round("IVA", 2).alias("IVA"), "n_months")


def _complete(spark, sf):
    q = aggregates.to_quarterly(table(spark, sf, "orders", "o_orderdate", "o_totalprice"), "o_orderdate", ["o_totalprice"], complete_only=True)
    return q.select("fecha", F.round("o_totalprice", 2).alias("total"))


def _sums(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", F.col("o_orderdate").cast("date").alias("fecha"), "o_totalprice")
    out = aggregates.sum_by(orders, ["o_orderpriority", "fecha"], "o_totalprice", "valor")
    return out.withColumn("valor", F.round("valor", 2))


def _pairs(spark, sf):
    rows = table(spark, sf, "events", "event_type", F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    return aggregates.pair_counts(rows, "event_type", "user_id")


def _distinct(approx):
    def run(spark, sf):
        return profile.distinct_counts(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"], approx)
    return run


_COUNTED = ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")


def _approximate(spark, sf):
    """Whether the sketch lies within three times its stated error, 5 percent, of the exact count."""
    near = _distinct(True)(spark, sf).withColumnRenamed("n_distinct", "near")
    return near.join(_distinct(False)(spark, sf), "column").select("column", (F.abs(F.col("near") - F.col("n_distinct")) <= 0.15 * F.col("n_distinct")).alias("within"))


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem", *_MEASURES), _MEASURES)
    return out.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


def _describe_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
        round(max({c}), 6) AS max FROM lineitem""" for c in cols
    )


def _center(spark, sf):
    out = profile.center_stats(table(spark, sf, "events", "value", "user_id"), ["value", "user_id"])
    return out.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "median", "q25", "q75")], F.array_join(F.transform("modes", lambda m: F.round(m, 2).cast("string")), "|").alias("modes"))


def _center_sql(cols):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.5), 6) AS median,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.75), 6) AS q75,
        (SELECT string_agg(CAST(CAST(v AS DOUBLE) AS VARCHAR), '|' ORDER BY v) FROM (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM events GROUP BY 1)
          WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM events GROUP BY {c})) ORDER BY v LIMIT 3)) AS modes FROM events""" for c in cols
    )


def _value_counts(spark, sf):
    rows = table(spark, sf, "customer", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))
    kept = aggregates.value_counts(rows, "segment", n=3, dropna=False).withColumn("nulls", F.lit("kept"))
    return kept.unionByName(aggregates.value_counts(rows, "segment").withColumn("nulls", F.lit("dropped")))


def _single(spark, sf):
    rows = table(spark, sf, "lineitem", F.col("l_suppkey").alias("a"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("b"), "l_orderkey")
    by_order = aggregates.single_partner(rows.withColumn("a", F.col("l_orderkey")), "a", "b")
    other = aggregates.single_partner(rows.withColumn("k", F.col("l_orderkey") * 10 + F.col("a") % 10), "b", "k")
    return by_order.select(F.col("a").cast("string").alias("value"), "partner", "n_partners").unionByName(
        other.select(F.col("b").alias("value"), F.col("partner").cast("string").alias("partner"), "n_partners")
    )


def _nulls(spark, sf):
    rows = table(spark, sf, "documents", "doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return aggregates.null_counts(rows, ["doc_id", "quality", "toxic"])


def _keep_first(spark, sf):
    orders = table(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey", "o_totalprice")
    return joins.keep_first(orders, ["o_orderpriority", "o_orderstatus"], ["o_orderdate", "o_orderkey"]).select(
        "o_orderpriority", "o_orderstatus", "o_orderkey", "o_totalprice"
    )


def _annual(spark, sf):
    panel = fiscal_quarters(spark, sf)
    ratio = {"isr_pct": F.try_divide(F.lit(100.0) * F.col("ISR"), F.col("VAB_Informal"))}
    out = aggregates.annual_rollup(panel, ["VAB_Informal", "ISR"], means=["IMSS"], ratios=ratio)
    return out.select("anio", F.round("VAB_Informal", 2).alias("vab"), F.round("ISR", 4).alias("isr"), F.round("IMSS_mean", 6).alias("imss_mean"), F.round("isr_pct", 8).alias("isr_pct"))


def _temporal(spark, sf):
    one = profile.temporal_profile(fiscal_quarters(spark, sf), "fecha").withColumn("serie", F.lit("fiscal"))
    events = profile.temporal_profile(table(spark, sf, "events", "event_type", "ts"), "ts", by=["event_type"])
    orders = profile.temporal_profile(table(spark, sf, "orders", "o_custkey", "o_orderdate"), "o_orderdate", by=["o_custkey"])
    return one.unionByName(events.withColumnRenamed("event_type", "serie")).unionByName(
        orders.withColumn("o_custkey", F.col("o_custkey").cast("string")).withColumnRenamed("o_custkey", "serie")
    )


def _temporal_sql():
    part = """SELECT {key} AS serie, min(d) AS first, max(d) AS last, count(*) AS n_obs, CAST(floor(quantile_cont(gap, 0.5)) AS INTEGER) AS median_gap_days
    FROM (SELECT {key}, d, d - lag(d) OVER (PARTITION BY {key} ORDER BY d) AS gap FROM {src}) GROUP BY 1"""
    return "WITH " + FISCAL_SQL + ", " + "e AS (SELECT event_type, CAST(ts AS DATE) AS d FROM events), " \
        "o AS (SELECT CAST(o_custkey AS VARCHAR) AS c, CAST(o_orderdate AS DATE) AS d FROM orders), f AS (SELECT 'fiscal' AS s, CAST(fecha AS DATE) AS d FROM fiscal) " \
        + " UNION ALL ".join([part.format(key="s", src="f"), part.format(key="event_type", src="e"), part.format(key="c", src="o")])


def _shape(spark, sf):
    return profile.shape(table(spark, sf, "events"))


def _corr(spark, sf):
    rows = table(spark, sf, "lineitem", "l_returnflag", *_MEASURES, F.lit(1.0).alias("fixed"))
    out = profile.corr_matrix(rows, [*_MEASURES, "fixed"], by=["l_returnflag"])
    return out.select("l_returnflag", "a", "b", F.round("corr", 8).alias("corr"))


def _corr_sql():
    cols = [*_MEASURES, "fixed"]
    cells = []
    for a in cols:
        for b in cols:
            value = "CAST(NULL AS DOUBLE)" if "fixed" in (a, b) else f"round(corr({a}, {b}), 8)"
            cells.append(f"SELECT l_returnflag, '{a}' AS a, '{b}' AS b, {value} AS corr FROM lineitem GROUP BY 1")
    return " UNION ALL ".join(cells)


def _ratio(spark, sf):
    out = profile.magnitude_ratio(fiscal_quarters(spark, sf), "VAB_Informal", "IMSS")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


QUERIES = {
    "to_quarterly": (
        _quarterly,
        """WITH kept AS (SELECT * FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderstatus = 'F')),
        span AS (SELECT o_orderstatus AS s, unnest(generate_series(date_trunc('quarter', min(o_orderdate)), max(o_orderdate), INTERVAL 3 MONTH)) AS q FROM kept GROUP BY 1)
        SELECT s AS o_orderstatus, last_day(q + INTERVAL 2 MONTH) AS fecha, round(coalesce(sum(o_totalprice), 0), 2) AS ISR,
        round(coalesce(sum(CASE WHEN quarter(o_orderdate) <> 3 THEN o_totalprice END), 0), 2) AS IVA,
        CAST(count(DISTINCT month(o_orderdate)) AS INTEGER) AS n_months
        FROM span LEFT JOIN kept ON o_orderstatus = s AND date_trunc('quarter', o_orderdate) = q GROUP BY s, q""",
    ),
    "to_quarterly_complete": (
        _complete,
        """SELECT last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS fecha, round(sum(o_totalprice), 2) AS total FROM orders
        GROUP BY 1 HAVING count(DISTINCT month(o_orderdate)) = 3""",
    ),
    "sum_by": (
        _sums, "SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS fecha, round(sum(o_totalprice), 2) AS valor FROM orders GROUP BY 1, 2",
    ),
    "pair_counts": (
        _pairs, "SELECT event_type, user_id, count(*) AS n_observaciones FROM events WHERE user_id % 5 <> 0 GROUP BY 1, 2",
    ),
    "distinct_counts": (
        _distinct(False),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM lineitem"""
            for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
        ),
    ),
    "distinct_counts_approx": (
        _approximate, " UNION ALL ".join(f"""SELECT '{c}' AS "column", true AS within FROM lineitem HAVING count(*) > 0""" for c in _COUNTED),
    ),
    "describe": (_describe, _describe_sql(_MEASURES)),
    "center_stats": (_center, _center_sql(["value", "user_id"])),
    "value_counts": (
        _value_counts,
        """WITH c AS (SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment, count(*) AS n FROM customer GROUP BY 1)
        (SELECT segment, n, 'kept' AS nulls FROM c ORDER BY n DESC, segment NULLS LAST LIMIT 3)
        UNION ALL SELECT segment, n, 'dropped' FROM c WHERE segment IS NOT NULL""",
    ),
    "single_partner": (
        _single,
        """WITH r AS (SELECT l_orderkey AS o, l_returnflag || l_linenumber AS b, l_orderkey * 10 + l_suppkey % 10 AS k FROM lineitem)
        SELECT CAST(o AS VARCHAR) AS value, min(b) AS partner, 1 AS n_partners FROM r GROUP BY o HAVING count(DISTINCT b) = 1
        UNION ALL SELECT b, CAST(min(k) AS VARCHAR), 1 FROM r GROUP BY b HAVING count(DISTINCT k) = 1""",
    ),
    "null_counts": (
        _nulls,
        """SELECT 'doc_id' AS "column", CAST(0 AS BIGINT) AS n_null UNION ALL SELECT c, count(*) FROM documents d, (VALUES ('quality'), ('toxic')) v(c)
        WHERE NOT EXISTS (FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1""",
    ),
    "keep_first": (
        _keep_first,
        """SELECT o_orderpriority, o_orderstatus, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus
        ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k = 1""",
    ),
    "annual_rollup": (
        _annual,
        f"""WITH {FISCAL_SQL} SELECT CAST(year(fecha) AS INTEGER) AS anio, round(sum(VAB_Informal), 2) AS vab, round(sum(ISR), 4) AS isr,
        round(avg(IMSS), 6) AS imss_mean, round(100 * sum(ISR) / sum(VAB_Informal), 8) AS isr_pct FROM fiscal GROUP BY 1""",
    ),
    "temporal_profile": (_temporal, _temporal_sql()),
    "shape": (
        _shape,
        """SELECT (SELECT count(*) FROM events) AS n_rows, 6 AS n_columns, position, "column", dtype FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'),
        (2, 'user_id', 'bigint'), (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string')) v(position, "column", dtype)""",
    ),
    "corr_matrix": (_corr, _corr_sql()),
    "magnitude_ratio": (
        _ratio,
        f"""WITH {FISCAL_SQL} SELECT round(avg(VAB_Informal), 4) AS mean_a, round(avg(IMSS), 4) AS mean_b, round(avg(VAB_Informal) / avg(IMSS), 4) AS ratio FROM fiscal""",
    ),
}
