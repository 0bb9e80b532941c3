"""Analysis marts and fiscal panels on the tidy table and the fiscal series."""

from pyspark.sql import functions as F

from panelwright.operators import aggregates, fiscal
from panelwright.operators.series import REAL_METRIC, add_deflated
from panelwright.plans import marts
from suite.inputs import BROKEN_VARIATION, FISCAL_SQL, NATION, TIDY_SQL, fiscal_quarters, table, tidy

COLS = ("VAB_Informal", "ISR", "IVA", "IMSS")
VAB = "indicador = 'vab_comercio_informal'"
# Products of two two-decimal numbers have four decimals; quotients are cut earlier.
DIGITS = {c: 4 if c in ("ISR", "IVA") else 2 for c in fiscal.PANEL_SUMS}
REAL = "metric = 'Millones de pesos a precios de 2018'"


def _rounded(df, *cols, digits=4):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def _k(mart):
    return lambda spark, sf: _rounded(_rounded(mart(tidy(spark, sf)), "valor", digits=2), "participacion_pct")


_SERIES = "SELECT indicador, {metric} AS metric, estado, periodo, fecha, round(valor, 2) AS valor FROM tidy WHERE {where}"


def _series_sql(where, metric="metric"):
    return f"WITH {TIDY_SQL} " + _SERIES.format(metric=metric, where=where)


def _k3(spark, sf):
    """State series, with the deflated wages that the deflation adds."""
    rows = tidy(spark, sf)
    wages = rows.filter("indicador = 'remuneraciones_comercio_informal'")
    rest = rows.filter("indicador <> 'remuneraciones_comercio_informal'")
    return _rounded(marts.k3(rest.unionByName(add_deflated(wages, rest))), "valor", digits=2)


def _taxes(spark, sf):
    """Monthly discounts and taxes of line items, summed by quarter."""
    price = F.col("l_extendedprice")
    items = table(
        spark, sf, "lineitem", "l_shipdate", (price * F.col("l_discount")).alias("Impuesto Sobre la Renta"), (price * F.col("l_tax")).alias("Impuesto al Valor Agregado"),
    )
    return aggregates.to_quarterly(items, "l_shipdate", {"Impuesto Sobre la Renta": "ISR", "Impuesto al Valor Agregado": "IVA"}).drop("n_months")


def _insurance(spark, sf):
    items = table(spark, sf, "lineitem", "l_shipdate", "l_quantity")
    return aggregates.to_quarterly(items, "l_shipdate", {"l_quantity": fiscal.INSURANCE}).drop("n_months")


def _panel(spark, sf):
    rows = tidy(spark, sf)
    wages = rows.filter("indicador = 'remuneraciones_comercio_informal'")
    rest = rows.filter("indicador <> 'remuneraciones_comercio_informal'")
    whole = rest.unionByName(add_deflated(wages, rest))
    return fiscal.fiscal_panel(whole, _taxes(spark, sf), _insurance(spark, sf))


_PANEL_SQL = f"""{TIDY_SQL}, {FISCAL_SQL}, m AS (SELECT fecha,
  sum(CASE WHEN {VAB} AND {REAL} THEN valor END) AS vab_informal_real_millones,
  sum(CASE WHEN indicador = 'remuneraciones_comercio_informal' AND metric = 'Millones de pesos a precios corrientes' THEN valor * 100 / (101 + 2 * (anio - 1995)) END)
    AS remuneraciones_informal_reales_millones,
  sum(CASE WHEN metric = 'Unidades' THEN valor END) AS puestos_trabajo_informal_unidades
  FROM tidy WHERE estado = '{NATION}' AND periodo LIKE 'T%' GROUP BY 1),
panel AS (SELECT fecha, vab_informal_real_millones, remuneraciones_informal_reales_millones, puestos_trabajo_informal_unidades, ISR, IVA,
  IMSS AS ingreso_obrero_patronal_nacional FROM m JOIN fiscal USING (fecha))"""


def _quarterly(spark, sf):
    out = fiscal.quarterly_ratios(_panel(spark, sf))
    return out.select(*[F.col(c) if c == "fecha" else F.round(c, DIGITS.get(c, 8)).alias(c) for c in out.columns])


def _annual(spark, sf):
    out = fiscal.annual_summary(_panel(spark, sf), stock_means=True)
    return out.select(*[F.col(c) if c == "anio" else F.round(c, DIGITS.get(c, 8)).alias(c) for c in out.columns])


def _nominal(spark, sf, include_cumulative=False):
    taxes = _taxes(spark, sf)
    insurance = _insurance(spark, sf).withColumnRenamed(fiscal.INSURANCE, "IMSS")
    return marts.fiscal_series(tidy(spark, sf), taxes, insurance, include_cumulative)


def _fiscal_series(cumulative):
    return lambda spark, sf: _rounded(_nominal(spark, sf, cumulative), *COLS, digits=4)


def _k8_levels(spark, sf):
    return _rounded(marts.k8_levels(fiscal_quarters(spark, sf), COLS), "corr", digits=8)


def _k8_base(spark, sf):
    out = marts.k8_base100(fiscal_quarters(spark, sf), COLS)
    return _rounded(out, *[c for c in out.columns if c != "fecha"], digits=6)


def _k8_cycles(spark, sf):
    out = marts.k8_cycles(fiscal_quarters(spark, sf), COLS)
    return _rounded(out, *[c for c in out.columns if c != "fecha"], digits=6)


def _k8_scatter(spark, sf):
    return _rounded(marts.k8_scatter(fiscal_quarters(spark, sf), "VAB_Informal", COLS[1:]), "alpha", "beta", "r2", digits=5)


def _k9(spark, sf):
    out = marts.k9(fiscal_quarters(spark, sf), "VAB_Informal", COLS[1:])
    keep = ("alpha", "beta", "r2", "adj_r2", "se_beta", "t_beta", "log_lik", "durbin_watson", "jarque_bera")
    return out.select("series", "n", *[F.round(c, 5).alias(c) for c in keep])


def _k10(spark, sf):
    return _rounded(marts.k10(fiscal_quarters(spark, sf), "VAB_Informal", "IMSS", ["ISR", "IVA", "IMSS"]), "value", digits=4)


def _k11(mart):
    """Profiles of the pairs of return flag and line number in line items."""
    def run(spark, sf):
        rows = table(spark, sf, "lineitem", "l_returnflag", F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("line"))
        return mart(rows, "l_returnflag", "line")
    return run


def _k11_single(spark, sf):
    rows = table(spark, sf, "events", F.col("event_id").cast("string").alias("event"), F.concat("event_type", F.lit("-"), F.col("user_id").cast("string")).alias("who"))
    return marts.k11_single(rows, "event", "who")


_REF = f"estado_tidy AS (SELECT * FROM tidy WHERE {VAB} AND {REAL} AND periodo = 'T4' AND fecha <= DATE '2024-12-31')"
_FISCAL_SPLIT = """nominal AS (SELECT {date} AS fecha, valor FROM tidy WHERE estado = 'Estados Unidos Mexicanos' AND indicador = 'vab_comercio_informal'
  AND metric = 'Millones de pesos a precios corrientes' {where})"""


def _fiscal_sql(cumulative):
    date = (
        "last_day(make_date(anio, CASE periodo WHEN 'T1' THEN 3 WHEN 'T2' THEN 6 WHEN 'T3' THEN 9 ELSE 12 END, 1))" if cumulative else "fecha"
    )
    split = _FISCAL_SPLIT.format(date=date, where="" if cumulative else "AND periodo LIKE 'T%'")
    return (
        f"WITH {TIDY_SQL}, {FISCAL_SQL}, {split} SELECT fecha, round(valor, 4) AS VAB_Informal, round(ISR, 4) AS ISR, round(IVA, 4) AS IVA, "
        "round(IMSS, 4) AS IMSS FROM nominal JOIN fiscal USING (fecha)"
    )


_GROWTH = f"""{FISCAL_SQL}, growth AS (SELECT a.fecha, {', '.join(f'a.{c} / b.{c} - 1 AS {c}' for c in COLS)} FROM fiscal a JOIN fiscal b
  ON year(a.fecha) = year(b.fecha) + 1 AND month(a.fecha) = month(b.fecha))"""
_FIT = FISCAL_SQL + ", long AS (" + " UNION ALL ".join(
    f"SELECT fecha, '{y}' AS series, ln(VAB_Informal) AS x, ln({y}) AS y FROM fiscal" for y in COLS[1:]
) + """), fit AS (SELECT series, count(*) AS n, regr_slope(y, x) AS beta, regr_intercept(y, x) AS alpha, regr_r2(y, x) AS r2, regr_sxx(y, x) AS sxx,
  regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x) AS ssr FROM long GROUP BY 1),
lagged AS (SELECT series, y - alpha - beta * x AS e, y - alpha - beta * x - lag(y - alpha - beta * x) OVER (PARTITION BY series ORDER BY fecha) AS d
  FROM long JOIN fit USING (series)),
mom AS (SELECT series, sum(d * d) / sum(e * e) AS dw, avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4 FROM lagged GROUP BY 1)"""

QUERIES = {
    "national_levels": (
        _k(marts.k1),
        _series_sql(
            f"estado = '{NATION}' AND (({VAB} AND metric IN ('Millones de pesos a precios corrientes', 'Millones de pesos a precios de 2018')) OR "
            "(indicador = 'remuneraciones_comercio_informal' AND metric = 'Millones de pesos a precios corrientes') OR metric = 'Unidades')"
        ),
    ),
    "national_index": (
        _k(marts.k2), _series_sql(f"estado = '{NATION}' AND metric IN ('Índice de volumen físico base 2018=100', 'Índice de valor 2018=100')"),
    ),
    "state_series": (
        _k3,
        f"WITH {TIDY_SQL} " + _SERIES.format(metric="metric", where=f"estado <> '{NATION}' AND (({VAB} AND {REAL}) OR metric = 'Unidades')")
        + f""" UNION ALL SELECT indicador, '{REAL_METRIC}', estado, periodo, fecha, round(valor * 100 / (101 + 2 * (anio - 1995)), 2) FROM tidy
        WHERE estado <> '{NATION}' AND indicador = 'remuneraciones_comercio_informal' AND metric = 'Millones de pesos a precios corrientes'""",
    ),
    "state_shares": (
        _k(marts.k4),
        f"""WITH {TIDY_SQL}, {_REF}, last AS (SELECT * FROM estado_tidy WHERE anio = (SELECT max(anio) FROM estado_tidy))
        SELECT s.estado, s.anio, round(s.valor, 2) AS valor, round(100 * s.valor / n.valor, 4) AS participacion_pct
        FROM last s JOIN last n ON n.estado = '{NATION}' WHERE s.estado <> '{NATION}'""",
    ),
    "state_ranking": (
        _k(marts.k4_top),
        f"""WITH {TIDY_SQL}, {_REF}, last AS (SELECT * FROM estado_tidy WHERE anio = (SELECT max(anio) FROM estado_tidy))
        SELECT s.estado, s.anio, round(s.valor, 2) AS valor, round(100 * s.valor / n.valor, 4) AS participacion_pct,
        row_number() OVER (ORDER BY s.valor DESC, s.estado) AS rank
        FROM last s JOIN last n ON n.estado = '{NATION}' WHERE s.estado <> '{NATION}' ORDER BY s.valor DESC, s.estado LIMIT 10""",
    ),
    "nation_and_leaders": (
        _k(marts.k5),
        f"""WITH {TIDY_SQL}, {_REF}, top AS (SELECT estado FROM estado_tidy WHERE estado <> '{NATION}' AND anio = (SELECT max(anio) FROM estado_tidy)
        ORDER BY valor DESC, estado LIMIT 5)
        SELECT s.estado, s.fecha, round(s.valor, 2) AS valor, round(100 * s.valor / n.valor, 4) AS participacion_pct FROM estado_tidy s
        JOIN estado_tidy n ON n.estado = '{NATION}' AND n.fecha = s.fecha WHERE s.estado = '{NATION}' OR s.estado IN (SELECT estado FROM top)""",
    ),
    "heat_long": (
        lambda spark, sf: _rounded(marts.k6_long(tidy(spark, sf)), "pct_of_max", digits=6),
        f"""WITH {TIDY_SQL}, {_REF} SELECT estado, anio, round(100 * valor / max(valor) OVER (PARTITION BY estado), 6) AS pct_of_max FROM estado_tidy WHERE estado <> '{NATION}'""",
    ),
    "heat_table": (
        lambda spark, sf: (lambda wide: wide.select("estado", *[F.round(f"`{y}`", 6).alias(f"y{y}") for y in range(1995, 2002)]))(
            marts.k6(tidy(spark, sf), range(1995, 2002))
        ),
        f"""WITH {TIDY_SQL}, {_REF}, h AS (SELECT estado, anio, round(100 * valor / max(valor) OVER (PARTITION BY estado), 6) AS p FROM estado_tidy WHERE estado <> '{NATION}')
        SELECT estado, {', '.join(f'sum(CASE WHEN anio = {y} THEN p END) AS y{y}' for y in range(1995, 2002))} FROM h GROUP BY 1""",
    ),
    "national_variation": (
        _k(marts.k7), _series_sql(f"estado = '{NATION}' AND metric = '{BROKEN_VARIATION}'", metric="'Variación porcentual anual'"),
    ),
    "fiscal_quarterly_ratios": (
        _quarterly,
        f"""WITH {_PANEL_SQL} SELECT fecha, {', '.join(f'round({c}, {d}) AS {c}' for c, d in DIGITS.items())},
        round(100 * ISR / vab_informal_real_millones, 8) AS ISR_sobre_VAB_informal_pct, round(100 * IVA / vab_informal_real_millones, 8) AS IVA_sobre_VAB_informal_pct,
        round(100 * ingreso_obrero_patronal_nacional / remuneraciones_informal_reales_millones, 8) AS IMSS_sobre_Remuneraciones_informal_pct FROM panel""",
    ),
    "fiscal_annual_summary": (
        _annual,
        f"""WITH {_PANEL_SQL} SELECT CAST(year(fecha) AS INTEGER) AS anio, {', '.join(f'round(sum({c}), {d}) AS {c}' for c, d in DIGITS.items())},
        round(avg(puestos_trabajo_informal_unidades), 8) AS puestos_trabajo_informal_unidades_mean,
        round(100 * (sum(ISR) + sum(IVA)) / sum(vab_informal_real_millones), 8) AS carga_fiscal_sobre_VAB_pct,
        round(100 * sum(ingreso_obrero_patronal_nacional) / sum(remuneraciones_informal_reales_millones), 8) AS imss_sobre_remuneraciones_pct
        FROM panel GROUP BY 1""",
    ),
    "fiscal_series": (_fiscal_series(False), _fiscal_sql(False)),
    "fiscal_series_with_totals": (_fiscal_series(True), _fiscal_sql(True)),
    "fiscal_correlations": (
        _k8_levels,
        f"WITH {FISCAL_SQL} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM fiscal" for a in COLS for b in COLS),
    ),
    "fiscal_base100": (
        _k8_base,
        f"WITH {FISCAL_SQL} SELECT fecha, " + ", ".join(f"round(100 * {c} / first_value({c}) OVER (ORDER BY fecha), 6) AS {c}_idx" for c in COLS) + " FROM fiscal",
    ),
    "fiscal_cycles": (
        _k8_cycles, f"WITH {_GROWTH} SELECT fecha, " + ", ".join(f"round(100 * {c}, 6) AS {c}_yoy_pct" for c in COLS) + " FROM growth",
    ),
    "fiscal_scatter_trend": (
        _k8_scatter,
        f"WITH {FISCAL_SQL} " + " UNION ALL ".join(
            f"SELECT '{y}' AS series, count(*) AS n, round(regr_intercept({y}, VAB_Informal), 5) AS alpha, round(regr_slope({y}, VAB_Informal), 5) AS beta, "
            f"round(regr_r2({y}, VAB_Informal), 5) AS r2 FROM fiscal" for y in COLS[1:]
        ),
    ),
    "fiscal_elasticities": (
        _k9,
        f"""WITH {_FIT} SELECT series, n, round(alpha, 5) AS alpha, round(beta, 5) AS beta, round(r2, 5) AS r2, round(1 - (1 - r2) * (n - 1) / (n - 2), 5) AS adj_r2,
        round(sqrt(ssr / (n - 2) / sxx), 5) AS se_beta, round(beta / sqrt(ssr / (n - 2) / sxx), 5) AS t_beta,
        round(-n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1), 5) AS log_lik, round(dw, 5) AS durbin_watson,
        round(n / 6.0 * (m3 * m3 / (m2 * m2 * m2) + pow(m4 / (m2 * m2) - 3, 2) / 4), 5) AS jarque_bera FROM fit JOIN mom USING (series)""",
    ),
    "fiscal_diagnosis": (
        _k10,
        f"""WITH {_GROWTH} SELECT 'mean_a' AS item, round(avg(VAB_Informal), 4) AS value FROM fiscal UNION ALL SELECT 'mean_b', round(avg(IMSS), 4) FROM fiscal
        UNION ALL SELECT 'ratio', round(avg(VAB_Informal) / avg(IMSS), 4) FROM fiscal """
        + " ".join(f"UNION ALL SELECT 'corr_{c}_yoy', round(corr(VAB_Informal, {c}), 4) FROM growth" for c in COLS[1:]),
    ),
    "profile_pairs": (
        _k11(marts.k11_pairs), "SELECT l_returnflag, l_linestatus || l_linenumber AS line, count(*) AS n_observaciones FROM lineitem GROUP BY 1, 2",
    ),
    "profile_single_partners": (
        _k11_single,
        """WITH r AS (SELECT CAST(event_id AS VARCHAR) AS e, event_type || '-' || user_id AS w FROM events)
        SELECT 'event' AS "column", e AS value, min(w) AS partner FROM r GROUP BY e HAVING count(DISTINCT w) = 1
        UNION ALL SELECT 'who', w, min(e) FROM r GROUP BY w HAVING count(DISTINCT e) = 1""",
    ),
}
