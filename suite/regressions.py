"""Regressions by group, from single rows to quarterly panels."""

from pyspark.sql import functions as F

from panelwright.operators import regression
from suite.inputs import FISCAL_FLAG_SQL, fiscal_by_flag, table

X, YS, BY = "VAB_Informal", ["ISR", "IVA", "IMSS"], ["l_returnflag"]


def _rows(log):
    def run(spark, sf):
        """Price and tax on quantity over every line item."""
        items = table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice", "l_tax")
        models = regression.ols(items, ["l_extendedprice", "l_tax"], "l_quantity", by=BY, log=log)
        return models.select("l_returnflag", "series", "n", *[F.round(c, 5).alias(c) for c in ("alpha", "beta", "r2", "x_min", "x_max")])
    return run


def _rows_sql(log):
    def measure(c):
        return f"CASE WHEN {c} > 0 THEN ln({c}) END" if log else c

    parts = []
    for y in ("l_extendedprice", "l_tax"):
        a = f"{measure(y)}, {measure('l_quantity')}"
        parts.append(
            f"""SELECT l_returnflag, '{y}' AS series, regr_count({a}) AS n, round(regr_intercept({a}), 5) AS alpha, round(regr_slope({a}), 5) AS beta,
            round(regr_r2({a}), 5) AS r2, round(min(CASE WHEN ({measure(y)}) IS NOT NULL THEN {measure('l_quantity')} END), 5) AS x_min,
            round(max(CASE WHEN ({measure(y)}) IS NOT NULL THEN {measure('l_quantity')} END), 5) AS x_max FROM lineitem GROUP BY 1"""
        )
    return " UNION ALL ".join(parts)


def _models(spark, sf):
    panel = fiscal_by_flag(spark, sf)
    return panel, regression.ols(panel, YS, X, by=BY)


# Long rows, fitted sums and residuals of the quarterly models, for the SQL twins.
_LONG = FISCAL_FLAG_SQL + ", long AS (" + " UNION ALL ".join(
    f"SELECT l_returnflag, fecha, '{y}' AS series, ln({X}) AS x, ln({y}) AS y FROM fiscal" for y in YS
) + """), fit AS (SELECT l_returnflag, series, count(*) AS n, regr_slope(y, x) AS beta, regr_intercept(y, x) AS alpha, regr_r2(y, x) AS r2,
  regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx, min(x) AS x0, max(x) AS x1 FROM long GROUP BY 1, 2),
sums AS (SELECT *, syy - beta * sxy AS ssr, (syy - beta * sxy) / (n - 2) AS s2 FROM fit),
ses AS (SELECT *, sqrt(s2 / sxx) AS se_beta, sqrt(s2 * (1.0 / n + mx * mx / sxx)) AS se_alpha, -n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1) AS ll FROM sums),
res AS (SELECT l_returnflag, series, fecha, y - alpha - beta * x AS e FROM long JOIN fit USING (l_returnflag, series)),
lagged AS (SELECT *, e - lag(e) OVER (PARTITION BY l_returnflag, series ORDER BY fecha) AS d FROM res),
mom AS (SELECT l_returnflag, series, count(*) AS n, sum(d * d) / sum(e * e) AS dw, avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4 FROM lagged GROUP BY 1, 2),
shape AS (SELECT *, m3 / pow(m2, 1.5) AS sk, m4 / (m2 * m2) AS ku FROM mom)"""


def _sums(spark, sf):
    out = regression.ols_sums(_models(spark, sf)[1])
    cols = ("se_beta", "se_alpha", "t_beta", "t_alpha", "adj_r2", "log_lik", "aic", "bic")
    return out.select("l_returnflag", "series", "n", *[F.round(c, 6).alias(c) for c in cols], F.round(F.col("f_stat"), 4).alias("f_stat"))


def _inference(spark, sf):
    out = regression.ols_inference(_models(spark, sf)[1])
    return out.select("l_returnflag", "series", *[F.round(c, 9).alias(c) for c in ("p_beta", "p_alpha", "p_f")])


def _tail_sql(t):
    """The two-sided tail of Student's t for n - 2 degrees of freedom, which for whole degrees is a finite sum."""
    angle = f"atan(abs({t}) / sqrt(n - 2))"
    even = f"list_sum(list_transform(range((n - 2) // 2), lambda k: exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)) * pow(cos({angle}), 2 * k)))"
    odd = f"coalesce(list_sum(list_transform(range((n - 3) // 2), lambda k: exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5)) * pow(cos({angle}), 2 * k + 1))), 0)"
    inner = f"CASE WHEN n % 2 = 0 THEN sin({angle}) * {even} ELSE 2 / pi() * ({angle} + sin({angle}) * {odd}) END"
    return f"round(1 - {inner}, 9) + 0.0"


def _bounds(spark, sf):
    """The confidence bounds enclose the estimates, and small p goes with large t."""
    out = regression.ols_inference(_models(spark, sf)[1])
    inside = (F.col("beta_low") < F.col("beta")) & (F.col("beta") < F.col("beta_high")) & (F.col("alpha_low") < F.col("alpha_high"))
    # 5% two-sided: the bound excludes zero exactly when p < 0.05.
    same = ((F.col("beta_low") > 0) | (F.col("beta_high") < 0)) == (F.col("p_beta") < 0.05)
    centred = F.round((F.col("beta_low") + F.col("beta_high")) / 2, 8)
    return out.select("l_returnflag", "series", inside.alias("inside"), same.alias("consistent"), centred.alias("beta"))


def _diagnostics(spark, sf):
    panel, models = _models(spark, sf)
    out = regression.ols_diagnostics(panel, models, YS, X, "fecha", by=BY)
    cols = ("durbin_watson", "skew", "kurtosis", "jarque_bera", "p_jarque_bera")
    return out.select("l_returnflag", "series", "n", *[F.round(c, 6).alias(c) for c in cols], F.round("condition_number", 3).alias("condition_number"), F.round("omnibus", 6).alias("omnibus"), F.round("p_omnibus", 8).alias("p_omnibus"))


_OMNIBUS = """z1 AS (SELECT *, sk * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS yy,
  -1 + sqrt(2 * (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) - 1)) AS w2,
  (ku - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) * (n + 1) * (n + 3) * (n + 5))) AS xk,
  6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))) AS rb FROM shape),
z2 AS (SELECT *, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS aa, asinh(yy / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS zs FROM z1),
z3 AS (SELECT *, ((1 - 2 / (9 * aa)) - cbrt((1 - 2 / aa) / (1 + xk * sqrt(2 / (aa - 4))))) / sqrt(2 / (9 * aa)) AS zk FROM z2)"""


def _line(spark, sf):
    out = regression.fitted_line(_models(spark, sf)[1], by=BY)
    return out.select("l_returnflag", "series", "point", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def _elasticity(spark, sf):
    out = regression.elasticity_table(_models(spark, sf)[1], by=BY)
    return out.select("l_returnflag", "series", *[F.round(c, 8).alias(c) for c in ("beta", "r2", "distance_from_unit")], "elasticity")


QUERIES = {
    "ols_log_rows": (_rows(True), _rows_sql(True)),
    "ols_level_rows": (_rows(False), _rows_sql(False)),
    "ols_sums": (
        _sums,
        f"""WITH {_LONG} SELECT l_returnflag, series, n, round(se_beta, 6) AS se_beta, round(se_alpha, 6) AS se_alpha, round(beta / se_beta, 6) AS t_beta,
        round(alpha / se_alpha, 6) AS t_alpha, round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS adj_r2, round(ll, 6) AS log_lik, round(4 - 2 * ll, 6) AS aic,
        round(2 * ln(n) - 2 * ll, 6) AS bic, round(pow(beta / se_beta, 2), 4) AS f_stat FROM ses""",
    ),
    "ols_inference": (
        _inference,
        f"WITH {_LONG} SELECT l_returnflag, series, {_tail_sql('beta / se_beta')} AS p_beta, {_tail_sql('alpha / se_alpha')} AS p_alpha, {_tail_sql('beta / se_beta')} AS p_f FROM ses",
    ),
    "ols_inference_bounds": (
        _bounds, f"WITH {_LONG} SELECT l_returnflag, series, true AS inside, true AS consistent, round(beta, 8) AS beta FROM fit",
    ),
    "ols_diagnostics": (
        _diagnostics,
        f"""WITH {_LONG}, {_OMNIBUS} SELECT l_returnflag, series, z3.n, round(dw, 6) AS durbin_watson, round(sk, 6) AS skew, round(ku, 6) AS kurtosis,
        round(z3.n / 6.0 * (sk * sk + (ku - 3) * (ku - 3) / 4), 6) AS jarque_bera, round(exp(-z3.n / 12.0 * (sk * sk + (ku - 3) * (ku - 3) / 4)), 6) AS p_jarque_bera,
        round(((fit.n + sxx + fit.n * mx * mx) + sqrt(pow(fit.n + sxx + fit.n * mx * mx, 2) - 4 * fit.n * sxx)) / 2 / sqrt(fit.n * sxx), 3) AS condition_number,
        round(zs * zs + zk * zk, 6) AS omnibus, round(exp(-(zs * zs + zk * zk) / 2), 8) AS p_omnibus FROM z3 JOIN fit USING (l_returnflag, series)""",
    ),
    "fitted_line": (
        _line,
        f"""WITH {_LONG} SELECT l_returnflag, series, CAST(i AS INTEGER) AS point, round(x0 + i * (x1 - x0) / 99, 6) AS x,
        round(alpha + beta * (x0 + i * (x1 - x0) / 99), 6) AS y FROM fit, range(100) r(i)""",
    ),
    "elasticity_table": (
        _elasticity,
        f"""WITH {_LONG} SELECT l_returnflag, series, round(beta, 8) AS beta, round(r2, 8) AS r2, round(beta - 1, 8) AS distance_from_unit,
        CASE WHEN beta > 1 THEN 'elastic' WHEN beta < 1 THEN 'inelastic' ELSE 'unit' END AS elasticity FROM fit""",
    ),
}
