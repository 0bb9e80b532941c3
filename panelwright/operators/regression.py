"""Simple regression by group, from mergeable sums.

One pass computes centred sums for every group and dependent column; the rest is
arithmetic on one row per model.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.joins import null_safe_join
from panelwright.operators.ordered import with_previous


def log_measures(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Natural logs in place; values that are not positive become null."""
    return df.withColumns({c: F.when(F.col(c) > 0, F.ln(c)) for c in cols})


def _measure(name: str, log: bool) -> Column:
    c = F.col(name).cast("double")
    return F.when(c > 0, F.ln(c)) if log else c


def ols(df: DataFrame, y: Sequence[str], x: str, by: Sequence[str] = (), log: bool = True) -> DataFrame:
    """Regress each column of ``y`` on ``x`` with a constant, per group.

    One row per (group, series): n, alpha, beta, r2 and the sums behind them.
    """
    xs = _measure(x, log)
    fits = []
    for name in y:
        ys = _measure(name, log)
        # The range and the means count complete pairs only, as the sums do.
        paired = F.when(ys.isNotNull(), xs)
        fits.append(
            F.struct(
                F.lit(name).alias("series"),
                F.regr_count(ys, xs).alias("n"),
                F.regr_sxx(ys, xs).alias("sxx"),
                F.regr_sxy(ys, xs).alias("sxy"),
                F.regr_syy(ys, xs).alias("syy"),
                F.regr_avgx(ys, xs).alias("mean_x"),
                F.regr_avgy(ys, xs).alias("mean_y"),
                F.min(paired).alias("x_min"),
                F.max(paired).alias("x_max"),
            )
        )
    sums = df.groupBy(*by).agg(F.array(*fits).alias("_fits")).select(*by, F.inline("_fits"))
    return (
        sums.withColumn("beta", F.try_divide("sxy", "sxx"))
        .withColumn("alpha", F.col("mean_y") - F.col("beta") * F.col("mean_x"))
        .withColumn("r2", F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy")))
    )


def _student_t():
    """Two pandas UDFs on (value, degrees of freedom): two-sided tail, and its inverse."""
    # Everything lives inside so that the functions travel to executors by value.

    def beta_fraction(a, b, x):
        import numpy as np

        # Lentz's continued fraction for the incomplete beta function.
        tiny = 1e-300
        c = np.ones_like(x)
        d = 1.0 - (a + b) * x / (a + 1.0)
        d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
        h = d.copy()
        m = 0
        while True:  # the fraction converges for all arguments used, in about sqrt(a) steps
            m += 1
            for num in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 + num * d
                d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
                c = 1.0 + num / c
                c = np.where(np.abs(c) < tiny, tiny, c)
                step = c * d
                h = h * step
            if np.all(np.abs(step - 1.0) < 1e-15):
                break
        return h

    def gamma_step(a):
        import math

        # ln(gamma(a + 1/2) / gamma(a)): the expansion is exact to rounding from here on, where the difference loses digits.
        if a < 200:
            return math.lgamma(a + 0.5) - math.lgamma(a)
        return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)

    def two_sided(t, dof):
        import math

        import numpy as np

        t = np.abs(np.asarray(t, dtype=float))
        dof = np.asarray(dof, dtype=float)
        out = np.full(t.shape, np.nan)
        ok = (dof > 0) & ~np.isnan(t)
        v, n = t[ok], dof[ok]
        x = n / (n + v * v)
        a, b = n / 2.0, np.full(n.shape, 0.5)
        log_beta = math.lgamma(0.5) - np.array([gamma_step(p) for p in a])
        with np.errstate(divide="ignore"):
            front = np.exp(-a * np.log1p(v * v / n) + b * np.log(v * v / (n + v * v)) - log_beta)
        direct = x < (a + 1.0) / (a + b + 2.0)
        low = front * beta_fraction(a, b, np.where(direct, x, 0.0)) / a
        high = 1.0 - front * beta_fraction(b, a, np.where(direct, 0.0, 1.0 - x)) / b
        out[ok] = np.where(v == 0, 1.0, np.where(direct, low, high))
        return out

    def inverse(level, dof):
        import numpy as np

        level, dof = np.asarray(level, dtype=float), np.asarray(dof, dtype=float)
        low, high = np.zeros(level.shape), np.ones(level.shape)
        for _ in range(200):
            short = two_sided(high, dof) > level
            if not short.any():
                break
            high = np.where(short, high * 2.0, high)
        for _ in range(100):
            mid = (low + high) / 2.0
            above = two_sided(mid, dof) > level
            low, high = np.where(above, mid, low), np.where(above, high, mid)
        return np.where(dof > 0, (low + high) / 2.0, np.nan)

    def tail(t: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(two_sided(t, dof))

    def quantile(level: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(inverse(level, dof))

    return F.pandas_udf(tail, "double"), F.pandas_udf(quantile, "double")


def ols_sums(models: DataFrame) -> DataFrame:
    """Standard errors, t, F and likelihood figures: closed forms on the model row."""
    n, dof = F.col("n"), F.col("n") - 2
    usable = dof > 0
    return (
        models.withColumn("ssr", F.greatest(F.col("syy") - F.col("beta") * F.col("sxy"), F.lit(0.0)))
        .withColumn("s2", F.when(usable, F.col("ssr") / F.nullif(dof, F.lit(0))))
        .withColumn("se_beta", F.sqrt(F.try_divide("s2", "sxx")))
        .withColumn(
            "se_alpha",
            F.sqrt(F.col("s2") * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.col("mean_x") * F.col("mean_x"), F.col("sxx")))),
        )
        .withColumn("t_beta", F.try_divide("beta", "se_beta"))
        .withColumn("t_alpha", F.try_divide("alpha", "se_alpha"))
        .withColumn("adj_r2", F.when(usable, 1 - (1 - F.col("r2")) * (n - 1) / F.nullif(dof, F.lit(0))))
        .withColumn("f_stat", F.col("t_beta") * F.col("t_beta"))
        .withColumn(
            "log_lik",
            F.when(
                F.col("ssr") > 0,
                F.lit(-0.5) * n * (F.ln(F.lit(2.0) * F.pi()) + F.ln(F.col("ssr") / n) + 1),
            ),
        )
        .withColumn("aic", F.lit(4.0) - 2 * F.col("log_lik"))
        .withColumn("bic", 2 * F.ln(n.cast("double")) - 2 * F.col("log_lik"))
    )


def ols_inference(models: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds p-values and confidence bounds to :func:`ols_sums`.

    The only Python here runs on one row per model.
    """
    tail, quantile = _student_t()
    dof = (F.col("n") - 2).cast("double")
    out = (
        ols_sums(models)
        .withColumn("p_beta", tail("t_beta", dof))
        .withColumn("p_alpha", tail("t_alpha", dof))
        .withColumn("p_f", F.col("p_beta"))
        .withColumn("_t", quantile(F.lit(alpha), dof))
    )
    for name in ("alpha", "beta"):
        reach = F.col("_t") * F.col(f"se_{name}")
        out = out.withColumn(f"{name}_low", F.col(name) - reach).withColumn(f"{name}_high", F.col(name) + reach)
    return out.drop("_t")


def residuals(
    df: DataFrame, models: DataFrame, y: Sequence[str], x: str, order: str, by: Sequence[str] = (), log: bool = True
) -> DataFrame:
    """(group, series, order, resid) for a panel with one row per group and ``order``."""
    rows = F.array(*[F.struct(F.lit(c).alias("series"), _measure(c, log).alias("_y")) for c in y])
    long = df.select(*by, order, _measure(x, log).alias("_x"), F.inline(rows)).filter(
        "_x is not null and _y is not null"
    )
    coefs = models.select(*by, "series", "alpha", "beta")
    fitted = F.col("alpha") + F.col("beta") * F.col("_x")
    return null_safe_join(long, coefs, [*by, "series"]).select(*by, "series", order, (F.col("_y") - fitted).alias("resid"))


def normality(n: Column, skew: Column, kurt: Column) -> dict[str, Column]:
    """Jarque-Bera and the omnibus K2 test with their p-values (kurtosis is 3 for a normal)."""
    n = n.cast("double")
    jb = n / 6 * (skew * skew + (kurt - 3) * (kurt - 3) / 4)
    # D'Agostino's transformation of the skewness to a standard normal.
    ys = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    b2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (b2 - 1)) - 1
    z_skew = F.asinh(ys / F.sqrt(2 / (w2 - 1))) / F.sqrt(F.ln(w2) / 2)
    # Anscombe and Glynn's transformation of the kurtosis.
    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    xk = (kurt - mean) / F.sqrt(var)
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    z_kurt = (1 - 2 / (9 * a) - F.cbrt((1 - 2 / a) / (1 + xk * F.sqrt(2 / (a - 4))))) / F.sqrt(2 / (9 * a))
    enough = n >= 8
    omnibus = F.when(enough, z_skew * z_skew + z_kurt * z_kurt)
    return {
        "jarque_bera": jb,
        "p_jarque_bera": F.exp(-jb / 2),
        "omnibus": omnibus,
        "p_omnibus": F.exp(-omnibus / 2),
    }


def ols_diagnostics(
    df: DataFrame, models: DataFrame, y: Sequence[str], x: str, order: str, by: Sequence[str] = (), log: bool = True
) -> DataFrame:
    """Durbin-Watson, skew, kurtosis, normality tests and condition number per model.

    ``df`` is a panel: one row per group and date. The residual before each one is carried
    over slices of the dates, so one long series is spread over all tasks.
    """
    keys = [*by, "series"]
    resid = with_previous(residuals(df, models, y, x, order, by, log), {"_before": "resid"}, order, keys)
    moments = (
        resid.withColumn("_step", F.col("resid") - F.col("_before"))
        .groupBy(*keys)
        .agg(
            F.count("resid").alias("n"),
            F.try_divide(F.sum(F.col("_step") * F.col("_step")), F.sum(F.col("resid") * F.col("resid"))).alias("durbin_watson"),
            F.skewness("resid").alias("skew"),
            (F.kurtosis("resid") + 3).alias("kurtosis"),
        )
    )
    tested = moments.withColumns(normality(F.col("n"), F.col("skew"), F.col("kurtosis")))
    # Eigenvalues of the 2x2 cross-product matrix; the small one from the determinant.
    det = F.col("n") * F.col("sxx")
    trace = F.col("n") + F.col("sxx") + F.col("n") * F.col("mean_x") * F.col("mean_x")
    largest = (trace + F.sqrt(trace * trace - 4 * det)) / 2
    condition = models.select(*keys, F.try_divide(largest, F.sqrt(det)).alias("condition_number"))
    return null_safe_join(tested, condition, keys)


def fitted_line(models: DataFrame, by: Sequence[str] = (), points: int = 100) -> DataFrame:
    """Evenly spaced x over the observed range, with the fitted y."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    spread = models.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    xs = F.col("x_min") + F.col("point") * step
    return spread.select(*by, "series", "point", xs.alias("x"), (F.col("alpha") + F.col("beta") * xs).alias("y"))


def elasticity_table(models: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Slope of each log-log model against unit elasticity."""
    beta = F.col("beta")
    side = F.when(beta > 1, "elastic").when(beta < 1, "inelastic").when(beta == 1, "unit")
    return models.select(*by, "series", "beta", "r2", (beta - 1).alias("distance_from_unit"), side.alias("elasticity"))
