import math

import pytest
from pyspark.sql import functions as F

from panelwright.operators import fiscal, regression
from panelwright.plans import marts

# Four published quarters of the fiscal panel.
QUARTERS = [
    ("2010-03-31", 1422811.988, 179446.7929697965, 1816890.0, 173724.58000000002, 131175.78100000002, 38859.0, 12.209946322155956, 9.219473978736255, 21.654886864732397),
    ("2010-06-30", 1484186.29, 183418.6728220401, 1862466.0, 152084.123, 118488.984, 40907.0, 10.246969940680424, 7.983430705319343, 22.302527529293354),
    ("2010-09-30", 1513574.545, 189449.1762039993, 1920476.0, 144706.301, 126625.511, 42113.0, 9.560566506488124, 8.365991051996716, 22.229180851466268),
]
# Published regression figures (n, log-likelihood, AIC, BIC, t of both
# coefficients, F probability, skew, kurtosis, Jarque-Bera, omnibus).
REPORT = [
    (105, 29.607, -55.21, -49.91, 22.719, 6.56e-42, 0.741, 3.309, 10.037, 9.895),
    (105, 85.272, -166.5, -161.2, 30.054, 8.69e-53, 0.450, 2.890, 3.602, 3.710),
    (105, 110.46, -216.9, -211.6, 43.005, 1.27e-67, 2.063, 13.899, 594.160, 71.758),
]


def test_published_ratios(spark):
    names = ", ".join(f"{c} double" for c in (*fiscal.PANEL_SUMS, "x", "y", "z"))
    df = spark.createDataFrame(QUARTERS, f"fecha string, {names}")
    got = fiscal.quarterly_ratios(df).collect()
    for r in got:
        assert r["ISR_sobre_VAB_informal_pct"] == pytest.approx(r["x"], rel=1e-12)
        assert r["IVA_sobre_VAB_informal_pct"] == pytest.approx(r["y"], rel=1e-12)
        assert r["IMSS_sobre_Remuneraciones_informal_pct"] == pytest.approx(r["z"], rel=1e-12)
    year = fiscal.annual_summary(df.withColumn("fecha", F.col("fecha").cast("date")), stock_means=True).first()
    assert year[fiscal.JOBS] == 5599832.0 and year[f"{fiscal.JOBS}_mean"] == pytest.approx(5599832 / 3)


@pytest.mark.parametrize("n, ll, aic, bic, t, p, skew, kurt, jb, omnibus", REPORT)
def test_published_identities(spark, n, ll, aic, bic, t, p, skew, kurt, jb, omnibus):
    assert 4 - 2 * ll == pytest.approx(aic, abs=0.06) and 2 * math.log(n) - 2 * ll == pytest.approx(bic, abs=0.06)
    tail, _ = regression._student_t()
    tests = regression.normality(F.lit(n), F.lit(skew), F.lit(kurt))
    row = spark.range(1).select(tail(F.lit(t), F.lit(float(n - 2))), tests["jarque_bera"], tests["omnibus"]).first()
    assert row[0] == pytest.approx(p, rel=0.02) and row[1] == pytest.approx(jb, rel=2e-3) and row[2] == pytest.approx(omnibus, rel=2e-3)


def test_student_t_against_tables(spark):
    # Two-sided 5% points.
    points = [(1.0, 12.7062047), (2.0, 4.3026527), (10.0, 2.2281389), (103.0, 1.9832641), (5e6, 1.9599640)]
    tail, quantile = regression._student_t()
    df = spark.createDataFrame(points, "dof double, t double")
    for r in df.select("t", quantile(F.lit(0.05), "dof").alias("q"), tail("t", "dof").alias("p"), tail(F.lit(0.0), "dof").alias("one")).collect():
        assert r["q"] == pytest.approx(r["t"], rel=1e-5) and r["p"] == pytest.approx(0.05, rel=1e-5) and r["one"] == 1.0


def sample(spark):
    return spark.range(1, 61).select(
        F.add_months(F.lit("2000-01-31").cast("date"), F.col("id").cast("int") * 3).alias("fecha"),
        F.exp(F.col("id") / 20).alias("x"),
        F.exp(F.lit(1.0) + F.col("id") / 25 + F.sin(F.col("id") * 1.7) / 5).alias("y"),
        F.when(F.col("id") % 10 != 0, F.col("id") * 1.0).alias("z"),
    )


def test_against_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = sample(spark)
    logs = regression.log_measures(df, ["x", "y"])
    data = VectorAssembler(inputCols=["x"], outputCol="features").transform(logs)
    fit = LinearRegression(labelCol="y", solver="normal").fit(data)
    ours = regression.ols_inference(regression.ols(df, ["y"], "x")).first()
    assert ours["beta"] == pytest.approx(fit.coefficients[0], rel=1e-9) and ours["alpha"] == pytest.approx(fit.intercept, rel=1e-9)
    s = fit.summary
    assert [ours["se_beta"], ours["se_alpha"]] == pytest.approx(s.coefficientStandardErrors, rel=1e-7)
    assert [ours["p_beta"], ours["p_alpha"]] == pytest.approx(s.pValues, rel=1e-4, abs=1e-14)
    assert ours["r2"] == pytest.approx(s.r2, rel=1e-9) and ours["adj_r2"] == pytest.approx(s.r2adj, rel=1e-9)


def test_diagnostics_against_numpy(spark):
    import numpy as np

    df = sample(spark)
    pdf = df.toPandas().sort_values("fecha")
    lx, ly = np.log(pdf["x"].to_numpy()), np.log(pdf["y"].to_numpy())
    design = np.column_stack([np.ones_like(lx), lx])
    coef, *_ = np.linalg.lstsq(design, ly, rcond=None)
    e = ly - design @ coef
    eig = np.linalg.eigvalsh(design.T @ design)
    got = marts.k9(df, "x", ["y"]).first()
    assert got["durbin_watson"] == pytest.approx((np.diff(e) ** 2).sum() / (e**2).sum(), rel=1e-9)
    m = [(e**k).mean() for k in (2, 3, 4)]
    assert got["skew"] == pytest.approx(m[1] / m[0] ** 1.5, rel=1e-8) and got["kurtosis"] == pytest.approx(m[2] / m[0] ** 2, rel=1e-9)
    assert got["condition_number"] == pytest.approx(math.sqrt(eig[-1] / eig[0]), rel=1e-8)
    assert got["beta_low"] < coef[1] < got["beta_high"]


def test_degenerate_models(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0), (-1.0, 4.0)], "x double, y double")
    r = regression.ols_inference(regression.ols(flat, ["y"], "x")).first()
    assert r["n"] == 2 and r["beta"] is None and r["se_beta"] is None
    two = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    r = regression.ols_inference(regression.ols(two, ["y"], "x", log=False)).first()
    assert r["beta"] == pytest.approx(1.0) and r["se_beta"] is None and r["adj_r2"] is None


def test_missing_values_pair_up(spark):
    r = {x["series"]: x for x in regression.ols(sample(spark), ["y", "z"], "x").collect()}
    assert r["y"]["n"] == 60 and r["z"]["n"] == 54 and r["z"]["x_max"] == pytest.approx(59 / 20)
