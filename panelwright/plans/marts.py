"""The tables behind each chart and report of the analysis.

``tidy`` has the columns of :data:`panelwright.operators.reshape.TIDY_COLUMNS`;
``panel`` is one row per quarter with ``fecha`` and numeric columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions.periods import QUARTER_PERIODS
from panelwright.functions.text import NATION, fix_mojibake, metric_like
from panelwright.operators import filters, profile, regression, series
from panelwright.operators.aggregates import pair_counts, single_partner, sum_by
from panelwright.operators.fiscal import national_measures
from panelwright.operators.joins import join_on_date, settled, with_total
from panelwright.operators.reshape import pivot_years

# Indicators and metric texts of the analysis.
VALUE_ADDED, WAGES, JOBS = (
    "vab_comercio_informal", "remuneraciones_comercio_informal", "puestos_trabajo_comercio_informal",
)
NOMINAL, REAL, UNITS = "Millones de pesos a precios corrientes", "Millones de pesos a precios de 2018", "Unidades"
LEVEL_PAIRS = ((VALUE_ADDED, NOMINAL), (VALUE_ADDED, REAL), (WAGES, NOMINAL), (JOBS, UNITS))
INDEX_TEXTS = ("Índice de volumen físico", "Índice de valor")
VARIATION_TEXT = "Variación porcentual anual"


def _pairs(tidy: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    wanted = reduce(
        lambda a, b: a | b, [(F.col("indicador") == i) & (F.col("metric") == m) for i, m in pairs]
    )
    return tidy.filter(wanted)


def _series(rows: DataFrame) -> DataFrame:
    return rows.select("indicador", "metric", "estado", "periodo", "fecha", "valor")


def k1(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """National series in levels."""
    rows = _pairs(tidy, LEVEL_PAIRS).filter(F.col("estado") == NATION)
    return _series(filters.cutoff(rows, last=last)).orderBy("indicador", "metric", "fecha", "periodo")


def k2(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """National volume (or value) index, base 100; broken accents in the metric are repaired."""
    repaired = tidy.filter(F.col("estado") == NATION).withColumn("metric", fix_mojibake("metric"))
    index = reduce(lambda a, b: a | b, [metric_like("metric", t) for t in INDEX_TEXTS])
    base = metric_like("metric", "base 2018=100") | metric_like("metric", "2018=100")
    rows = repaired.filter(index & base & ~metric_like("metric", "variación"))
    return _series(filters.cutoff(rows, last=last)).orderBy("indicador", "metric", "fecha", "periodo")


def k3(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """State series: real value added, real wages (the deflated metric too), jobs."""
    wanted = ((F.col("indicador") == VALUE_ADDED) & (F.col("metric") == REAL)) | (
        (F.col("indicador") == JOBS) & (F.col("metric") == UNITS)
    ) | ((F.col("indicador") == WAGES) & metric_like("metric", "a precios de 2018"))
    rows = tidy.filter(wanted & (F.col("estado") != NATION))
    return _series(filters.cutoff(rows, last=last)).orderBy("indicador", "metric", "estado", "fecha", "periodo")


def _value_added_at_reference(tidy: DataFrame, last: str | None) -> DataFrame:
    return filters.at_reference_period(filters.cutoff(filters.panel_slice(tidy, VALUE_ADDED, REAL), last=last))


def k4(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """States by real value added in the last reference year, with their share of the nation.

    Empty when the nation's total is missing or not positive.
    """
    # States and the nation per year are few rows; the last year is taken after the sum.
    yearly = settled(sum_by(_value_added_at_reference(tidy, last), ["estado", "anio"], "valor"))
    recent = filters.latest_year(yearly)
    nation = recent.filter(F.col("estado") == NATION).filter("valor > 0").select("anio", "valor")
    shared = with_total(recent.filter(F.col("estado") != NATION), nation, ["anio"], "valor", "participacion_pct")
    return shared.filter("participacion_pct is not null").orderBy(F.desc("valor"), "estado")


def k4_top(tidy: DataFrame, n: int = 10, last: str | None = None) -> DataFrame:
    """The first states of :func:`k4`, numbered."""
    return series.rank_by(k4(tidy, last), "valor", "estado", n)


def k5(tidy: DataFrame, n: int = 5, last: str | None = None) -> DataFrame:
    """The nation and the leading states by date, with each state's share of the nation."""
    dated = settled(sum_by(_value_added_at_reference(tidy, last), ["estado", "fecha"], "valor"))
    nation = dated.filter(F.col("estado") == NATION)
    states = dated.filter(F.col("estado") != NATION)
    recent = filters.latest_year(states.withColumn("anio", F.year("fecha")))
    leaders = filters.top_n(sum_by(recent, ["estado"], "valor"), n, [F.desc("valor"), "estado"]).select("estado")
    shown = states.join(leaders, "estado", "left_semi").unionByName(nation)
    shared = with_total(shown, nation, ["fecha"], "valor", "participacion_pct")
    return shared.orderBy("estado", "fecha")


def k6_long(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """(estado, anio, pct_of_max): state-year value added against the state's own peak."""
    states = filters.panel_slice(tidy, VALUE_ADDED, REAL, national=False)
    yearly = sum_by(filters.at_reference_period(filters.cutoff(states, last=last)), ["estado", "anio"], "valor")
    return series.pct_of_max(yearly, "valor", ["estado"]).select("estado", "anio", "pct_of_max")


def k6(tidy: DataFrame, years: Sequence[int] | None = None, last: str | None = None) -> DataFrame:
    """The heat table: one row per state, one column per year."""
    return pivot_years(k6_long(tidy, last), "estado", "anio", "pct_of_max", years)


def k7(tidy: DataFrame, last: str | None = None) -> DataFrame:
    """National annual variation in percent."""
    repaired = tidy.filter(F.col("estado") == NATION).withColumn("metric", fix_mojibake("metric"))
    rows = repaired.filter(metric_like("metric", VARIATION_TEXT))
    return _series(filters.cutoff(rows, last=last)).orderBy("indicador", "metric", "fecha", "periodo")


def fiscal_series(tidy: DataFrame, taxes: DataFrame, insurance: DataFrame, include_cumulative: bool = False) -> DataFrame:
    """(fecha, VAB_Informal, ISR, IVA, IMSS) on common dates.

    ``include_cumulative`` keeps running totals and dates them by the loose period rule,
    which puts each of them in December; those dates then repeat, as in the published
    report.
    """
    from panelwright.functions.periods import month_end, period_month_loose

    rows = filters.panel_slice(tidy, VALUE_ADDED, NOMINAL, national=True)
    if include_cumulative:
        dated = rows.select(month_end("anio", period_month_loose("periodo")).alias("fecha"), F.col("valor").alias("VAB_Informal"))
        return dated.join(taxes, "fecha").join(insurance, "fecha")
    quarters = rows.filter(F.col("periodo").isin(*QUARTER_PERIODS))
    return join_on_date(quarters.select("fecha", F.col("valor").alias("VAB_Informal")), taxes, insurance)


def k8_levels(panel: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Correlation matrix of the levels."""
    return profile.corr_matrix(panel, cols)


def k8_base100(panel: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Series with the first quarter at 100."""
    return series.base100(panel, cols).orderBy("fecha")


def k8_cycles(panel: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Growth on the same quarter of the year before, in percent."""
    growth = series.yoy(panel, cols)
    return growth.select("fecha", *[(F.col(f"{c}_yoy") * 100).alias(f"{c}_yoy_pct") for c in cols]).orderBy("fecha")


def k8_scatter(panel: DataFrame, x: str, y: Sequence[str]) -> DataFrame:
    """Linear trend of each measure on ``x`` in levels."""
    return regression.ols(panel, y, x, log=False).select("series", "n", "alpha", "beta", "r2")


def k9(panel: DataFrame, x: str, y: Sequence[str], order: str = "fecha") -> DataFrame:
    """Elasticities with full inference and residual diagnostics, one row per model."""
    panel = settled(panel)
    models = regression.ols(panel, y, x)
    tests = regression.ols_diagnostics(panel, models, y, x, order).drop("n")
    return regression.ols_inference(models).join(tests, "series")


def k10(panel: DataFrame, a: str, b: str, others: Sequence[str]) -> DataFrame:
    """Means, ratio of means, and correlation of the growth rates with ``a``, as (item, value)."""
    panel = settled(panel)
    means = profile.magnitude_ratio(panel, a, b).unpivot([], ["mean_a", "mean_b", "ratio"], "item", "value")
    growth = series.yoy(panel, [a, *others])
    cycles = profile.corr_matrix(growth, [f"{c}_yoy" for c in (a, *others)])
    pairs = cycles.filter((F.col("a") == f"{a}_yoy") & (F.col("b") != f"{a}_yoy"))
    return means.unionByName(pairs.select(F.concat(F.lit("corr_"), "b").alias("item"), F.col("corr").alias("value")))


def k11_pairs(df: DataFrame, a: str = "metric", b: str = "indicador") -> DataFrame:
    """Observations per pair, most frequent first."""
    return pair_counts(df, a, b).orderBy(F.desc("n_observaciones"), a, b)


def k11_single(df: DataFrame, a: str = "metric", b: str = "indicador") -> DataFrame:
    """Values of either column that occur with exactly one value of the other."""
    one = single_partner(df, a, b).select(F.lit(a).alias("column"), F.col(a).alias("value"), "partner")
    other = single_partner(df, b, a).select(F.lit(b).alias("column"), F.col(b).alias("value"), "partner")
    return one.unionByName(other)


