"""Quarterly and annual fiscal panels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.periods import QUARTER_PERIODS
from panelwright.functions.text import NATION
from panelwright.operators.aggregates import annual_rollup
from panelwright.operators.joins import join_on_date
from panelwright.operators.series import REAL_METRIC

# Column names of the published panels.
VALUE_ADDED = "vab_informal_real_millones"
WAGES = "remuneraciones_informal_reales_millones"
JOBS = "puestos_trabajo_informal_unidades"
INSURANCE = "ingreso_obrero_patronal_nacional"
PANEL_SUMS = (VALUE_ADDED, WAGES, JOBS, "ISR", "IVA", INSURANCE)
# Fixed values: (output column, indicator, metric) of the three panel measures.
PANEL_METRICS = (
    (VALUE_ADDED, "vab_comercio_informal", "Millones de pesos a precios de 2018"),
    (WAGES, "remuneraciones_comercio_informal", REAL_METRIC),
    (JOBS, "puestos_trabajo_comercio_informal", "Unidades"),
)


def national_measures(tidy: DataFrame, include_cumulative: bool = False) -> DataFrame:
    """(fecha, three measures): the nation's metrics as columns, quarters only unless asked."""
    wanted = F.lit(False)
    for _, indicador, metric in PANEL_METRICS:
        wanted = wanted | ((F.col("indicador") == indicador) & (F.col("metric") == metric))
    rows = tidy.filter((F.col("estado") == NATION) & wanted)
    if not include_cumulative:
        rows = rows.filter(F.col("periodo").isin(*QUARTER_PERIODS))
    return rows.groupBy("fecha").agg(*[
        F.sum(F.when((F.col("indicador") == i) & (F.col("metric") == m), F.col("valor"))).alias(name)
        for name, i, m in PANEL_METRICS
    ])


def fiscal_panel(tidy: DataFrame, taxes: DataFrame, insurance: DataFrame) -> DataFrame:
    """One row per quarter: measures, taxes (ISR, IVA) and insurance revenue on common dates."""
    return join_on_date(national_measures(tidy), taxes, insurance)


def _pct(numerator: Column, denominator: str) -> Column:
    return F.try_divide(F.lit(100.0) * numerator, F.col(denominator))


def quarterly_ratios(panel: DataFrame) -> DataFrame:
    """Taxes and insurance revenue as percentages of value added and wages."""
    return panel.withColumns({
        "ISR_sobre_VAB_informal_pct": _pct(F.col("ISR"), VALUE_ADDED),
        "IVA_sobre_VAB_informal_pct": _pct(F.col("IVA"), VALUE_ADDED),
        "IMSS_sobre_Remuneraciones_informal_pct": _pct(F.col(INSURANCE), WAGES),
    })


def annual_ratios(annual: DataFrame) -> DataFrame:
    """Tax burden and insurance ratio on the year's sums."""
    return annual.withColumns({
        "carga_fiscal_sobre_VAB_pct": _pct(F.col("ISR") + F.col("IVA"), VALUE_ADDED),
        "imss_sobre_remuneraciones_pct": _pct(F.col(INSURANCE), WAGES),
    })


def annual_summary(panel: DataFrame, stock_means: bool = False) -> DataFrame:
    """Year sums and ratios; ``stock_means`` adds the year's average number of jobs."""
    return annual_ratios(annual_rollup(panel, PANEL_SUMS, means=(JOBS,) if stock_means else ()))
