"""Slices, cutoffs and limits. All are lazy and reach the scan where they can."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions.text import NATION
from panelwright.operators.joins import null_safe_join

# Yearly period labels by preference; any other ranks after them.
YEARLY_PERIODS = ("T4", "12 Meses", "Año", "Anual", "Anio")


def panel_slice(
    df: DataFrame, indicador: str, metric: str, national: bool | None = None, nation: str = NATION
) -> DataFrame:
    """Rows of one indicator and metric; only the nation (True) or only the states (False)."""
    out = df.filter((F.col("indicador") == indicador) & (F.col("metric") == metric))
    if national is None:
        return out
    return out.filter(F.col("estado") == nation if national else F.col("estado") != nation)


def cutoff(df: DataFrame, date: str = "fecha", last: str | None = None) -> DataFrame:
    """Rows up to and including a day; all rows without one."""
    return df if last is None else df.filter(F.col(date) <= F.lit(last).cast(df.schema[date].dataType))


def require_keys(df: DataFrame, cols: Sequence[str], nonzero: Sequence[str] = ()) -> DataFrame:
    """Drop rows with a null key, or a zero in a divisor column."""
    out = df.dropna(subset=list(cols))
    for c in nonzero:
        out = out.filter(F.col(c) != 0)
    return out


def reference_period(df: DataFrame, col: str = "periodo") -> DataFrame:
    """The period used for yearly comparisons, as one row.

    T4, else 12 Meses, else a yearly label, else the most frequent (smallest on ties).
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    priority = F.lit(len(YEARLY_PERIODS))
    for rank, name in reversed(list(enumerate(YEARLY_PERIODS))):
        priority = F.when(F.col(col) == name, rank).otherwise(priority)
    frequency = F.when(priority < len(YEARLY_PERIODS), F.lit(0).cast("long")).otherwise(-F.col("n"))
    return counts.agg(F.min_by(col, F.struct(priority, frequency, F.col(col))).alias(col))


def at_reference_period(df: DataFrame, col: str = "periodo") -> DataFrame:
    """Rows of the reference period; it is looked up as a scalar subquery."""
    return df.filter(F.col(col) == reference_period(df, col).scalar())


def latest_year(df: DataFrame, year: str = "anio", by: Sequence[str] = ()) -> DataFrame:
    """Rows of the last year, overall or within each group; rows of null keys are a group."""
    if not by:
        return df.filter(F.col(year) == df.agg(F.max(year)).scalar())
    last = df.groupBy(*by).agg(F.max(year).alias("_last"))
    return null_safe_join(df, last, list(by)).filter(F.col(year) == F.col("_last")).drop("_last")


def top_n(df: DataFrame, n: int, order: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows under an order that ends in a unique key, overall or per group."""
    if not by:
        return df.orderBy(*order).limit(n)
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def sort_by(df: DataFrame, cols: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*cols)
