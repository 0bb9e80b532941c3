"""Grouped aggregates. Each is mergeable, so frequent keys shrink before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(col).alias(out or col))


def to_quarterly(
    df: DataFrame,
    date: str,
    cols: Sequence[str] | Mapping[str, str],
    by: Sequence[str] = (),
    fill: float | None = 0.0,
    complete_only: bool = False,
) -> DataFrame:
    """Sum a series by calendar quarter, labelled by the quarter's last day.

    ``cols`` may map input names to output names. Quarters with no rows inside the
    observed span appear with ``fill``; a quarter of nulls sums to ``fill`` too.
    ``n_months`` counts the months that have rows; ``complete_only`` keeps quarters
    with all three.
    """
    names = dict(cols) if isinstance(cols, Mapping) else {c: c for c in cols}
    day = F.col(date).cast("date")
    # Month grain first: the quarter totals and the month count then need no distinct.
    monthly = (
        df.filter(F.col(date).isNotNull())
        .groupBy(*by, F.trunc(day, "month").alias("_month"))
        .agg(*[F.sum(c).alias(o) for c, o in names.items()])
    )
    quarterly = monthly.groupBy(*by, F.trunc("_month", "quarter").alias("_q")).agg(
        F.count(F.lit(1)).cast("int").alias("n_months"), *[F.sum(o).alias(o) for o in names.values()]
    )
    # Quarter grain from here on: one row per calendar quarter and series.
    w = W.partitionBy(*by).orderBy("_q")
    until = F.coalesce(F.add_months(F.lead("_q").over(w), -3), F.col("_q"))
    steps = F.sequence("_q", until, F.expr("interval 3 months"))
    filled = quarterly.withColumn("_steps", steps).select(
        *by, "_q", "n_months", *names.values(), F.explode("_steps").alias("_step")
    )
    observed = F.col("_step") == F.col("_q")
    out = filled.select(
        *by,
        F.last_day(F.add_months("_step", 2)).alias("fecha"),
        *[F.coalesce(F.when(observed, F.col(o)), F.lit(fill)).alias(o) for o in names.values()],
        F.when(observed, F.col("n_months")).otherwise(0).alias("n_months"),
    )
    return out.filter("n_months = 3") if complete_only else out


def pair_counts(df: DataFrame, a: str, b: str, out: str = "n_observaciones") -> DataFrame:
    """Rows per pair of non-null values."""
    return df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, col: str, n: int | None = None, dropna: bool = True) -> DataFrame:
    """Rows per value, most frequent first (value breaks ties, null last); ``n`` keeps the top."""
    source = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = (
        source.groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.col(col).asc_nulls_last())
    )
    return counts if n is None else counts.limit(n)


def single_partner(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values of ``a`` that occur with exactly one ``b``.

    min = max says the same as one distinct value, and both sides merge map-side.
    """
    span = df.dropna(subset=[a, b]).groupBy(a).agg(F.min(b).alias("_lo"), F.max(b).alias("_hi"))
    return span.filter("_lo = _hi").select(a, F.col("_lo").alias("partner"), F.lit(1).alias("n_partners"))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows without a value, per column, in one pass."""
    one_row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return one_row.unpivot([], list(cols), "column", "n_null")


def annual_rollup(
    panel: DataFrame,
    sums: Sequence[str],
    date: str = "fecha",
    means: Sequence[str] = (),
    ratios: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Year sums of flows, optional year means of stocks, and ratios of those results."""
    grouped = panel.groupBy(F.year(date).alias("anio")).agg(
        *[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(f"{c}_mean") for c in means]
    )
    return grouped.withColumns(dict(ratios)) if ratios else grouped
