"""Operators on time series.

They take panels: one row per date (and series). None of them orders a whole series in
one task: earlier rows are joined on by date, first rows and peaks are aggregates, and
the row before is carried over slices of the dates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions.text import metric_like
from panelwright.operators.joins import join_lookup, keep_first, null_safe_join
from panelwright.operators.ordered import with_previous


def _month_index(date: str) -> Column:
    return F.year(date) * 12 + F.month(date)


def yoy(df: DataFrame, cols: Sequence[str], date: str = "fecha", by: Sequence[str] = (), months: int = 12) -> DataFrame:
    """Growth on the observation exactly ``months`` earlier; rows without one, or without a date, are dropped.

    The earlier observation is joined on by month, so gaps in the series cannot shift it
    and no task orders a series. Of several rows of a month the latest counts as earlier.
    """
    cols, by = list(cols), list(by)
    dated = df.filter(F.col(date).isNotNull()).withColumn("_m", _month_index(date))
    month = dated.groupBy(*by, "_m").agg(F.max_by(F.struct(*[F.col(c).alias(f"_{c}") for c in cols]), date).alias("_then"))
    both = null_safe_join(dated, month.withColumn("_m", F.col("_m") + months), [*by, "_m"])
    growth = [(F.try_divide(F.col(c), F.col("_then")[f"_{c}"]) - 1).alias(f"{c}_yoy") for c in cols]
    return both.select(*by, date, *growth)


def base100(df: DataFrame, cols: Sequence[str], date: str = "fecha", by: Sequence[str] = ()) -> DataFrame:
    """Index with the first observation of each series at 100."""
    # An aggregate of the first row, so that a long series is not gathered in one task.
    by = list(by)
    first = F.min_by(F.struct(*[F.col(c).alias(f"_{c}") for c in cols]), date)
    based = null_safe_join(df, df.groupBy(*by).agg(first.alias("_first")), by) if by else df.withColumn("_first", df.agg(first).scalar())
    return based.select(*by, date, *[F.try_divide(F.lit(100.0) * F.col(c), F.col("_first")[f"_{c}"]).alias(f"{c}_idx") for c in cols])


def pct_of_max(df: DataFrame, col: str, by: Sequence[str], out: str = "pct_of_max") -> DataFrame:
    """Percentage of the largest value of the own series."""
    # An aggregate and a join, so that a long series is not gathered in one task.
    peak = df.groupBy(*by).agg(F.max(col).alias("_peak"))
    return null_safe_join(df, peak, list(by), "left").withColumn(out, F.try_divide(F.lit(100.0) * F.col(col), F.col("_peak"))).drop("_peak")


def share_of_total(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "share_pct") -> DataFrame:
    """Percentage of the total, overall or per group; groups with a total <= 0 are left out, rows of a null group are one."""
    if by:
        total = df.groupBy(*by).agg(F.sum(col).alias("_total")).filter("_total > 0")
        return null_safe_join(df, total, list(by)).withColumn(out, F.lit(100.0) * F.col(col) / F.col("_total")).drop("_total")
    total = df.agg(F.sum(col)).scalar()
    return df.filter(total > 0).withColumn(out, F.lit(100.0) * F.col(col) / total)


def rank_by(
    df: DataFrame, col: str, key: str, n: int, by: Sequence[str] = (), out: str = "rank"
) -> DataFrame:
    """Numbered top ``n`` by descending value, key as tie-break, overall or per group."""
    order = [F.col(col).desc(), F.col(key).asc()]
    if not by:
        # The window only ever sees the n rows that the limit lets through.
        return df.orderBy(*order).limit(n).withColumn(out, F.row_number().over(W.orderBy(*order)))
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= n)


def deflate(
    nominal: DataFrame,
    index: DataFrame,
    keys: Sequence[str] = ("estado", "anio", "periodo"),
    value: str = "valor",
    order: Sequence[str] = ("title_row",),
    base: float = 100.0,
) -> DataFrame:
    """Constant prices: nominal x base / index, on rows where both exist and the index is not 0.

    ``order`` decides which index row counts when a key has several.
    """
    keys = list(keys)
    prices = keep_first(index.dropna(subset=keys), keys, [*order, value]).select(
        *keys, F.col(value).alias("_index")
    )
    joined = join_lookup(nominal, prices, keys, "inner")
    usable = joined.filter(F.col(value).isNotNull() & F.col("_index").isNotNull() & (F.col("_index") != 0))
    return usable.withColumn(value, F.col(value) * F.lit(base) / F.col("_index")).drop("_index")


# Texts that mark the nominal and price tables, and the new metric's name.
NOMINAL_TEXT = "millones de pesos a precios corrientes"
PRICE_TEXT = "índice de precios implícitos"
REAL_METRIC = "Remuneraciones a precios de 2018 (deflactadas con Índice de precios implícitos del VAB)"


def add_deflated(rows: DataFrame, price_rows: DataFrame, metric: str = REAL_METRIC) -> DataFrame:
    """Append the nominal rows at constant prices under a new metric name."""
    nominal = rows.filter(metric_like("metric", NOMINAL_TEXT))
    prices = price_rows.filter(metric_like("metric", PRICE_TEXT))
    order = ["title_row"] if "title_row" in prices.columns else ["metric"]
    real = deflate(nominal, prices, order=order).withColumn("metric", F.lit(metric))
    return rows.unionByName(real.select(*rows.columns))


def gap_days(df: DataFrame, date: str, by: Sequence[str] = (), out: str = "gap_days") -> DataFrame:
    """Days since the previous observation of the series."""
    before = with_previous(df, {"_previous": date}, date, by)
    return before.withColumn(out, F.date_diff(F.col(date), F.col("_previous"))).drop("_previous")
