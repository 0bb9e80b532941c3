"""Spreadsheet grids to long tables, and back.

A grid is a cell table ``(source, row_idx, col_idx, value)``, zero-based, one row per
non-empty cell. All operators handle any number of sheets at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions.periods import (
    clean_year,
    is_cumulative,
    month_end,
    period_month,
    quarter_end,
    quarter_from_text,
    quarter_label,
    year_from_text,
)
from panelwright.functions.text import strip, to_double
from panelwright.operators.joins import attach_row_meta, join_lookup

# Layout of the stacked sheets (zero-based rows, one-based title rows).
YEAR_ROW, PERIOD_ROW, BLOCK_ROWS = 4, 5, 33
TITLE_ROWS = (7, 41, 75, 109, 143, 177, 211, 245, 279)
# Column orders of the tidy tables.
TIDY_COLUMNS = ("estado", "anio", "periodo", "fecha", "metric", "indicador", "fuente", "valor")
HEALTH_COLUMNS = (
    "estado", "acceso_salud", "sexo", "anio", "trimestre", "trimestre_texto", "periodo", "fecha_fin_trimestre", "valor",
)


def ffill_right(cells: DataFrame, out: str = "filled") -> DataFrame:
    """Carry a merged header value over the empty cells to its right, per source and row."""
    w = W.partitionBy("source", "row_idx").orderBy("col_idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    return cells.withColumn(out, F.last("value", ignorenulls=True).over(w))


def _block_of(row: Column, title_rows: Sequence[int], n: int) -> Column:
    """One-based title row whose block holds this zero-based row (the title itself included)."""
    starts = F.array(*[F.lit(t) for t in sorted(title_rows)])
    inside = F.filter(starts, lambda t: (row >= t - 1) & (row < t + n))
    return F.try_element_at(inside, F.lit(-1))


def grid_blocks(cells: DataFrame, title_rows: Sequence[int] = TITLE_ROWS, n: int = BLOCK_ROWS) -> DataFrame:
    """(source, title_row, metric, row_idx, estado) from the first column of each block.

    Each group is one block of at most ``n + 1`` rows. A block without a single label
    is skipped.
    """
    first = cells.filter(F.col("col_idx") == 0).withColumn("title_row", _block_of(F.col("row_idx"), title_rows, n))
    is_title = F.col("row_idx") == F.col("title_row") - 1
    label = F.nullif(strip("value"), F.lit(""))
    blocks = first.filter("title_row is not null").groupBy("source", "title_row").agg(
        F.max(F.when(is_title, strip("value"))).alias("metric"),
        F.collect_list(F.when(~is_title & label.isNotNull(), F.struct("row_idx", label.alias("estado")))).alias("labels"),
    )
    return drop_empty_blocks(blocks).select("source", "title_row", "metric", F.inline("labels"))


def drop_empty_blocks(blocks: DataFrame, labels: str = "labels") -> DataFrame:
    """Blocks that have at least one row label."""
    return blocks.filter(F.size(labels) > 0)


def grid_to_long(
    cells: DataFrame,
    title_rows: Sequence[int] = TITLE_ROWS,
    n: int = BLOCK_ROWS,
    year_row: int = YEAR_ROW,
    period_row: int = PERIOD_ROW,
) -> DataFrame:
    """Stacked cross-tabs to (source, title_row, metric, row_idx, col_idx, estado, anio_raw, periodo, value).

    Used columns are those with a period; years are filled rightward over them. Every
    label meets every used column, so an absent cell is a row with a null value.
    """
    used = F.when(F.col("row_idx") == period_row, F.nullif(strip("value"), F.lit("")))
    header = (
        cells.filter(F.col("row_idx").isin(year_row, period_row) & (F.col("col_idx") > 0))
        .groupBy("source", "col_idx")
        .agg(
            F.lit(year_row).alias("row_idx"),
            F.max(F.when(F.col("row_idx") == year_row, F.nullif(strip("value"), F.lit("")))).alias("value"),
            F.max(used).alias("periodo"),
        )
        .filter("periodo is not null")
    )
    filled = ffill_right(header, "anio_raw")
    # One array per sheet, as long as the sheet is wide.
    layout = filled.groupBy("source").agg(
        F.collect_list(F.struct("col_idx", "anio_raw", "periodo")).alias("_columns")
    )
    rows = join_lookup(grid_blocks(cells, title_rows, n), layout, ["source"], "inner")
    dense = rows.select("source", "title_row", "metric", "row_idx", "estado", F.inline("_columns"))
    body = cells.filter(F.col("col_idx") > 0).select("source", "row_idx", "col_idx", "value")
    return dense.join(body, ["source", "row_idx", "col_idx"], "left")


def tidy_select(df: DataFrame, columns: Sequence[str] = TIDY_COLUMNS) -> DataFrame:
    """Final projection in the published column order."""
    return df.select(*columns)


def tidy_panel(long: DataFrame, indicador: str | Column, keep_title_row: bool = False) -> DataFrame:
    """Types, dates and final columns of a stacked grid; rows without a year are dropped.

    An unknown period leaves the date null. ``es_acumulado`` tells running totals from
    quarters, which share state and year with them.
    """
    name = F.lit(indicador) if isinstance(indicador, str) else indicador
    typed = (
        long.withColumn("anio", clean_year("anio_raw"))
        .withColumn("valor", to_double("value"))
        .filter("estado is not null and anio is not null")
        .withColumn("fecha", month_end("anio", period_month("periodo")))
        .withColumn("es_acumulado", is_cumulative("periodo"))
        .withColumn("indicador", name)
        .withColumn("fuente", F.col("source"))
    )
    extra = ("es_acumulado", "title_row") if keep_title_row else ("es_acumulado",)
    return tidy_select(typed, (*TIDY_COLUMNS, *extra))


def zero_fill(df: DataFrame, col: str = "valor") -> DataFrame:
    """Null becomes 0, with ``<col>_missing`` telling which rows were null."""
    return df.withColumn(f"{col}_missing", F.col(col).isNull()).withColumn(
        col, F.coalesce(F.col(col), F.lit(0).cast(df.schema[col].dataType))
    )


def grid2_to_long(cells: DataFrame) -> DataFrame:
    """Two header rows (quarter text, sex) and two label columns to long; absent cells give no row."""
    in_row = F.when(F.col("row_idx") == 0, strip("value")), F.when(F.col("row_idx") == 1, strip("value"))
    header = cells.filter("row_idx < 2 and col_idx >= 2").groupBy("source", "col_idx").agg(
        F.max(in_row[0]).alias("trimestre_texto"), F.max(in_row[1]).alias("sexo")
    )
    meta = cells.filter("row_idx >= 2 and col_idx < 2").groupBy("source", "row_idx").agg(
        F.max(F.when(F.col("col_idx") == 0, strip("value"))).alias("acceso_salud"),
        F.max(F.when(F.col("col_idx") == 1, strip("value"))).alias("estado"),
    )
    body = cells.filter("row_idx >= 2 and col_idx >= 2 and value is not null")
    return attach_row_meta(join_lookup(body, header, ["source", "col_idx"], "inner"), meta)


def tidy_health(long: DataFrame) -> DataFrame:
    """Quarter, dates and published column order of the two-row grid."""
    dated = (
        long.withColumn("anio", year_from_text("trimestre_texto"))
        .withColumn("trimestre", quarter_from_text("trimestre_texto"))
        .withColumn("periodo", quarter_label("anio", "trimestre"))
        .withColumn("fecha_fin_trimestre", quarter_end("anio", "trimestre"))
        .withColumn("valor", to_double("value"))
    )
    return tidy_select(dated, HEALTH_COLUMNS)


def pivot_years(df: DataFrame, key: str, year: str, value: str, years: Sequence[int] | None = None) -> DataFrame:
    """One row per key, one column per year, from the first to the last of the data unless listed.

    Columns have to be known when the query is built, so without a list one aggregate of
    the year column runs then.
    """
    if years is None:
        first, last = df.agg(F.min(year), F.max(year)).first()
        years = range(first, last + 1) if first is not None else []
    return df.groupBy(key).pivot(year, list(years)).agg(F.sum(value))


def melt(df: DataFrame, keys: Sequence[str], values: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """Columns to (name, value) rows. Nulls are dropped unless asked for."""
    long = df.unpivot(list(keys), list(values), "name", "value")
    return long if keep_nulls else long.filter("value is not null")


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column missing from one is null there. Duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


union_rows = concat
