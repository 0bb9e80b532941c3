"""Readers for panels, Parquet tables, grids and monthly sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelwright.functions.periods import parse_date
from panelwright.functions.text import to_double
from panelwright.operators.schema import clean_names, require

CELLS = "source string, row_idx int, col_idx int, value string"
# Series of the monthly sheets and their short names.
TAX_SERIES = {"Impuesto Sobre la Renta": "ISR", "Impuesto al Valor Agregado": "IVA"}
INSURANCE_SERIES = {"Ingreso obrero - patronal nacional": "ingreso_obrero_patronal_nacional"}


def read_panel_csv(spark: SparkSession, path: str, schema: str | StructType, encoding: str = "UTF-8") -> DataFrame:
    """CSV with header under a stated schema; a byte-order mark in the header does no harm."""
    return spark.read.schema(schema).option("header", "true").option("encoding", encoding).csv(path)


def scan(spark: SparkSession, path: str, cols: Sequence[str] | None = None, n: int | None = None) -> DataFrame:
    """Parquet scan of some columns, optionally of the first rows only."""
    df = spark.read.parquet(path)
    df = df.select(*cols) if cols else df
    return df.limit(n) if n is not None else df


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cell table of headerless sheets, from Parquet or CSV."""
    if path.lower().rstrip("/").endswith(".csv"):
        return spark.read.schema(CELLS).option("header", "true").csv(path)
    return spark.read.schema(CELLS).parquet(path)


def read_monthly(table: DataFrame, series: dict[str, str], date: str = "Fecha", dayfirst: bool = False) -> DataFrame:
    """A headed monthly sheet as (fecha, renamed series).

    Names are trimmed, and the first column is taken as the date if none has its name.
    """
    named = require(clean_names(table, first=date), [date, *series])
    day = parse_date(date, dayfirst) if dict(named.dtypes)[date] == "string" else F.col(date).cast("date")
    return named.select(day.alias("fecha"), *[to_double(f"`{c}`").alias(o) for c, o in series.items()])
