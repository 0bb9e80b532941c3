"""Writers. None of them collapses a table into one file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_master(
    df: DataFrame, path: str, partitions: Sequence[str] = ("anio", "trimestre"), compression: str = "zstd"
) -> None:
    """Parquet by year and quarter, replacing only the quarters present in ``df``.

    Rows are brought together by quarter. The rebalance hint lets Spark split a quarter
    that holds most rows over many tasks and merge small ones, by measured size.
    """
    cols = [c for c in partitions if c in df.columns]
    together = df.hint("rebalance", *[F.col(c) for c in cols]) if cols else df
    writer = together.write.mode("overwrite").option("compression", compression)
    if cols:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header in UTF-8, without a byte-order mark; nested columns as JSON text."""
    flat = df.select(*[
        F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(f"`{c}`") for c, t in df.dtypes
    ])
    flat.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, nested columns kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
