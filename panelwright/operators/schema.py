"""Schemas of many files: unions, coverage, groups of equal headers, unique names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.codes import safe_name, yq_from_name, yq_from_per
from panelwright.functions.text import BOM
from panelwright.operators.joins import join_lookup
from panelwright.operators.ordered import number_in_group
from panelwright.operators.reshape import concat

# The metadata columns that open every microdata table.
META_COLUMNS = ("anio", "trimestre", "anio_trimestre")


def resolve(df: DataFrame, name: str) -> str | None:
    """Actual column name for a name in any case; the first one wins."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same table, or an error naming every missing column, before any job runs."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def clean_names(df: DataFrame, first: str | None = None) -> DataFrame:
    """Trim column names and repair a mangled byte-order mark.

    ``first``: name the first column must carry if no column has it.
    """
    mangled = BOM.encode("utf-8").decode("latin-1")
    names = [c.replace(BOM, "").replace(mangled, "").strip() for c in df.columns]
    if first is not None and first not in names:
        names[0] = first
    return df.toDF(*names)


def canonical_cast(df: DataFrame, ints: Sequence[str] = ("anio", "trimestre")) -> DataFrame:
    """Named columns as int (bad text becomes null), every other column as string."""
    return df.select(*[
        F.col(f"`{c}`").cast("string").try_cast("double").cast("int").alias(c) if c in ints
        else F.col(f"`{c}`").cast("string").alias(c)
        for c in df.columns
    ])


def add_period_meta(df: DataFrame, file_name: str | Column, per: str | None = "per") -> DataFrame:
    """Put anio, trimestre and ``2024T1`` in front.

    The file name decides when it holds both parts; otherwise the period code does.
    """
    year, quarter = yq_from_name(file_name)
    column = resolve(df, per) if per else None
    per_year, per_quarter = yq_from_per(column) if column else (F.lit(None).cast("int"),) * 2
    named = year.isNotNull() & quarter.isNotNull()
    anio = F.when(named, year).otherwise(per_year)
    trimestre = F.when(named, quarter).otherwise(per_quarter)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in META_COLUMNS]
    return df.select(
        anio.alias("anio"),
        trimestre.alias("trimestre"),
        F.concat(anio.cast("string"), F.lit("T"), trimestre.cast("string")).alias("anio_trimestre"),
        *rest,
    )


def union_by_name(frames: Sequence[DataFrame], meta: Sequence[str] = META_COLUMNS) -> DataFrame:
    """Stack tables by column name: metadata first, then alphabetical ignoring case.

    Columns that differ only in case stay apart when ``spark.sql.caseSensitive`` is on
    and merge when it is off.
    """
    stacked = concat(frames)
    head = [c for c in meta if c in stacked.columns]
    tail = sorted((c for c in stacked.columns if c not in head), key=lambda c: (c.lower(), c))
    return stacked.select(*[f"`{c}`" for c in (*head, *tail)])


def coverage(manifest: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Files that carry each column, of how many.

    ``manifest``: path, header (array). ``columns`` adds names, such as the metadata
    columns, that no file may carry.
    """
    carried = (
        manifest.select("path", F.explode(F.array_distinct("header")).alias("columna"))
        .groupBy("columna")
        .agg(F.count(F.lit(1)).alias("archivos_con_col"))
    )
    total = manifest.agg(F.count(F.lit(1))).scalar()
    if columns is not None:
        wanted = manifest.sparkSession.createDataFrame([(c,) for c in columns], "columna string")
        carried = wanted.join(carried, "columna", "left")
    return carried.select(
        "columna", F.coalesce("archivos_con_col", F.lit(0)).alias("archivos_con_col"), total.alias("total_archivos")
    )


def header_groups(manifest: DataFrame) -> DataFrame:
    """One row per distinct normalised header: how many files, and a sample of the first.

    ``manifest``: path, header, header_norm, delimiter, and error (null for readable files).
    """
    return (
        manifest.filter("error is null")
        .groupBy("header_norm")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.min_by(F.array_join("header", " | "), "path").alias("sample_header"),
            F.min_by("delimiter", "path").alias("delimiter"),
        )
        .withColumn("kind", F.when(F.col("n_files") > 1, "group").otherwise("single"))
        .orderBy(F.desc("n_files"), "sample_header")
    )


def header_group_files(manifest: DataFrame) -> DataFrame:
    """The files of every header group, one row each; unreadable files keep their error."""
    groups = header_groups(manifest).select("header_norm", "n_files", "kind")
    good = manifest.filter("error is null").select("path", "header_norm")
    # One header may belong to a third of the files.
    good = join_lookup(good, groups, ["header_norm"], "inner")
    bad = manifest.filter("error is not null").select("path", "error")
    return concat([good.withColumn("error", F.lit(None).cast("string")), bad])


def unique_names(manifest: DataFrame, path: str, stem: str, tag: str, suffix: str | Column = ".csv") -> DataFrame:
    """Collision-free names: ``stem__tag.csv``, then ``stem__tag__2.csv``, ``__3`` and so on, in the order of paths."""
    end = F.lit(suffix) if isinstance(suffix, str) else suffix
    # A missing stem or tag counts as empty: the row keeps a name.
    blank = F.lit("")
    named = manifest.withColumns({"_stem": F.coalesce(safe_name(stem), blank), "_tag": F.coalesce(safe_name(tag), blank), "_suffix": end})
    numbered = number_in_group(named, ["_stem", "_tag", "_suffix"], path, "_n")
    counter = F.when(F.col("_n") > 1, F.concat(F.lit("__"), F.col("_n").cast("string"))).otherwise("")
    return numbered.withColumn(
        "name", F.concat("_stem", F.lit("__"), "_tag", counter, "_suffix")
    ).drop("_stem", "_tag", "_suffix", "_n")
