"""Reading heterogeneous CSV drops as all-string tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelwright.functions.text import decode_cp1252, fix_mojibake
from panelwright.operators.schema import add_period_meta, union_by_name

# How each sniffed encoding is read. Single-byte and UTF-8 files are read as latin-1,
# which accepts every byte, and decoded value by value.
READ_AS = {
    "utf-8": "ISO-8859-1", "utf-8-sig": "ISO-8859-1", "cp1252": "ISO-8859-1",
    "utf-16": "UTF-16LE", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE",
    "utf-32le": "UTF-32", "utf-32be": "UTF-32",
}


def decode_value(c: Column, encoding: str) -> Column:
    """A value that was read as latin-1: UTF-8 where it is valid UTF-8, windows-1252 elsewhere."""
    if encoding == "cp1252":
        return decode_cp1252(c)
    if READ_AS[encoding] != "ISO-8859-1":
        return F.regexp_replace(c, "\r$", "")
    fixed = fix_mojibake(c)
    return F.when(fixed == c, decode_cp1252(c)).otherwise(fixed)


def distinct_names(header: list[str]) -> list[str]:
    """Column names of a header; one that is repeated, in any case, gets its number from the second time on."""
    out, seen = [], set()
    for name in header:
        unique, n = name, 2
        while unique.lower() in seen:
            unique, n = f"{name}_{n}", n + 1
        seen.add(unique.lower())
        out.append(unique)
    return out


# Column of lines that have more or fewer fields than their header; null for all others.
IRREGULAR = "irregular"


def read_group(
    spark: SparkSession, paths: list[str], header: list[str], encoding: str, delimiter: str, multi_line: bool = True
) -> DataFrame:
    """Files that share encoding, delimiter and header, all columns string, plus the file name.

    A line with more or fewer fields than the header is also kept whole, in ``irregular``.
    """
    # Four-byte text has no line end that splits safely: such a file is read by one task.
    whole = multi_line or READ_AS[encoding] == "UTF-32"
    positions = StructType([StructField(name, StringType()) for name in (*(f"_c{i}" for i in range(len(header))), "_line")])
    reader = (
        spark.read.schema(positions)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("sep", delimiter)
        .option("encoding", READ_AS[encoding])
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        .option("multiLine", str(whole).lower())
    )
    if READ_AS[encoding].startswith("UTF-") and not whole:
        # Two-byte text can be split by line only when told what a line end is.
        reader = reader.option("lineSep", "\n")
    raw = reader.csv(paths)
    named = [decode_value(F.col(f"_c{i}"), encoding).alias(name) for i, name in enumerate(distinct_names(header))]
    named.append(decode_value(F.col("_line"), encoding).alias(IRREGULAR))
    file_name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return raw.select(F.url_decode(file_name).alias("_file"), *named)


def read_micro_csv(spark: SparkSession, manifest: DataFrame, multi_line: bool = True, per: str = "per") -> DataFrame:
    """All files of a manifest as one table: metadata columns, then every column found.

    ``multi_line`` reads quoted line ends, and each file in one task; without it large files
    are split, which is right only where no value holds a line end. A file that begins with a
    line of blanks is always read by line. One scan per distinct (encoding, delimiter, header), not per file. The driver holds
    file names only, as any Spark scan does.
    """
    usable = manifest.filter("error is null and size(header) > 0")
    # Lines of blanks before the header are passed over by line, not by record.
    kind = F.struct("encoding", "delimiter", "header", "blank_start")
    # One pass over the manifest, which opens files: a row for each kind of file, with its paths.
    usable = usable.groupBy(F.md5(F.to_json(kind)).alias("id")).agg(F.any_value(kind).alias("kind"), F.sort_array(F.collect_list("path")).alias("paths"))
    kinds, paths = {}, {}
    for r in usable.toLocalIterator():
        kinds[r["id"]], paths[r["id"]] = r["kind"], r["paths"]
    groups = sorted(((kinds[i], found) for i, found in paths.items()), key=lambda g: g[1][0])
    if not groups:
        raise ValueError("no readable file in the manifest")
    tables = []
    for kind, found in groups:
        part = read_group(spark, found, kind["header"], kind["encoding"], kind["delimiter"], multi_line and not kind["blank_start"])
        tables.append(add_period_meta(part, "_file", per).drop("_file"))
    return union_by_name(tables)
