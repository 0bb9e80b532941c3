"""Code dictionaries stored as JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.text import strip

# Names of dictionary files, of trial files, and the shape of a row.
FILE_PATTERN = "*_diccionario_*.json"
TRIAL_NAME = r"(?i)_diccionario_test[^/]*$"
ROW = (
    "struct<tabla:string,variable:string,"
    "categorias:array<struct<valor:string,categoria:string,casos:string,porcentaje:string>>>"
)


def parse_dictionaries(texts: DataFrame) -> DataFrame:
    """(path, value) texts to dictionary rows; the root is a list, or an object of lists.

    ``error`` marks a text that is neither; its row has no variable.
    """
    def read(c: Column) -> Column:
        return F.from_json(c, f"array<{ROW}>")

    # Members of an object that are not lists are passed over.
    members = F.map_values(F.from_json("value", "map<string,string>"))
    lists = F.filter(members, lambda v: strip(v).startswith("["))
    rows = F.when(strip("value").startswith("["), read(F.col("value"))).otherwise(F.flatten(F.transform(lists, read)))
    parsed = texts.select("path", rows.alias("rows"))
    bad = F.col("rows").isNull()
    return parsed.select(
        "path", F.when(bad, "unreadable dictionary").alias("error"), F.posexplode_outer("rows").alias("row_ord", "row")
    ).select(
        "path", F.col("path").alias("file_ord"), "row_ord",
        F.coalesce(strip("row.tabla"), F.lit("")).alias("tabla"),
        F.coalesce(strip("row.variable"), F.lit("")).alias("variable"),
        F.coalesce("row.categorias", F.array().cast("array<struct<valor:string,categoria:string,casos:string,porcentaje:string>>")).alias("categorias"),
        "error",
    )


def read_dictionary(spark: SparkSession, root: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """All dictionary files below a folder, trial files left out; bad files carry an error."""
    texts = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("wholetext", "true")
        .text(root)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    return parse_dictionaries(texts.filter(~F.col("path").rlike(TRIAL_NAME)))
