"""Finding files and describing them without reading them whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.codes import module_of, yq_from_name
from panelwright.functions.text import norm_header
from panelwright.sources.sniff import decode_head, first_line, header_fields, sniff_delimiter, sniff_encoding

# Bytes of a block; blocks are read until the header line has ended.
HEAD_BYTES = 128 * 1024
# Other names of a scheme that the file layer of the heads knows.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def discover(spark: SparkSession, root: str, suffix: str = ".csv") -> DataFrame:
    """(path, name, length) of the files below a folder, suffix in any case, each once."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{letters}")
        .load(root)
    )
    # Only the listing is read: the content column is pruned.
    return listed.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length").dropDuplicates(["path"])


def top_folder(root: str, path: str = "path"):
    """First folder below the root, or 'root' for a file that lies in it."""
    below = F.regexp_replace(F.replace(F.col(path), F.lit(root.rstrip("/")), F.lit("")), r"^\w+:/*", "/")
    parts = F.filter(F.split(below, "/"), lambda p: p != "")
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise("root")


def with_heads(files: DataFrame, n_bytes: int = HEAD_BYTES) -> DataFrame:
    """Add the first bytes of each file; a file that cannot be opened gets an error instead.

    Each task opens its own files and reads blocks until the first line that is not blank
    has ended, whatever its length. Paths are taken as Spark lists them, blanks and
    accents included.
    """
    schemes = dict(SCHEMES)

    def read(batches):
        from urllib.parse import quote

        import pandas as pd
        from pyarrow import fs

        def ended(head):
            line = head.lstrip(b" \t\r\n\x0b\x0c\0\xff\xfe\xef\xbb\xbf")
            return b"\n" in line or b"\r" in line

        def opened(path):
            scheme, found, rest = path.partition(":")
            if not found:
                scheme, rest = "file", "//" + path
            rest = rest if rest.startswith("//") else "//" + rest
            return fs.FileSystem.from_uri(f"{schemes.get(scheme, scheme)}:{quote(rest, safe='/:@')}")

        for batch in batches:
            heads, errors = [], []
            for path in batch["path"]:
                try:
                    source, inner = opened(path)
                    with source.open_input_stream(inner) as stream:
                        head = stream.read(n_bytes)
                        while not ended(head) and (more := stream.read(max(n_bytes, len(head)))):
                            head += more
                        heads.append(head)
                    errors.append(None)
                except Exception as problem:  # one bad file must not stop the others
                    heads.append(None)
                    errors.append(f"{type(problem).__name__}: {problem}")
            yield pd.DataFrame({**{c: batch[c] for c in batch.columns}, "head": heads, "error": errors})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    # A stated number of partitions: paths are small, but opening files is slow.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = files.repartition(tasks, "path")
    return spread.mapInPandas(read, f"{schema}, head binary, error string")


def csv_manifest(heads: DataFrame) -> DataFrame:
    """Encoding, delimiter, header, module and period of every file, one row each."""
    whole = F.octet_length("head") >= F.col("length") if "length" in heads.columns else False
    described = (
        heads.withColumn("encoding", F.when(F.col("error").isNull(), sniff_encoding("head", whole)))
        .withColumn("_text", decode_head("head", "encoding"))
        .withColumn("blank_start", F.coalesce(F.col("_text").rlike(r"^[\r\n]*[^\S\r\n]+[\r\n]"), F.lit(False)))
        .withColumn("_line", first_line("_text"))
        .withColumn("delimiter", sniff_delimiter("_line"))
        .withColumn("header", header_fields("_line", "delimiter"))
        .withColumn("header_norm", F.transform("header", norm_header))
        .withColumn("module", module_of("name"))
    )
    anio, trimestre = yq_from_name("name")
    return described.withColumn("anio", anio).withColumn("trimestre", trimestre).drop("head", "_line", "_text")


def manifest(spark: SparkSession, root: str, suffix: str = ".csv", n_bytes: int = HEAD_BYTES) -> DataFrame:
    return csv_manifest(with_heads(discover(spark, root, suffix), n_bytes))
