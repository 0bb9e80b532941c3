"""What the operators share: reading tables, cutting lineage, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is named, as in tests, a folder of this session."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def settled(df: DataFrame) -> DataFrame:
    """The same rows behind a reliable checkpoint: computed once, safe from lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The same rows as a Parquet table in the shared folder: for wide rows, of which later steps read few columns."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package wherever the driver was started.

    A cluster gets it as usual, with --py-files or an installed wheel.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in (paths := env.get("PYTHONPATH", "").split(os.pathsep)):
        env["PYTHONPATH"] = os.pathsep.join(p for p in [*paths, root] if p)


def arrow_map(df: DataFrame, columns: Sequence, schema: str, make: Callable[[], Callable[..., list]], rows: int = 256) -> DataFrame:
    """Send some columns to Python in Arrow batches and keep what comes back.

    ``make()`` runs once a task and gives ``step(*columns)``: Arrow columns of at most
    ``rows`` rows in, one list, array or Arrow column for each field of ``schema`` out. If
    ``step`` has an attribute ``end``, that is called for the last rows of the task.
    """
    importable(df.sparkSession)
    chosen = df.select(*columns)
    fields = chosen.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        step, out = make(), to_arrow_schema(fields)

        def packed(got: Sequence) -> pa.RecordBatch:
            columns = [v if isinstance(v, pa.Array) else pa.array(v, t.type) for v, t in zip(got, out)]
            return pa.RecordBatch.from_arrays(columns, schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield packed(step(*batch.slice(at, rows).columns))
        if hasattr(step, "end"):
            yield packed(step.end())

    return chosen.mapInArrow(run, fields)


def arrow_column(df: DataFrame, column, kind: str, make: Callable[[], Callable], rows: int = 256):
    """A column made in Python from one Arrow column; the other columns of ``df`` stay on the JVM side.

    ``make()`` runs once a task and gives ``step(values)``, a list or array for at most
    ``rows`` values.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    importable(df.sparkSession)
    out = to_arrow_type(df.sparkSession.createDataFrame([], f"v {kind}").schema[0].dataType)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        step = make()
        for batch in batches:
            parts = [pa.array(step(batch.slice(at, rows)), out) for at in range(0, len(batch), rows)]
            yield pa.concat_arrays(parts) if parts else pa.array([], out)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(column)


def whole_text(column: str = "text"):
    """A text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary").alias("_text")
