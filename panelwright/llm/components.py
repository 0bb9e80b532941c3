"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import settled


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u long, v long) -> (node, root), root being the least node reachable.

    Every round points each node at the least of its neighbours, first the larger
    neighbours and then the smaller ones; the number of rounds grows with the logarithm of
    the longest path. Minima are combined before they are shuffled, and the joins have one
    row per node on one side, so a node with a third of all links is split by Spark. Rounds
    end up in the checkpoint folder. Links of a node with itself and rows with a null give
    no output row; an empty table gives an empty table.
    """
    edges = settled(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u is not null and v is not null and u <> v").filter(F.col("u").isNotNull()).distinct()
    )
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = settled(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct()
        )
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
