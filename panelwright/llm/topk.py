"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import importable

#: Rows and queries that meet in one task at most, about (dealt by a hash of the id).
ROWS, QUERIES = 8192, 1024
#: List entries read first; the depth doubles with each round.
DEPTH = 64


def usable(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """Rows whose vector has components, none of them null or not finite, as whole numbers floor(scale * x).

    A component so large that a score or bound of such vectors could pass 64 bits fails the
    job with a message that says so.
    """
    x = F.col(vector_col)
    most = F.sqrt(F.lit(float(1 << 62)) / F.size(x))
    large = F.raise_error(F.lit(f"components of {vector_col} are too large for exact scores at scale {scale}"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform(x, lambda v: F.when(F.abs(v.cast("double") * scale) < most - 1, F.floor(v.cast("double") * scale).cast("long")).otherwise(large))
    return vectors.filter(x.isNotNull() & (F.size(x) > 0)).filter(fine).withColumn("_v", whole)


def threshold_search(ids, rows, order, query_id, query, k: int):
    """The best ``k`` of ``rows`` by (score descending, id ascending), the query's own id apart.

    ``order`` lists the rows of each dimension by ascending value. For each dimension the
    list is read from the end that the query's sign favours; rows met for the first time are
    scored in full. No row yet unseen can score above the sum of the values at the current
    depth, so the search stops once the k-th score is above that sum; at an equal score an
    unseen row could still win the tie.
    """
    import numpy as np

    n, dims = rows.shape[0], np.flatnonzero(query)
    seen, best_id, best = np.zeros(n, bool), np.zeros(0, np.int64), np.zeros(0, query.dtype)
    if not len(dims):
        at = np.argsort(ids, kind="stable")
        at = at[ids[at] != query_id][:k]
        return ids[at], np.zeros(len(at), query.dtype)
    up = query[dims] > 0
    done, depth = 0, min(DEPTH, n)
    while done < n:
        span = np.arange(done, depth)
        at = np.concatenate([order[n - 1 - span][:, dims[up]].ravel(), order[span][:, dims[~up]].ravel()])
        hit = np.zeros(n, bool)
        hit[at] = True
        fresh = np.flatnonzero(hit & ~seen)
        seen[fresh] = True
        fresh = fresh[ids[fresh] != query_id]
        best, best_id = np.concatenate([best, rows[fresh] @ query]), np.concatenate([best_id, ids[fresh]])
        top = np.lexsort((best_id, -best))[:k]
        best, best_id = best[top], best_id[top]
        edge = np.where(up, rows[order[n - depth, dims], dims], rows[order[depth - 1, dims], dims])
        if len(best) == k and best[-1] > edge @ query[dims]:
            break
        done, depth = depth, min(2 * depth, n)
    return best_id, best


def _search(k: int):
    def run(key, left, right):
        import numpy as np
        import pyarrow as pa

        def matrix(table):
            raw = table.column("_v").to_pylist()
            out = np.zeros((len(raw), max(map(len, raw), default=0)), np.int64)
            for i, v in enumerate(raw):
                out[i, : len(v)] = v
            return np.array(table.column("_id").to_pylist(), np.int64), out

        (ids, rows), (query_ids, queries) = matrix(left), matrix(right)
        found = []
        if len(ids) and len(query_ids):
            width = max(rows.shape[1], queries.shape[1])
            rows, queries = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (rows, queries))
            # Products of doubles are exact, and fast, as long as every sum stays below 2 ** 53.
            if float(np.abs(rows).max()) * float(np.abs(queries).max()) * width < 2.0**53:
                rows, queries = rows.astype(float), queries.astype(float)
            order = np.argsort(rows, axis=0, kind="stable")
            for q, v in zip(query_ids, queries):
                found += [(q, i, s) for i, s in zip(*threshold_search(ids, rows, order, q, v, k))]
        columns = list(zip(*found)) or [[], [], []]
        return pa.table([pa.array(np.array(c, np.int64)) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 1024, rows: int = ROWS, block: int = QUERIES,
) -> DataFrame:
    """(query_id, rank int, vec_id, score long): each query's ``k`` highest inner products, all if there are fewer.

    Components count as floor(scale * x). Ties go to the smaller id, repeated rows take a
    rank each, and a query whose id is repeated is searched once, with its least vector.
    Rows with the query's id are no candidates for it. A shorter vector counts as ending in
    zeros. Vectors that are null or empty or hold a null or non-finite component, and rows
    with a null id, take no part on either side; other columns are left out.

    Rows and queries are dealt into blocks of bounded size by a hash of the id; each pair
    of blocks is one search, which yields ``k`` rows a query, and the best of those are
    kept. The work is that of all rows for all queries, by blocks; no block is sent to all.
    """
    importable(vectors.sparkSession)
    base = usable(vectors, vector_col, scale).filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), "_v")
    asked = usable(queries, vector_col, scale).filter(F.col(id_col).isNotNull())
    asked = asked.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min("_v").alias("_v"))
    n_rows = vectors.select(F.count(F.lit(1))).first()[0]
    n_queries = queries.select(F.count(F.lit(1))).first()[0]
    row_blocks, query_blocks = max(1, -(-n_rows // rows)), max(1, -(-n_queries // block))
    deal = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = base.withColumn("_r", deal(row_blocks)).withColumn("_q", every(query_blocks))
    right = asked.withColumn("_q", deal(query_blocks)).withColumn("_r", every(row_blocks))
    found = left.groupBy("_r", "_q").cogroup(right.groupBy("_r", "_q")).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    from panelwright.llm.common import table

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


#: The same by brute force.
SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
