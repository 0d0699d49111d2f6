"""Exact top-k by inner product: Fagin's threshold algorithm in blocks.

Candidates are cut into blocks of bounded size.  A task holds one block with
its rows sorted by every dimension and walks those lists for each query of a
query block: it scores rows as they appear and stops when the bound of all
rows not yet seen cannot reach the kth result.  The blocks' results are merged
by one ranked window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tickforge.llm.common import prepare, saved

#: Candidate rows and queries in a block, about.
BLOCK_ROWS = 8192
QUERY_ROWS = 128
#: List positions read in the first round; every round doubles the depth.
FIRST_DEPTH = 16
SAFE = 2 ** 62


class Block:
    """Rows of one block and their order by each dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.largest = max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0
        self.order = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)  # dimension x rank

    def top(self, query_id: int, query: np.ndarray, k: int):
        """The k best (id, score) and the number of rows scored."""
        n, dims = self.rows.shape
        high = int(np.abs(query).max()) if dims else 0
        exact = high * self.largest * max(1, dims) < SAFE
        rows, q = (self.rows, query) if exact else (self.rows.astype(object), query.astype(object))
        used = np.flatnonzero(query)
        # best first: descending for a positive weight, ascending for a negative one
        lists = np.where((query[used] > 0)[:, None], self.order[used, ::-1], self.order[used])
        seen = np.zeros(n, bool)
        own = self.ids == query_id
        best_ids, best = np.empty(0, np.int64), np.empty(0, rows.dtype)
        depth, step, scored = 0, FIRST_DEPTH, 0
        while True:
            until = min(n, depth + step)
            fresh = np.zeros(n, bool)
            if len(used):
                fresh[lists[:, depth:until].ravel()] = True
            else:
                fresh[:] = True
            fresh &= ~seen
            seen |= fresh
            at = np.flatnonzero(fresh & ~own)
            scored += len(at)
            best_ids = np.concatenate([best_ids, self.ids[at]])
            new = rows[at] @ q
            best = np.concatenate([best, new if exact else np.clip(new, -2 ** 63, 2 ** 63 - 1)])
            keep = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[keep], best[keep]
            if until >= n:
                break
            # rows not seen have at most these values in every list
            bound = (rows[lists[:, until], used] * q[used]).sum()
            if len(best) == k and best[-1] > bound:
                break
            depth, step = until, step * 2
        return best_ids, best, scored


def search_block(block: Block, query_ids, queries: np.ndarray, k: int):
    for query_id, query in zip(query_ids.tolist(), queries):
        ids, scores, _ = block.top(query_id, query, k)
        for vec_id, score in zip(ids.tolist(), scores.tolist()):
            yield query_id, vec_id, int(score)


def exact_top_k(vectors: DataFrame, is_query, k: int = 10, scale: int = 1024,
                id_column: str = "vec_id", vector_column: str = "embedding",
                block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for every row with ``is_query`` (a
    condition on the id) the ``k`` rows of largest inner product of the
    components floor(scale * x), ties to the smaller id.

    Null vectors, ones with a null or non-finite component, and rows without
    an id take no part.  Vectors meet only vectors of their own length.  A
    query's own rows are those with its id; of repeated rows all are
    candidates, a repeated query id gets the best over its distinct vectors.
    Scores beyond 64 bits count as the nearest long.  An empty table gives an empty result.

    Each candidate row is sent to ceil(queries / query_rows) tasks, each query
    to ceil(rows / block_rows); no task holds more than a block of either."""
    prepare(vectors.sparkSession)
    scaled = F.transform(F.col(vector_column), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = (F.col(id_column).isNotNull() & F.col(vector_column).isNotNull()
             & F.forall(F.col(vector_column), lambda x: x.isNotNull() & ~F.isnan(x)
                        & (F.abs(x.cast("double")) < F.lit(float("inf")))))
    rows = saved(vectors.where(sound).select(
        F.col(id_column).cast("long").alias("vec_id"), scaled.alias("v"),
        is_query(F.col(id_column)).alias("asks"), F.size(vector_column).alias("dims"),
        F.rand(17).alias("salt")), "topk-rows")
    sizes = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    asked = saved(rows.where("asks").select("vec_id", "v", "dims").distinct(), "topk-queries")
    asked_sizes = asked.groupBy("dims").agg(F.count(F.lit(1)).alias("q"))
    # one row for each vector length
    blocks = saved(sizes.join(asked_sizes, "dims").select(
        "dims", F.ceil(F.col("n") / block_rows).alias("c_blocks"),
        F.ceil(F.col("q") / query_rows).alias("q_blocks")), "topk-blocks")
    grid = F.sequence(F.lit(0).cast("long"), F.col("q_blocks") - 1)
    candidates = (rows.join(blocks, "dims")
                  .withColumn("cb", F.floor(F.col("salt") * F.col("c_blocks")))
                  .withColumn("qb", F.explode(grid)).select("dims", "cb", "qb", "vec_id", "v"))
    queries = (asked.join(blocks, "dims")
               .withColumn("qb", F.pmod(F.xxhash64("vec_id", "v"), F.col("q_blocks")))
               .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c_blocks") - 1)))
               .select("dims", "cb", "qb", "vec_id", "v"))

    def run(asks, rows):
        import numpy
        import pyarrow as pa

        from tickforge.llm import topk as op

        def matrix(table):
            ids = table.column("vec_id").to_numpy()
            flat = table.column("v").combine_chunks()
            flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
            return ids, numpy.asarray(flat.flatten(), dtype="int64").reshape(len(ids), -1)

        found = []
        if asks.num_rows and rows.num_rows:
            ids, block = matrix(rows)
            found = list(op.search_block(op.Block(ids, block), *matrix(asks), k))
        return pa.table({n: pa.array([f[i] for f in found], pa.int64())
                         for i, n in enumerate(("query_id", "vec_id", "score"))})

    key = ["dims", "cb", "qb"]
    partial = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(
        run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (partial.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
