"""Vectors in blocks: a query set against all rows, one block of each at a time.

Vectors that are null, hold a null or a non-finite number, or have another length than most take
no part, nor do rows without an id. Of rows that repeat an id the one with the least vector
counts. Queries and data are dealt into blocks of bounded size; every pair of a query block and
a data block is one group of a co-grouped call, which returns at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadmill.session import materialize

QUERY_BLOCK = 1024
#: Rows of a data block: a 64th of all, within these bounds.
DATA_BLOCK = (1024, 16384)
#: Vectors that give each query a first bound, or that a model is fitted on.
SAMPLE = 1024

Matrix = np.ndarray


def valid_vectors(table: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part, stored."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = table.where(F.col(id_).isNotNull() & F.col(vector).isNotNull()).where(whole)
    rows = rows.groupBy(F.col(id_).cast("long").alias("id")).agg(F.min(vector).alias("v")).where(F.size("v") > 0)
    rows = materialize(rows, "vectors")
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> Matrix:
    """A column of equally long lists as float64 rows."""
    if not len(column):
        return np.zeros((0, 0))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def sample(vectors: DataFrame, rows: int) -> tuple[np.ndarray, Matrix]:
    """Ids and vectors of at most ``rows`` rows, those whose id hashes lowest."""
    got = vectors.orderBy(F.xxhash64("id"), "id").limit(rows).toArrow()
    return got["id"].to_numpy(), matrix(got["v"])


def top_k(
    queries: DataFrame, data: DataFrame, k: int, kind: str,
    search: Callable[[np.ndarray, pa.Table, np.ndarray, Matrix], tuple[np.ndarray, np.ndarray, np.ndarray]],
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of what ``search`` gives for each pair of blocks.

    ``search(query ids, query columns, data ids, data vectors)`` returns row numbers of queries,
    data ids and scores.
    """
    n, q = data.count(), queries.count()
    size = min(max(n // 64, DATA_BLOCK[0]), DATA_BLOCK[1])
    data_blocks, query_blocks = max(1, -(-n // size)), max(1, -(-q // query_block))
    dealt = lambda blocks: F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    # Queries are rows of the data; columns of their own keep the two sides apart.
    left = queries.select(*[F.col(c).alias(c) for c in queries.columns], dealt(query_blocks).alias("_q"))
    left = left.withColumn("_d", every(data_blocks))
    right = data.withColumn("_d", dealt(data_blocks)).withColumn("_q", every(query_blocks))
    dtype = np.int64 if kind == "long" else np.float64

    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        ids = asked["id"].to_numpy() if asked.num_rows else np.zeros(0, np.int64)
        row, found, score = np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
        if asked.num_rows and held.num_rows:
            row, found, score = search(ids, asked, held["id"].to_numpy(), matrix(held["v"]))
            row, found, score = best(row, found, score, k)
        return pa.table({"query_id": ids[row], "vec_id": found, "score": score.astype(dtype)})

    pairs = left.groupBy("_q", "_d").cogroup(right.groupBy("_q", "_d"))
    found = pairs.applyInArrow(run, f"query_id long, vec_id long, score {kind}")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best(row: np.ndarray, found: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its k greatest scores, ties to the smaller id."""
    by = np.lexsort((found, -score, row))
    row, found, score = row[by], found[by], score[by]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], found[keep], score[keep]


def kth_best(scores: Matrix, k: int) -> np.ndarray:
    """Of each row the k-th greatest score, or minus infinity if there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
