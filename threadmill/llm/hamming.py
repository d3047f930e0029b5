"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

A rotation is learned on at most SAMPLE vectors: principal axes, then rounds that turn them so
that signs lose least (iterative quantisation). The signs of a rotated vector are its code. In
each block codes are split into substrings, and each substring indexes the block. Two codes
within Hamming distance r agree within floor(r / m) in one of m substrings, so looking up
all substring values that near finds every code within r. Those are confirmed by their whole
codes and ranked by the cosine of the original vectors.

The radius is the distance within which the sample has its own nearest neighbours RECALL of the
time; the whole table has nearer ones, so its recall is higher. Queries that find fewer than k
rows are asked again without a radius. Zero vectors take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.vectors import Matrix, best, kth_best, matrix, sample, top_k, valid_vectors
from threadmill.session import materialize

SAMPLE = 8192
#: Queries of the sample that the radius is set by.
PROBES = 400
RECALL = 0.97
ROUNDS = 30
#: Bits of a substring; about as many as a block's size has.
SUBSTRING = 11
#: Queries of a block; each block of queries costs a copy of all data on the way to it.
QUERIES = 8192
#: Pairs of a query and a row of a block whose codes are compared at once, so that memory does not grow with blocks.
STEP_PAIRS = 1 << 18
#: Bytes of vectors that are put side by side at once to score the pairs found.
STEP_BYTES = 1 << 23

_POP = np.array([bin(i).count("1") for i in range(1 << SUBSTRING)], np.uint8)


def unit(vectors: Matrix) -> Matrix:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


class Codes:
    """A learned rotation, and the radius that goes with it."""

    def __init__(self, vectors: Matrix, k: int, seed: int = 9):
        x = unit(vectors)
        d = x.shape[1] if x.size else 1
        rng = np.random.default_rng(seed)
        self.axes = np.linalg.qr(rng.normal(size=(d, d)))[0]
        if len(x) > 1:
            _, basis = np.linalg.eigh(x.T @ x)
            turned = x @ basis
            turn = self.axes
            for _ in range(ROUNDS):
                u, _, v = np.linalg.svd(np.sign(turned @ turn).T @ turned)
                turn = (u @ v).T
            self.axes = basis @ turn
        self.bits = d
        self.cuts = list(range(0, d, SUBSTRING))
        self.radius = d
        n = len(x)
        if n > k:
            rows = rng.permutation(n)[:PROBES]
            near = x[rows] @ x.T
            near[np.arange(len(rows)), rows] = -np.inf
            top = np.argpartition(near, n - k, axis=1)[:, n - k :]
            signs = x @ self.axes >= 0
            apart = (signs[rows][:, None, :] != signs[top]).sum(axis=2)
            self.radius = int(np.quantile(apart, RECALL, method="higher"))

    def __call__(self, unit_vectors: Matrix) -> np.ndarray:
        """Substrings of each code, one row each."""
        signs = unit_vectors @ self.axes >= 0
        parts = [signs[:, c : c + SUBSTRING] for c in self.cuts]
        return np.stack([p @ (1 << np.arange(p.shape[1])) for p in parts], axis=1).astype(np.uint16)


class MultiIndex:
    """For each substring the values that occur in a block and the rows that have them."""

    def __init__(self, codes: np.ndarray):
        self.tables = [np.unique(codes[:, j], return_inverse=True) for j in range(codes.shape[1])]
        self.rows = len(codes)

    def within(self, codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query row, data row) of all pairs of codes that differ in at most ``radius`` bits."""
        reach = radius // len(self.tables)
        found = np.zeros((len(codes), self.rows), bool)
        apart = np.zeros((len(codes), self.rows), np.uint16)
        for j, (values, row_value) in enumerate(self.tables):
            # A block has no more values than rows, so all its values are looked at, not all probes.
            distance = _POP[codes[:, j][:, None] ^ values]
            found |= (distance <= reach)[:, row_value]
            apart += distance[:, row_value]
        return np.nonzero(found & (apart <= radius))


def nearest(table: DataFrame, every: int, k: int, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest found of each row whose id ``every`` divides: query_id, rank, vec_id, score (cosine)."""
    spark = table.sparkSession
    data = valid_vectors(table, id_, vector).where(F.exists("v", lambda x: x != 0))
    some_ids, some = sample(data, SAMPLE)
    learned = Codes(some, k)
    shared = spark.sparkContext.broadcast((learned, some_ids[:1024], unit(some[:1024]) if len(some) else some))
    queries = data.where(F.col("id") % every == 0)

    def search_within(radius: int):
        def search(query_ids: np.ndarray, asked: pa.Table, ids: np.ndarray, vectors: Matrix):
            codes, known_ids, known = shared.value
            raw = matrix(asked["v"])
            q, x = unit(raw), unit(vectors)
            sizes, lengths = np.linalg.norm(raw, axis=1), np.linalg.norm(vectors, axis=1)
            index, asked_codes = MultiIndex(codes(x)), codes(q)
            step, pairs = max(1, STEP_PAIRS // len(ids)), max(1, STEP_BYTES // (16 * q.shape[1]))
            out = []
            for at in range(0, len(q), step):
                here = slice(at, at + step)
                # What the sample reaches is a floor for the k-th score.
                base = q[here] @ known.T
                base[query_ids[here][:, None] == known_ids] = -np.inf
                floor = kth_best(base, k) - 1e-9
                rows, cols = index.within(asked_codes[here], radius)
                other = ids[cols] != query_ids[here][rows]
                rows, cols = rows[other] + at, cols[other]
                for first in range(0, len(rows), pairs):
                    r, c = rows[first : first + pairs], cols[first : first + pairs]
                    good = np.einsum("ij,ij->i", q[r], x[c]) >= floor[r - at]
                    r, c = r[good], c[good]
                    score = np.einsum("ij,ij->i", raw[r], vectors[c]) / (sizes[r] * lengths[c])
                    out.append(best(r, ids[c], score, k))
            if not out:
                return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
            return tuple(np.concatenate(part) for part in zip(*out))

        return search

    found = top_k(queries, data, k, "double", search_within(learned.radius), QUERIES)
    if learned.radius >= learned.bits:
        return found
    found = materialize(found, "near")
    full = found.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("id"))
    missed = queries.join(full, "id", "left_anti")
    if missed.isEmpty():
        return found
    again = top_k(missed, data, k, "double", search_within(learned.bits), QUERIES)
    return found.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(again)
