"""Exact top-k by inner product with two cover trees, one over queries and one over data.

A tree node has a centre and a radius that covers all its points; its children's centres lie
further apart than the covering distance of their level and every point is within that distance
of one of them. For a query node (centre p, radius r) and a data node (centre c, radius s)

    max <q, x>  <=  <p, c> + |p| s + |c| r + r s

so a pair of nodes is left as soon as that is below the worst k-th score among the node's
queries. Each query starts with the k-th score it reaches in a bounded sample of the data, which
can only be too low. Trees are built per block (see ``vectors``); results are exact whatever the
blocks. Components are floor(SCALE x), so scores are whole numbers; they are exact as long as
they stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadmill.llm.vectors import SAMPLE, Matrix, kth_best, matrix, sample, top_k, valid_vectors

SCALE = 1024.0
#: The covering distance shrinks by this factor from a node to its children.
SHRINK = 1.3
#: A query node of so few queries is searched at once.
LEAF_QUERIES = 48


class CoverTree:
    def __init__(self, points: Matrix):
        self.points = points
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray] = []
        self.members: list[np.ndarray] = []
        self._grow(np.arange(len(points)))
        self.centre_of, self.radius_of = np.array(self.centre, int), np.array(self.radius)
        self.inner = np.array([len(c) > 0 for c in self.children], bool)
        self.norm_of = np.linalg.norm(points[self.centre_of], axis=1) if len(points) else np.zeros(0)

    def _add(self, centre: int, radius: float, members: np.ndarray) -> int:
        self.centre.append(int(centre))
        self.radius.append(float(radius))
        self.children.append(np.zeros(0, int))
        self.members.append(members)
        return len(self.centre) - 1

    def _grow(self, all_points: np.ndarray) -> None:
        if not len(all_points):
            return
        away = np.linalg.norm(self.points - self.points[0], axis=1)
        todo = [(self._add(0, away.max(), all_points), away)]
        while todo:
            node, near = todo.pop()
            members = self.members[node]
            if len(members) == 1:
                continue
            if self.radius[node] == 0:
                # Equal points: one leaf each.
                self.children[node] = np.array([self._add(i, 0.0, members[j : j + 1]) for j, i in enumerate(members)])
                continue
            reach, own = self.radius[node] / SHRINK, self.points[members]
            centres, nearest, near = [self.centre[node]], np.zeros(len(members), int), near.copy()
            while near.max() > reach:
                far = int(near.argmax())
                to_far = np.linalg.norm(own - own[far], axis=1)
                closer = to_far < near
                nearest[closer] = len(centres)
                near = np.minimum(near, to_far)
                centres.append(members[far])
            by = np.argsort(nearest, kind="stable")
            made = []
            for c, part in zip(centres, np.split(by, np.cumsum(np.bincount(nearest, minlength=len(centres)))[:-1])):
                child = self._add(c, near[part].max(), members[part])
                made.append(child)
                todo.append((child, near[part]))
            self.children[node] = np.array(made)


def dual_search(
    queries: Matrix, query_ids: np.ndarray, floors: np.ndarray, data: Matrix, ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, data id, score) with at least the k best of each query that reach its floor."""
    asked, held = CoverTree(queries), CoverTree(data)
    norms = np.linalg.norm(queries, axis=1)
    best = np.full((len(queries), k), -np.inf)
    worst = floors.astype(float).copy()
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def above(bound: Matrix, least: np.ndarray) -> np.ndarray:
        # Bounds are rounded; a little room keeps them bounds.
        return bound + 1e-9 * (np.abs(bound) + 1) >= least

    def leaf(rows: np.ndarray, nodes: np.ndarray) -> None:
        q = queries[rows]
        while len(nodes):
            score = q @ data[held.centre_of[nodes]].T
            inner = held.inner[nodes]
            own = ids[held.centre_of[nodes[~inner]]]
            points = score[:, ~inner]
            points = np.where(query_ids[rows][:, None] == own, -np.inf, points)
            good = points >= worst[rows][:, None]
            good &= points > -np.inf
            r, c = np.nonzero(good)
            if len(r):
                out.append((rows[r], own[c], points[r, c]))
                both = np.concatenate([best[rows], np.where(good, points, -np.inf)], axis=1)
                best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                worst[rows] = np.maximum(worst[rows], best[rows].min(axis=1))
            reach = score[:, inner] + norms[rows][:, None] * held.radius_of[nodes[inner]]
            alive = above(reach, worst[rows][:, None]).any(axis=0)
            nodes = _children(held, nodes[inner][alive])

    todo = [(0, np.zeros(1, int))] if len(queries) and len(data) else []
    while todo:
        node, nodes = todo.pop()
        p, r = queries[asked.centre_of[node]], asked.radius_of[node]
        s, c = held.radius_of[nodes], held.norm_of[nodes]
        bound = data[held.centre_of[nodes]] @ p + asked.norm_of[node] * s + c * r + r * s
        nodes = nodes[above(bound, worst[asked.members[node]].min())]
        if not len(nodes):
            continue
        if len(asked.members[node]) <= LEAF_QUERIES or not asked.inner[node]:
            leaf(asked.members[node], nodes)
            continue
        # The wider side is opened: data nodes wider than the query node, and the query node.
        wide = held.inner[nodes] & (held.radius_of[nodes] > r)
        nodes = np.concatenate([nodes[~wide], _children(held, nodes[wide])])
        todo += [(int(child), nodes) for child in asked.children[node]]
    if not out:
        return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*out))


def _children(tree: CoverTree, nodes: np.ndarray) -> np.ndarray:
    return np.concatenate([tree.children[i] for i in nodes]) if len(nodes) else np.zeros(0, int)


def whole(vectors: Matrix) -> Matrix:
    return np.floor(SCALE * vectors)


def exact_top_k(table: DataFrame, every: int, k: int, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k greatest inner products of each row whose id ``every`` divides: query_id, rank, vec_id, score."""
    data = valid_vectors(table, id_, vector)
    some_ids, some = sample(data, SAMPLE)
    some = whole(some)
    shared = data.sparkSession.sparkContext.broadcast((some_ids, some))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ids, known = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            scores = whole(matrix(batch.column(1))) @ known.T
            scores[ids[:, None] == known_ids] = -np.inf
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kth_best(scores, k))], ["id", "v", "floor"])

    kind = data.schema["v"].dataType.simpleString()
    queries = data.where(F.col("id") % every == 0).mapInArrow(floors, f"id long, v {kind}, floor double")

    def search(query_ids: np.ndarray, asked: pa.Table, ids: np.ndarray, vectors: Matrix):
        return dual_search(whole(matrix(asked["v"])), query_ids, asked["floor"].to_numpy(), whole(vectors), ids, k)

    return top_k(queries, data, k, "long", search)
