from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from threadmill.llm import covertree, hamming


def table(spark, vectors, extra=()):
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


BAD = [(5000, None, 1), (5010, [1.0, None, 0.0, 0.0], 1), (5020, [1.0, float("nan"), 0.0, 0.0], 1),
       (5030, [float("inf"), 0.0, 0.0, 0.0], 1), (5040, [1.0], 1), (5050, [], 1), (None, [1.0, 0.0, 0.0, 0.0], 1)]


@pytest.fixture(scope="module")
def vectors():
    """Clusters, many equal vectors, ties."""
    rng = np.random.default_rng(3)
    near = rng.normal(size=(8, 4))[rng.integers(0, 8, 250)] + 0.05 * rng.normal(size=(250, 4))
    return np.concatenate([near, np.tile(near[:1], (60, 1)), rng.normal(size=(60, 4))]).astype(np.float32)


def test_cover_tree_covers_and_separates():
    points = np.random.default_rng(1).normal(size=(300, 5))
    points[50:90] = points[0]
    tree = covertree.CoverTree(points)
    leaves = []
    for node, children in enumerate(tree.children):
        own = tree.members[node]
        away = np.linalg.norm(points[own] - points[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-12
        if len(children):
            assert sorted(np.concatenate([tree.members[c] for c in children])) == sorted(own)
            reach = tree.radius[node] / covertree.SHRINK
            centres = points[tree.centre_of[children]]
            if tree.radius[node]:
                apart = np.linalg.norm(centres[:, None] - centres, axis=2) + np.eye(len(children)) * 1e9
                assert apart.min() > reach
        else:
            leaves += own.tolist()
    assert sorted(leaves) == list(range(300))


def brute(scores, ids, asked, k):
    out = []
    for q in asked:
        other = [j for j in range(len(ids)) if ids[j] != ids[q]]
        for rank, j in enumerate(sorted(other, key=lambda j: (-scores[q][j], ids[j]))[:k], 1):
            out.append((ids[q], rank, ids[j], scores[q][j]))
    return out


def test_top_k_is_exact(spark, vectors):
    whole = np.floor(1024 * vectors.astype(float))
    ids = list(range(len(vectors)))
    want = brute((whole @ whole.T).astype(int).tolist(), ids, ids[::10], 7)
    got = covertree.exact_top_k(table(spark, vectors, BAD + [(20, [float(x) for x in vectors[20]], 9)]), 10, 7)
    assert sorted(map(tuple, got.collect())) == want
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint"]


def test_fewer_rows_than_k(spark, vectors):
    assert covertree.exact_top_k(table(spark, vectors[:4]), 2, 10).count() == 6
    assert covertree.exact_top_k(table(spark, vectors[:1]), 1, 10).collect() == []
    assert covertree.exact_top_k(table(spark, [], BAD[:2]), 1, 10).collect() == []


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(900, 16)), np.tile(rng.normal(size=(1, 16)), (100, 1)), np.zeros((3, 16))]).astype(np.float32)
    bad = [(5000 + i, v and [float(a) for a in np.resize([0 if b is None else b for b in v], 16)], 1) for i, (_, v, _) in enumerate(BAD[3:4])]
    got = hamming.nearest(table(spark, x, bad), 20, 5).collect()
    d = x[:1000].astype(float)
    unit = d / np.linalg.norm(d, axis=1, keepdims=True)
    cosine = unit @ unit.T
    asked = range(0, 1000, 20)
    assert sorted({r.query_id for r in got}) == list(asked) and all(r.rank <= 5 for r in got) and len(got) == 250
    for r in got:
        assert r.vec_id < 1000 and abs(r.score - cosine[r.query_id, r.vec_id]) < 1e-12
    want = {(q, j) for q, _, j, _ in brute(cosine.round(12).tolist(), list(range(1000)), asked, 5)}
    assert len(want & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(want)


def test_index_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = hamming.Codes(rng.normal(size=(400, 30)), 5)
    x, q = (hamming.unit(rng.normal(size=(n, 30))) for n in (300, 20))
    rows, cols = hamming.MultiIndex(codes(x)).within(codes(q), 11)
    apart = ((q @ codes.axes >= 0)[:, None] != (x @ codes.axes >= 0)[None]).sum(axis=2)
    assert set(zip(rows, cols)) == set(zip(*np.nonzero(apart <= 11)))
    assert np.allclose(codes.axes @ codes.axes.T, np.eye(30))


def test_few_neighbours(spark):
    x = np.eye(4, dtype=np.float32)
    assert hamming.nearest(table(spark, x, BAD[:1]), 1, 5).count() == 12
    assert hamming.nearest(table(spark, [], BAD[:1]), 1, 5).collect() == []


def test_memory_of_a_search_does_not_grow_with_the_pairs_found(spark, monkeypatch):
    """All pairs lie within the radius here; their vectors side by side were 2 x 1.3 GB for a block of a 6 GB run."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 32))
    held = {}
    monkeypatch.setattr(hamming, "top_k", lambda q, data, k, kind, search, *_: held.setdefault("search", search) and data)
    monkeypatch.setattr(hamming, "materialize", lambda df, _: df)
    monkeypatch.setattr(hamming, "RECALL", 1.0)
    try:
        hamming.nearest(table(spark, x[:200]), 10, 5)
    except Exception:
        pass  # what follows the first search has no columns to go on with
    asked = pa.table({"v": pa.array(x[:600].tolist(), pa.list_(pa.float64()))})
    tracemalloc.start()
    rows, found, score = held["search"](np.arange(600), asked, np.arange(3000), x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    unit = hamming.unit(x)
    order = np.lexsort((found, -score, rows))
    for i in range(0, 600, 50):
        mine = found[order][rows[order] == i][:5]
        cosine = unit[i] @ unit.T
        cosine[i] = -1
        # Codes may miss a neighbour; the nearest that is found must be one.
        assert len(mine) == 5 and np.all(np.diff(cosine[mine]) <= 0)
