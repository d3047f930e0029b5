from __future__ import annotations

import random

import numpy as np
import pytest

from tests.llm.fixture import documents, edited, frame, prose
from threadmill.llm import jaccard
from threadmill.llm.components import components


def member_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(docs):
    """component_id of each row by comparing all pairs."""
    sets = [member_set(d[1]) for d in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s and sets[j] and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(docs)):
        groups.setdefault(find(i), []).append(i)
    least = {}
    for g in groups.values():
        ids = [docs[i][0] for i in g if docs[i][0] is not None]
        for i in g:
            least[i] = min(ids, default=None)
    return sorted(((docs[i][0], len(sets[i]), least[i]) for i in range(len(docs))), key=str)


def test_tree_links_are_those_of_plain_sets():
    rng = np.random.default_rng(2)
    for _ in range(60):
        base = rng.choice(500, 60, replace=False)
        sets = []
        for _ in range(12):
            own = np.concatenate([rng.permutation(base)[: rng.integers(30, 60)], rng.integers(500, 600, rng.integers(0, 20))])
            sets.append(np.unique(own).astype(np.int64))
        probe = np.unique(base).astype(np.int64)
        got = jaccard.tree_links(probe, sets)
        want = [4 * len(set(probe) & set(s)) >= 3 * len(set(probe) | set(s)) for s in sets]
        assert got.tolist() == want


@pytest.mark.parametrize("size", range(1, 60))
def test_sets_that_reach_the_threshold_share_a_branch(size):
    # The most a partner may lack is what lies before the last branch members.
    kept = size - jaccard.branch_members(size)
    assert 4 * kept < 3 * size and jaccard.branch_members(size) >= 1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 200), (300, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {300: 200, 200: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []


def test_all_rows_against_brute_force(spark):
    rng = random.Random(4)
    docs = [d[:2] for d in documents(seed=3)]
    base = prose(rng, 60)
    chain = [base]
    for _ in range(12):
        chain.append(edited(rng, chain[-1], 1))
    # A large group around one text, chains, and members that lack ids or repeat.
    docs += [(1000 + i, t) for i, t in enumerate(chain)]
    docs += [(2000 + i, edited(rng, base, 2)) for i in range(40)]
    docs += [(None, base), (5, base), (5, base), (6, "A b C d E"), (None, None)]
    got = jaccard.similarity_components(frame(spark, docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS sig"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)


def test_empty_table(spark):
    assert jaccard.similarity_components(frame(spark, [], "doc_id long, text string")).collect() == []
    nothing = frame(spark, [(1, None), (2, " ")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.similarity_components(nothing).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_pivots_lose_no_link(spark, monkeypatch):
    """The round in which nodes meet pivots first, on every input."""
    monkeypatch.setattr(jaccard, "FEW_PAIRS", -1)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    rows = documents(seed=21, plain=40)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similarity_components(frame(spark, rows)).collect()}
    assert got == set(brute([r[:2] for r in rows]))


def test_rounds_on_few_links_take_few_tasks(spark):
    """On a table of many partitions the rounds of a few links were mostly the starting of empty tasks."""
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        links = spark.range(400).selectExpr("id AS a", "id + (CASE WHEN id % 10 = 9 THEN 0 ELSE 1 END) AS b")
        found = components(links, "a", "b")
        assert {(r.node, r.root) for r in found.collect()} == {(i, i // 10 * 10) for i in range(400)}
        assert len(found.inputFiles()) <= spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
