from __future__ import annotations

import hashlib
import math
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.fixture import documents, frame
from tests.llm.test_terms import TERM, lowered
from threadmill.llm import resampling


def features(text, run):
    words = TERM.findall(lowered(text))
    return [" ".join(words[i : i + k]).encode() for k in range(1, run + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, percent, run=1, buckets=10_000, least=20):
    """(doc_id, n_features, weight, score, rank) by one sort."""
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text, run):
                counts[zlib.crc32(f) % buckets] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text, *_ in docs:
        found = features(text, run)
        weight = sum(gain[zlib.crc32(f) % buckets] for f in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r in rows if r[1] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0], -r[2], -r[1]))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return rows


def rows_of(df):
    return sorted(map(str, map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect())))


@pytest.mark.parametrize("percent,run,buckets,least", [(10, 1, 10_000, 20), (40, 1, 7, 1), (100, 2, 50, 0), (0, 1, 10, 1), (33, 3, 1000, 5)])
def test_draw(spark, percent, run, buckets, least):
    docs = documents() + [(None, "a b c " * 30, None, None, 1)] * 3 + [(4, "twice the id " * 9, None, None, 1)] * 3
    target = [d[1] for d in documents(seed=2, plain=9)]
    df = frame(spark, docs).withColumnsRenamed({"lang": "score", "source": "rank"})
    asked = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, asked, percent, run=run, buckets=buckets, least_features=least)
    assert rows_of(got) == sorted(str(tuple(r)) for r in plain(docs, target, percent, run, buckets, least))


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, 5 if i % 3 else 9) for i in range(200)] + [(None, 5)] * 4
    df = spark.createDataFrame(rows, "doc_id long, score long")
    for wanted in (0, 1, 66, 67, 68, 100, 199, 200, 201, 204, 300):
        got = {r.doc_id for r in df.where(resampling.cutoff(df, wanted)).collect()}
        order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        assert got == {r[0] for r in order[:wanted]}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40), st.data())
def test_bisection(spark, values, data):
    wanted = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "x long").coalesce(1)
    assert resampling._least(df, "x", min(values), max(values), wanted) == sorted(values)[wanted - 1]


def test_empty_tables(spark):
    none = frame(spark, [])
    assert resampling.resample(none, none, 10).collect() == []
    docs = documents()
    assert rows_of(resampling.resample(frame(spark, docs), none, 10)) == sorted(str(tuple(r)) for r in plain(docs, [], 10))
