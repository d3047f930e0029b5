from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from threadmill.llm.common import Words, labelled_sample, ranked, text_steps

TEXTS = ["Eins  zwei\tdrei", None, "", " ", "drei", "zwei", "EINS", "é É\x0bx y", "a" * 5000 + " b"]


def test_words_are_those_of_a_plain_split():
    got = []
    for at, to, data, offsets in text_steps(pa.array(TEXTS), step_bytes=7):
        w = Words(data, offsets)
        hashes, prefixes = w.hash(), w.prefix(2)
        for i in range(to - at):
            part = slice(w.first[i], w.first[i + 1])
            words = [bytes(w.data[a:b]) for a, b in zip(w.start[part], w.end[part])]
            got.append((words, hashes[part].tolist(), prefixes[part].tolist()))
    assert [g[0] for g in got] == [(t or "").encode().lower().split() for t in TEXTS]
    seen = {}
    for words, hashes, _ in got:
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    eins = {p for words, _, ps in got for w, p in zip(words, ps) if w[:2] == b"ei"}
    assert len(eins) == 1


def test_steps_cover_sliced_columns():
    column = pa.array(["ab", "c", None, "defg"]).slice(1)
    parts = [(a, b, bytes(d), o.tolist()) for a, b, d, o in text_steps(column)]
    assert parts == [(0, 3, b"cdefg", [0, 1, 1, 5])]
    assert list(text_steps(pa.array([], pa.string()))) == []


def test_ranks_have_no_gaps_with_a_hot_null_key(spark):
    rows = [(None if i % 3 else i % 2, i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, i long")
    got = ranked(df, "k", F.pmod(F.xxhash64("i"), F.lit(7)), [F.col("i")], "r").collect()
    for key in (None, 0, 1):
        ranks = sorted(r.r for r in got if r.k == key)
        assert ranks == list(range(len(ranks)))


def test_sample_is_bounded_per_label(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(100)], "doc_id long, y int")
    got = labelled_sample(df, "y", 5).collect()
    assert np.bincount([r.y for r in got]).tolist() == [5, 5, 5]
    assert {r.doc_id for r in got} == {r.doc_id for r in labelled_sample(df.repartition(7), "y", 5).collect()}


def test_sample_of_a_large_label_is_the_lowest_hashes(spark):
    df = spark.range(0, 30_000).selectExpr("id AS doc_id", "CASE WHEN id % 100 = 0 THEN 'rare' ELSE 'hot' END AS y")
    got = labelled_sample(df, "y", 40)
    for y in ("rare", "hot"):
        want = df.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(40)
        assert {r.doc_id for r in got.where(F.col("y") == y).collect()} == {r.doc_id for r in want.collect()}
