from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixture import documents, frame, prose
from tests.llm.test_terms import TERM, lowered
from threadmill.llm import lexical


def plain(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    bags = [(d[0], Counter(TERM.findall(lowered(d[1])))) for d in docs]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c, n in bags:
            m = 25 + (75 * n * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in TERM.findall(lowered(text))
            )
            if score > 0 and doc_id is not None:
                found.append((-score, doc_id))
        out += [(item_id, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return out


def queries(docs):
    rng = random.Random(5)
    texts = [t for _, t, *_ in docs if t and len(t) > 60]
    asked = [" ".join(rng.sample(rng.choice(texts).split(), 8)) + " Unheard" for _ in range(25)]
    asked += [None, "", "...", "one", "two two two words", texts[0], prose(rng, 3000), "ONE é"]
    return [(i if i % 7 else None, t) for i, t in enumerate(asked)] + [(3, "two words")] * 2


@pytest.mark.parametrize("block,slab", [(2048, 64), (5, 3)])
def test_all_pairs(spark, monkeypatch, block, slab):
    monkeypatch.setattr(lexical, "QUERY_BLOCK", block)
    docs = documents(plain=150) + [(1, "two again words", None, None, 5)] * 2 + [(None, "two words", None, None, 5)]
    docs += [(901, "one " * 400, None, None, 1), (902, "é É ONE é" * 9, None, None, 1)]
    items = queries(docs)
    df = frame(spark, docs).withColumnsRenamed({"lang": "n", "source": "sketch"})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = lexical.search(lexical.index(df), asked, 10)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(docs, items, 10)))


def test_empty_tables(spark):
    docs, none = frame(spark, documents()), frame(spark, [])
    asked = spark.createDataFrame([("a", "one two")], "item_id string, text string")
    assert lexical.search(lexical.index(none), asked, 10).collect() == []
    assert lexical.search(lexical.index(docs), asked.limit(0), 10).collect() == []
    assert lexical.search(lexical.index(docs), asked, 10).dtypes[0] == ("item_id", "string")


def test_bounds_hold_and_save_work(spark):
    """No bound is below its score, and few documents must be scored for a passage that some of them hold."""
    rng = random.Random(8)
    passage = prose(rng, 40)
    docs = [(i, prose(rng, 200) + (" " + passage if i % 200 == 0 else ""), None, None, 0) for i in range(2000)]
    rows = lexical.index(frame(spark, docs, parts=1)).toArrow().combine_chunks().to_batches()[0]
    q = lexical._Queries(pa.array([passage, "ka lo mi"]))
    terms, at = lexical._whole(rows.column(3), "<u8")
    counts, _ = lexical._whole(rows.column(4), "<u4")
    df = np.array([(terms == v).sum() for v in q.vocabulary])
    n = rows.column(1).to_numpy()
    q.weigh(len(n), df, int(n.sum()))
    exact = q.scores(n, terms, counts, at)
    bound = np.zeros(exact.shape)
    for part, got in lexical._bounds(q, n, rows.column(2), {}):
        bound[part] = got
    assert (bound >= exact).all() and (bound > 0).any()
    kth = np.sort(exact[:, 0])[-10]
    assert (bound[:, 0] >= kth).mean() < 0.1
