from __future__ import annotations

import zlib

import numpy as np

from tests.llm.fixture import documents, frame
from threadmill.llm import sharding


def scalar(key, shards):
    """The published loop, one key at a time."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_is_the_published_one():
    keys = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    for n in (1, 2, 24, 1000):
        assert sharding.jump(keys, n).tolist() == [scalar(int(k), n) for k in keys]


def test_shards_move_into_the_new_one_only(spark):
    docs = documents(plain=400) + [(1, "again", None, None, 5)] * 200 + [(None, "no id", None, None, 5)] * 3
    rows = sharding.assign_shards(frame(spark, docs).withColumnRenamed("n_chars", "slot"), "doc_id", 6).collect()
    assert len(rows) == len(docs)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    moved = [r for r in rows if r.shard != r.grown_shard]
    assert moved and {r.grown_shard for r in moved} == {6}
    by_key = {}
    for r in rows:
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
    assert sharding.assign_shards(frame(spark, []), "doc_id", 6).collect() == []


def test_query_columns(spark, tmp_path):
    from threadmill.llm.queries import QUERIES

    docs = documents()
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op9_shards"](spark, str(tmp_path)).collect()
    texts = {d[0]: (d[1] or "").encode() for d in docs}
    assert all(r.size == len(texts[r.doc_id]) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert {r.law for r in rows} == {"key"}
