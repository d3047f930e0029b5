"""Ids against the public library's, and the way back."""

from __future__ import annotations

import hashlib
import random
from heapq import heappop

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.fixture import documents, frame
from threadmill.llm import bytepair
from threadmill.llm.queries import QUERIES, RANKS

PATTERN = public_tokenizers.PATTERN
TABLE = bytepair.load(RANKS)
CODEC = bytepair.Codec(TABLE, PATTERN)
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=dict(TABLE), special_tokens={})


def ids(text):
    return np.frombuffer(CODEC.encode([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aetionrs ' 19.é\n\t", max_size=200)))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(np.frombuffer(CODEC.encode([text])[0], "<u4")).tobytes() == text.encode()


def test_very_long_pre_tokens():
    rng = random.Random(3)
    for text in ("a" * 120_000, "ab" * 60_000, "".join(rng.choice("etaoinsr") for _ in range(150_000)), "é" * 20_000, " " * 9_000):
        assert ids(text) == LIBRARY.encode_ordinary(text)
    long = "Ein langer Text mit 123 Wörtern.\n" * 40_000  # over the size that is looked up in steps
    assert ids(long) == LIBRARY.encode_ordinary(long)


def test_every_code_point_beside_others():
    for low in range(0, 0x110000, 4096):
        text = " x ".join(chr(c) + "1" + chr(c) for c in range(low, low + 4096) if not 0xD800 <= c < 0xE000)
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_memory_turns_over_and_keeps_its_answers(monkeypatch):
    monkeypatch.setattr(bytepair, "REMEMBERED", 50)
    monkeypatch.setattr(bytepair, "STEP_TOKENS", 20)
    codec = bytepair.Codec(TABLE, PATTERN)
    texts = ["".join(f" w{i * j % 170}" for i in range(1 + j % 40)) + "x" * (j % 3 * 70) for j in range(300)]
    got = [np.frombuffer(b, "<u4").tolist() for b in codec.encode(texts)]
    assert got == LIBRARY.encode_ordinary_batch(texts)
    assert len(codec.young) <= 50 + 60 and len(codec.old) <= 50 + 60
    assert max(map(len, codec.young)) <= bytepair.REMEMBERED_BYTES


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aetionrs é", min_size=1, max_size=30), max_size=30))
def test_pieces_share_a_queue_and_nothing_else(pieces):
    together = CODEC.merged([p.encode() for p in pieces])
    assert together == [CODEC.merged([p.encode()])[0] for p in pieces]
    assert not CODEC.queue.buckets and not any(map(any, CODEC.queue.levels))


def test_a_merge_may_make_a_pair_that_goes_first():
    table = [(bytes([c]), 200 + i) for i, c in enumerate(b"abcd")] + [(b"bc", 50), (b"abc", 3), (b"abcd", 100), (b"cd", 60), (b"bcd", 90)]
    codec = bytepair.Codec(table, r"\S+")
    library = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks=dict(table), special_tokens={})
    for text in ("abcbcd", "bcabcd", "bcbcabcdcd", "abcdabcabbcd" * 30):
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(0, 50)), max_size=80))
def test_queue_gives_the_lowest_rank(entries):
    queue, out = bytepair.RankQueue(70_001), []
    for rank, place in entries:
        queue.push(rank, place)
    while (rank := queue.lowest()) >= 0:
        bucket = queue.buckets[rank]
        out.append((rank, heappop(bucket)))
        if not bucket:
            queue.drop(rank)
    assert out == sorted(entries)
    assert not queue.buckets and not any(map(any, queue.levels))


def test_all_rows(spark, tmp_path):
    docs = documents() + [(1, "again", None, None, 5)] * 2 + [(None, "no id", None, None, 5), (7, "日" * 40_000, None, None, 1)]
    frame(spark, docs).withColumnRenamed("lang", "ids").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_bytepair"](spark, str(tmp_path)).collect()

    def digest(value):
        return hashlib.sha256(value).hexdigest()

    want = []
    for doc_id, text, *_ in docs:
        found = LIBRARY.encode_ordinary(text or "")
        want.append((doc_id, len(found), digest(",".join(map(str, found)).encode()), digest((text or "").encode())))
    by = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=by) == sorted(want, key=by)


def test_empty_table_and_null_ids(spark):
    table = bytepair.share(spark, RANKS, PATTERN)
    empty = frame(spark, []).select(bytepair.encode(F.col("text"), table).alias("ids"))
    assert empty.collect() == []
    nulls = spark.createDataFrame([(None,)], "ids array<int>").select(bytepair.decode(F.col("ids"), table).alias("b"))
    assert bytes(nulls.first().b) == b""


def test_a_byte_that_is_missing_is_an_error():
    with pytest.raises(KeyError):
        bytepair.Codec([(b"a", 0)], PATTERN).encode(["ab"])
