from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.fixture import documents, frame
from threadmill.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "a\n b", "it's 12 3", "é \t ü", "a\n\nb c", "\n a b", "a  b",
       "<|endoftext|> x <|endoftext|>", "日本 語", "x" * 3000 + " y", "a 's b"]


def test_ids_are_those_of_whole_texts():
    got = [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(ODD, PATH)]
    assert got == whole(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t'1é. ", max_size=20), max_size=6))
def test_ids_of_any_text(texts):
    assert [np.frombuffer(b, "<u4").tolist() for b in packing.token_bytes(texts, PATH)] == whole(texts)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 200)))
def test_plan_places_every_rank_once(counts):
    packs = packing.pack_histogram(counts, 32)
    used = Counter()
    for lengths, n in packs:
        assert n > 0 and sum(lengths) <= 32
        for x in lengths:
            used[x] += n
    assert used == Counter(counts)
    rows = packing.pack_plan(counts, 32)
    for length, n in counts.items():
        ranks = sorted(r for row in rows if row["_length"] == length for r in range(row["_from"], row["_to"]))
        assert ranks == list(range(n))
    # Worst fit of falling lengths needs at most twice the sequences that the tokens fill.
    tokens = sum(k * v for k, v in counts.items())
    assert sum(n for _, n in packs) <= 2 * -(-tokens // 32) + 1


def check(rows, docs, sequence):
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    wanted = Counter()
    for (key, text), n in Counter(docs).items():
        ids = np.array(whole([text or ""])[0] + [0], "<u4")
        for s in range(0, len(ids), sequence):
            piece = ids[s : s + sequence]
            wanted[key, s, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += n
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    at = {}
    for seq, offset, length in places:
        assert at.get(seq, 0) == offset
        at[seq] = offset + length
        assert at[seq] <= sequence
    assert sorted(at) == list(range(len(at)))


def test_whole_pieces_of_all_rows(spark):
    docs = documents() + [(1, "again", None, None, 5)] * 2 + [(None, "no id", None, None, 5)]
    df = frame(spark, docs).withColumnRenamed("n_chars", "offset")
    for sequence in (64, 1024):
        check(packing.pack(df, PATH, sequence).collect(), [d[:2] for d in docs], sequence)


def test_order_and_empty(spark):
    docs = [(i, "word", None, None, 4) for i in range(40)]
    df = frame(spark, docs).selectExpr("*", "doc_id div 10 AS f", "39 - doc_id AS p")
    rows = packing.pack(df, PATH, 8, order=("f", "p")).collect()
    check(rows, [d[:2] for d in docs], 8)
    placed = [r.doc_id for r in sorted(rows, key=lambda r: (r.offset, r.sequence_id))]
    assert placed == sorted(placed, key=lambda d: (d // 10, -d))
    assert packing.pack(frame(spark, []), PATH).collect() == []
