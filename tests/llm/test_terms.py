from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from threadmill.llm.common import text_steps
from threadmill.llm.terms import Terms, crc32, hash64

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBz09 é_日\x00\n", max_size=90)), max_size=6), st.integers(1, 3), st.integers(1, 200))
def test_runs_and_their_hashes(texts, most, step):
    for at, to, data, offsets in text_steps(pa.array(texts, pa.string()), step):
        terms = Terms(data, offsets)
        start, end, owner = terms.runs(most)
        got = sorted((int(o), terms.data[a:b].tobytes()) for a, b, o in zip(start, end, owner))
        words = [TERM.findall(lowered(t)) for t in texts[at:to]]
        want = sorted((i, " ".join(w[j : j + k]).encode()) for i, w in enumerate(words) for k in range(1, most + 1) for j in range(len(w) - k + 1))
        assert got == want
        slices = [terms.data[a:b].tobytes() for a, b in zip(start, end)]
        assert crc32(terms.data, start, end).tolist() == [zlib.crc32(s) for s in slices]
        assert len(set(hash64(terms.data, start, end).tolist())) == len(set(slices))


def test_long_terms():
    text = np.frombuffer(b"A" * 70_000 + b" b " + b"a" * 70_000, np.uint8)
    terms = Terms(text, np.array([0, len(text)]))
    codes = hash64(terms.data, terms.start, terms.end)
    assert len(codes) == 3 and codes[0] == codes[2] != codes[1]
    assert crc32(terms.data, terms.start, terms.end)[0] == zlib.crc32(b"a" * 70_000)
