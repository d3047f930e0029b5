from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.fixture import documents, frame
from threadmill.llm import mixing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), min_size=1, max_size=8))
def test_cycle_stays_within_one_block(shares):
    total, cycle = sum(shares), mixing.edf_cycle(shares)
    used = [0] * len(shares)
    for t, i in enumerate(cycle, 1):
        used[i] += 1
        assert all(abs(used[j] - t * w / total) < 1 for j, w in enumerate(shares))
    assert used == shares


def simulate(blocks, weights):
    """Slot by slot, without cycles: the released block with the earliest deadline."""
    left, now, used = dict(blocks), dict.fromkeys(blocks, 0), dict.fromkeys(blocks, 0)
    order, since = [], 0
    while any(left.values()):
        live = [s for s in weights if left.get(s)]
        total = sum(weights[s] for s in live)
        ready = [(-(-(now[s] + 1) * total // weights[s]), list(weights).index(s), s) for s in live
                 if now[s] * total // weights[s] <= len(order) - since]
        s = min(ready)[2]
        order.append((s, used[s]))
        used[s] += 1
        now[s] += 1
        left[s] -= 1
        if not left[s]:
            since, now = len(order), dict.fromkeys(blocks, 0)
    return order


def test_rows_follow_the_schedule(spark):
    docs = documents() + [(7, "again", None, "s1", 5)] * 3 + [(None, "x", None, "hot", 1)]
    weights, size = {"hot": 3, "s1": 2, "s2": 1, "*": 1}, 4
    df = frame(spark, docs).withColumnRenamed("n_chars", "slot")
    rows = sorted(mixing.mix(df, weights, size).collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(docs)))
    named = lambda s: s if s in ("hot", "s1", "s2") else "*"
    of = {}
    for d in docs:
        of.setdefault(named(d[3]), []).append(d[0])
    digest = lambda i: hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
    for s in of:
        of[s].sort(key=lambda i: (digest(i), -1 if i is None else i))
    blocks = {s: -(-len(x) // size) for s, x in of.items()}
    wanted = [i for s, k in simulate(blocks, weights) for i in of[s][k * size : (k + 1) * size]]
    assert [r.doc_id for r in rows] == wanted
    assert all(r.mix_source == named(r.source) for r in rows)


def test_files_in_order_and_empty(spark, tmp_path):
    docs = documents()
    df = frame(spark, docs)
    path = str(tmp_path / "mixed")
    mixing.in_mix_order(df, {"hot": 2}, 4, rows_per_file=20).write.parquet(path)
    out = spark.read.parquet(path)
    assert out.columns == df.columns
    rows = out.selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index i").collect()
    placed = {r.doc_id: r.position for r in mixing.mix(df, {"hot": 2}, 4).collect()}
    assert [placed[r.doc_id] for r in sorted(rows, key=lambda r: (r.f, r.i))] == list(range(len(docs)))
    assert mixing.mix(frame(spark, []), {"hot": 2}, 4).collect() == []
