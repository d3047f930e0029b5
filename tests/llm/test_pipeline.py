from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from tests.llm.fixture import documents, frame
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check
from tests.llm.test_sanitise import base
from threadmill.llm import mixing
from threadmill.llm.queries import MIX_BLOCK, MIX_WEIGHTS

MAIL = "write to ann@mail.example.com or 10.0.0.1 now"


def through(spark, tmp_path, rows):
    """Rows after every stage, each written and read again."""
    folder = str(tmp_path)
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def test_every_stage_against_a_plain_version(spark, tmp_path):
    rows = documents() + [(900 + i, f"{MAIL} {i} {'pa lo mi ' * i}", "xx", "src0", 1) for i in range(5)]
    named, single, clean, mixed, packed = through(spark, tmp_path, rows)
    assert [n for n, _ in pipeline.STAGES] == ["language", "near_copies", "personal_data", "mix", "pack"]
    for docs in (named, single, clean, mixed):
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    lettered = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert Counter(tuple(r) for r in named.collect()) == Counter(lettered)
    kept = {i for i, _, least in brute([r[:2] for r in lettered]) if i == least}
    assert {r.doc_id for r in single.collect()} == kept and single.count() == len(kept)
    texts = {r[0]: r[1] for r in rows}
    after = {r.doc_id: r for r in clean.collect()}
    assert set(after) == kept
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(texts[i]):
            assert r.text == texts[i]
    order = mixed.selectExpr("doc_id", "_metadata.file_name f", "_metadata.row_index i").collect()
    want = mixing.mix(clean, MIX_WEIGHTS, MIX_BLOCK).orderBy("position").collect()
    assert [r.doc_id for r in sorted(order, key=lambda r: (r.f, r.i))] == [r.doc_id for r in want]
    check(packed.collect(), [(i, r.text) for i, r in after.items()], 1024)


def test_rows_that_repeat_or_lack_an_id(spark, tmp_path):
    rows = [(1, "pa lo mi tu re sa", "xx", "a", 1)] * 3 + [(None, "pa lo mi tu re sa", "xx", None, 1), (1, "other words here", "xx", None, 2)]
    named, single, clean, mixed, packed = through(spark, tmp_path, rows)
    assert named.count() == 5
    assert sorted(r.text for r in single.collect()) == ["other words here", "pa lo mi tu re sa"] == sorted(r.text for r in mixed.collect())
    check(packed.collect(), [(r.doc_id, r.text) for r in clean.collect()], 1024)


def test_empty(spark, tmp_path):
    assert [d.count() for d in through(spark, tmp_path, [])] == [0] * 5


@pytest.mark.parametrize("name", ["pipeline"])
def test_registered(name):
    from __spark_entry__ import queries

    assert queries()[name] is pipeline.run
