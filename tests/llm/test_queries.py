"""The operator queries that SQL can express, against their twins."""

from __future__ import annotations

import os

import duckdb
import pytest

from tests.llm.fixture import documents, frame
from tests.llm.test_sanitise import cued  # noqa: F401 - a fixture
from tests.oracle_check import differences, duck
from threadmill.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    assert differences(spark, duck(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) is None


def _own(spark, folder, rows):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con


def test_revealing_words_in_sql(spark, tmp_path, cued):  # noqa: F811
    rows = [r for r in cued if r[0] is not None and r[1]]
    con = _own(spark, str(tmp_path), rows)
    got = QUERIES["op8_pii"](spark, str(tmp_path))
    assert got.where("n_terms > 0").count() == 20
    assert differences(spark, con, QUERIES["op8_pii"], ORACLE["op8_pii"], str(tmp_path)) is None


def test_links_and_mix_in_sql(spark, tmp_path):
    con = _own(spark, str(tmp_path), documents(seed=9))
    for name in ("op6_jaccard", "op10_mix"):
        assert differences(spark, con, QUERIES[name], ORACLE[name], str(tmp_path)) is None
