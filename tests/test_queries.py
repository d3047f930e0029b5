"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from tests.oracle_check import differences, duck
from threadmill.plans.oracle import ORACLE
from threadmill.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r.comments for r in rows) == 87


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLE[name], SF_DIR) is None


def test_turns_of_any_depth_are_flattened(spark, tmp_path):
    turns = [(1, i, "user", "\n".join(f"line {k}" for k in range(n))) for i, n in enumerate((3, 300, 700, 5000))]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    d = str(tmp_path)
    assert differences(spark, duck(d), QUERIES["flatten_tree"], ORACLE["flatten_tree"], d) is None
    assert QUERIES["flatten_tree"](spark, d).count() == 6003
