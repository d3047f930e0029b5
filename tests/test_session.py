from __future__ import annotations

import os

from threadmill.session import collect_garbage, discard, materialize, written_tables


def test_tables_go_when_nothing_reads_them(spark):
    before = len(written_tables())
    one = materialize(spark.range(3).toDF("a"), "one")
    two = materialize(spark.range(4).toDF("a"), "two")
    places = written_tables()[before:]
    assert len(places) == 2
    discard(places, unless_read_by=two)
    assert two.count() == 4
    assert [os.path.exists(p.removeprefix("file:")) for p in places] == [False, True]
    discard([], unless_read_by=one.limit(0))
    collect_garbage(spark)
    assert two.count() == 4
