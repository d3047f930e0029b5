from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadmill.operators import normalize
from threadmill.schemas import COMMENT, POST
from threadmill.session import prepare


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def raw(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "raw string")


def test_post(spark):
    df = normalize.normalize_posts(
        raw(spark, {"id": "t3_p1", "author": "[deleted]", "title": "T", "selftext": "x", "score": 5.7,
                    "created_utc": "1600000000.5", "subreddit": " Python ", "over_18": False}),
        raw="raw",
    )
    row = df.first()
    assert (row.id, row.author, row.is_deleted, row.score, row.created_epoch) == ("p1", None, True, 5, 1600000000)
    assert (row.subreddit, row.over_18, row.created_utc) == ("python", False, "2020-09-13T12:26:40+00:00")
    assert json.loads(row.raw)["id"] == "t3_p1"


def test_removed_text_and_fallbacks(spark):
    rows = normalize.normalize_posts(
        raw(spark, {"id": "", "name": "t3_n", "selftext": "[removed]", "author": "a", "subreddit": ""},
            {"name": None}, "no json", {"id": "q", "author": ""}),
        raw="raw", fallback=F.lit("Home"),
    ).orderBy("id").collect()
    assert [(r.id, r.subreddit, r.is_deleted) for r in rows] == [("n", "home", True), ("q", "home", True)]


def test_comment_needs_its_post(spark):
    source = raw(
        spark,
        {"id": "c1", "link_id": "t3_post", "parent_id": "t1_c0", "author": "bob", "body": "hi", "score": "1",
         "created_utc": 1},
        {"id": "c2", "parent_id": "t1_c0"},
        {"link_id": "t3_post"},
    )
    row = normalize.normalize_comments(source, raw="raw").collect()
    assert [(r.id, r.post_id, r.parent_id, r.score, r.is_deleted) for r in row] == [("c1", "post", "t1_c0", 1, False)]
    rejected = normalize.rejected(normalize.project_comments(source, raw="raw"))
    assert rejected.count() == 2


def test_columnar_dump_gives_the_same(spark):
    source = spark.createDataFrame(
        [("t3_a", "S", "u", "7", "12.9"), ("b", None, "[removed]", "7.5", "x")],
        "id string, subreddit string, author string, score string, created_utc string",
    )
    columns = [c for c in POST.fieldNames() if c not in ("raw", "fetched_at", "updated_at")][:13]
    from_columns = normalize.normalize_posts(source).select(*columns).collect()
    as_json = source.select(F.to_json(F.struct("*")).alias("raw"))
    assert normalize.normalize_posts(as_json, raw="raw").select(*columns).collect() == from_columns


def test_table_form_has_one_stamp(spark):
    stamp = datetime(2024, 1, 1, tzinfo=timezone.utc)
    df = normalize.normalize_comments(raw(spark, {"id": "a", "link_id": "p"}, {"id": "b", "link_id": "p"}), raw="raw")
    rows = normalize.storage_rows(df, stamp)
    assert rows.schema.fieldNames() == COMMENT.fieldNames()
    assert rows.select("fetched_at", "updated_at", "depth", "flagged").distinct().count() == 1


def test_records_are_parsed_once(spark):
    df = normalize.normalize_posts(raw(spark, {"id": "a"}).repartition(2), raw="raw")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_fields_are_taken_out_of_a_record_once(spark):
    raw = spark.createDataFrame([('{"id":"a","link_id":"t3_p","created_utc":"5"}',)], "raw string").repartition(1)
    rows = normalize.normalize_comments(raw, raw="raw")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.author") == plan.count("$.link_id") == plan.count("$.name") == 1
    assert [(r.id, r.post_id, r.created_epoch) for r in rows.collect()] == [("a", "p", 5)]
