from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadmill.operators import progress, slices, stats, timeline, versions
from threadmill.operators.normalize import storage_rows
from threadmill.session import prepare
from threadmill.sources import buckets

T0, T1 = (datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2))


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def posts(spark, stamp, *rows):
    df = spark.createDataFrame(list(rows), "id string, score bigint, title string").withColumn("subreddit", F.lit("python"))
    return storage_rows(df, stamp)


MERGES = [versions.merge_upsert, versions.merge_small_batch]


@pytest.mark.parametrize("merge", MERGES)
def test_upsert_refreshes_and_keeps_first_seen(spark, merge):
    old = posts(spark, T0, ("p1", 5, "T"), ("p2", 1, "U"))
    new = posts(spark, T1, ("p1", 42, None), ("p3", 7, "V"))
    rows = {r.id: r for r in merge(old, new).collect()}
    assert {i: (r.score, r.title) for i, r in rows.items()} == {"p1": (42, None), "p2": (1, "U"), "p3": (7, "V")}
    assert {i: r.fetched_at.day for i, r in rows.items()} == {"p1": 1, "p2": 1, "p3": 2}
    assert {i: r.updated_at.day for i, r in rows.items()} == {"p1": 2, "p2": 1, "p3": 2}


@pytest.mark.parametrize("merge", MERGES)
def test_upsert_twice_is_upsert_once(spark, merge):
    old, new = posts(spark, T0, ("p1", 5, "T")), posts(spark, T1, ("p1", 6, "X"), ("p2", 1, "U"))
    once = merge(old, new)
    assert sorted(map(str, merge(once, new).collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize("merge", MERGES)
def test_upsert_keeps_flags(spark, merge):
    flagged = posts(spark, T0, ("p1", 5, "T"), ("p2", 1, "U")).withColumns(
        {"flagged": F.when(F.col("id") == "p1", True), "matched_terms": F.when(F.col("id") == "p1", F.array(F.lit("x")))}
    )
    rows = {r.id: r for r in merge(flagged, posts(spark, T1, ("p1", 9, "T"), ("p2", 2, "U"))).collect()}
    assert (rows["p1"].flagged, rows["p1"].matched_terms, rows["p1"].score) == (True, ["x"], 9)
    assert rows["p2"].flagged is None


def test_folding_all_versions_equals_merging_one_by_one(spark):
    batches = [posts(spark, T0, ("a", 1, "x"), ("b", 1, None)), posts(spark, T1, ("a", 2, None)),
               posts(spark, datetime(2024, 1, 3, tzinfo=timezone.utc), ("a", 3, "z"), ("c", 1, "c"))]
    merged = batches[0]
    for b in batches[1:]:
        merged = versions.merge_upsert(merged, b)
    every = batches[0].unionByName(batches[1]).unionByName(batches[2])
    folded = versions.fold_versions(every, [F.col("updated_at")])
    assert sorted(map(str, folded.collect())) == sorted(map(str, merged.select(*folded.columns).collect()))


def test_latest_by_arrival(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 5, "y")], "id string, n int, v string")
    assert sorted(map(tuple, versions.latest(df, ["id"], [F.col("n")]).collect())) == [("a", 2, None), ("b", 5, "y")]


def test_refresh_only_known(spark):
    old = posts(spark, T0, ("p1", 5, "T"))
    fresh = posts(spark, T1, ("p1", 8, "other"), ("p9", 1, "new"))
    assert [(r.id, r.score, r.title) for r in versions.refresh_existing(old, fresh, ["score"]).collect()] == [("p1", 8, "T")]


def test_subreddit_rows(spark):
    old = versions.subreddit_rows(spark.createDataFrame([("Py", "{}")], "name string, raw string"), T0)
    new = versions.subreddit_rows(spark.createDataFrame([(" py",), ("Go",)], "name string"), T1)
    rows = {r.name: (r.first_seen_at.day, r.raw, r.updated_at.day) for r in versions.upsert_subreddits(old, new).collect()}
    assert rows == {"py": (1, "{}", 2), "go": (2, None, 2)}


def test_first_page_limit_reaches_the_map_side(spark):
    df = spark.range(9000).selectExpr("cast(id as string) id", "concat('s', id % 2) subreddit", "id created_epoch")
    top = slices.first_pages(df, 2, 3)
    assert sorted(r.created_epoch for r in top.collect()) == list(range(12))
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2
    many = slices.first_pages(df, 2, 1000)
    assert sorted(r.created_epoch for r in many.collect()) == list(range(4000))


# --- timeline and statistics ---------------------------------------------------------------


def test_comment_before_later_post(spark):
    p = spark.createDataFrame([("p1", 200), ("x", None)], "id string, created_epoch bigint")
    c = spark.createDataFrame([("c1", 100), ("p1", 200)], "id string, created_epoch bigint")
    rows = timeline.timeline(p, c).collect()
    assert [(r.type, r.id) for r in rows] == [("post", "x"), ("comment", "c1"), ("post", "p1"), ("comment", "p1")]
    assert "raw" not in rows[0].asDict()
    counts = timeline.count_by_type(timeline.timeline_rows(p, c).withColumn("type", F.when(F.col("id") == "x", "other").otherwise(F.col("type"))))
    assert tuple(counts.first()) == (1, 2)


def test_target_stats(spark):
    records = spark.createDataFrame(
        [("Harbour", "2024-01-02T00:00:00+05:00", 5), ("r/harbour", None, 1700000000), ("Other", None, None), ("", "x", None)],
        "subreddit string, created_utc string, created_epoch bigint",
    )
    targets = spark.createDataFrame([("harbour",), ("delta",)], "target string")
    rows = {r.target: (r.records, r.oldest_post_date) for r in stats.target_stats(records, targets).collect()}
    assert rows == {"harbour": (2, "2023-11-14T22:13:20"), "delta": (0, None), "Other": (1, None), "unknown": (1, None)}


def test_of_two_equal_targets_the_last_takes_the_records(spark):
    records = spark.createDataFrame([("a", None, 0)], "subreddit string, created_utc string, created_epoch bigint")
    targets = spark.createDataFrame([("r/a", 0), ("A", 1)], "target string, position int")
    rows = {r.target: r.records for r in stats.target_stats(records, targets).collect()}
    assert rows == {"r/a": 0, "A": 1}


def test_result_payloads_stay_one_per_record(spark):
    records = spark.createDataFrame([("j", "a", None), ("j", "b", 5)], "job_id string, id string, score bigint")
    rows = [json.loads(r.payload) for r in stats.result_payload(records, "box", F.lit("r/x")).collect()]
    assert [r["result"]["post_details"] for r in rows] == [[{"id": "a", "score": None}], [{"id": "b", "score": 5}]]
    assert rows[0]["source_id"] == "box" and rows[0]["result"]["source"] == "r/x"


# --- progress --------------------------------------------------------------------------------


def progress_row(spark, **over):
    row = {"subreddit": "python", "backend": "b", "kind": "posts", "window_start_epoch": 1, "window_end_epoch": 100,
           "cursor_epoch": 50, "status": "in_progress", "items_fetched": 7, **over}
    return spark.createDataFrame([tuple(row.values())], "subreddit string, backend string, kind string, window_start_epoch bigint, "
                                 "window_end_epoch bigint, cursor_epoch bigint, status string, items_fetched bigint")


def test_progress_round_trip(spark):
    old, new = progress_row(spark), progress_row(spark, cursor_epoch=99, items_fetched=9)
    assert [r.items_fetched for r in progress.merge_progress(old, new).collect()] == [9]
    assert progress.merge_progress(old, progress_row(spark, window_end_epoch=200)).count() == 2


@pytest.mark.parametrize(
    "over,left", [({}, [50, 99]), ({"status": "complete"}, []), ({"cursor_epoch": 0}, [1, 2, 50, 99]),
                  ({"window_end_epoch": 77, "status": "complete"}, [1, 2, 50, 99])],
)
def test_resume(spark, over, left):
    records = spark.createDataFrame([("python", "posts", e) for e in (0, 1, 2, 50, 99, 100)], "subreddit string, kind string, created_epoch bigint")
    rows = progress.remaining(records, progress_row(spark, **over), "b", 1, 100)
    assert sorted(r.created_epoch for r in rows.collect()) == left


def test_fraction(spark):
    view = progress.progress_view(progress_row(spark, window_start_epoch=0, cursor_epoch=25), 10.0).first()
    assert (view.fraction, view.eta_seconds, view.reached) == (0.25, 30.0, "1970-01-01 00:00")


def test_fallback_serves_whole_slices(spark):
    def source(name, *days):
        return spark.createDataFrame([(name, d) for d in days], "src string, day int")

    rows = progress.serve_with_fallback([source("a", 1, 1), source("b", 1, 2), source("c", 2, 3)], [F.col("day")])
    assert sorted(map(tuple, rows.collect())) == [("a", 1), ("a", 1), ("b", 2), ("c", 3)]


def test_page_cursor_is_the_last_usable_time_by_position(spark):
    pages = spark.createDataFrame(
        [(1, '{"data":[{"id":"a","created_utc":200},{"id":"b","created_utc":"100.9"},{"id":"c","created_utc":"x"}]}'),
         (2, '{"data":[]}'), (3, "oops")], "n int, payload string")
    rows = [tuple(r) for r in progress.page_cursors(pages, "payload", ["n"]).orderBy("n").collect()]
    assert rows == [(1, 3, 100, False, False), (2, 0, None, True, False), (3, None, None, False, True)]


def test_upsert_leaves_the_bucketed_table_in_place(spark, tmp_path):
    schema = "id string, subreddit string, score bigint, fetched_at bigint, updated_at bigint"
    old = spark.createDataFrame([(f"u{i}", f"s{i % 3}", i, 1, 1) for i in range(500)], schema)
    new = spark.createDataFrame([(f"u{i}", f"s{i % 3}", -i, 2, 2) for i in range(400, 700)], schema)
    path = str(tmp_path / "v1")
    buckets.write_buckets(old, path, 8)
    for _ in range(2):  # known to the session, and told anew
        base = buckets.read_buckets(spark, path, schema, 8)
        merged = buckets.upsert(base, new, 8)
        assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, versions.merge_upsert(old, new).collect()))
        plan = buckets.upsert(base, new, 8)._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("Bucketed: true")
        assert plan.count("Exchange") == 1 and "Exchange" not in plan[:scan]
        buckets.forget(spark, path)
    assert buckets.read_buckets(spark, path, schema, 8).count() == 500
