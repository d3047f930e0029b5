from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadmill.operators import ledger
from threadmill.operators import progress as P
from threadmill.operators.normalize import normalize_comments
from threadmill.operators.threads import with_depth
from threadmill.operators.versions import latest
from threadmill.plans import runs
from threadmill.session import prepare, written_tables
from threadmill.sources import store
from threadmill.sources.raw import job_list
from threadmill.streaming.ingest import start_ingest

DAY1, DAY2, DAY3 = (datetime(2024, 1, d, tzinfo=timezone.utc) for d in (1, 2, 3))


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def raw(spark, *records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "raw string")


def rc(i, parent="t3_p", body="x", at=10, sub="s"):
    return {"id": i, "link_id": "t3_p", "parent_id": parent, "body": body, "created_utc": at, "subreddit": sub, "author": "a"}


def rp(i, title="t", at=10, sub="s"):
    return {"id": i, "title": title, "created_utc": at, "subreddit": sub, "author": "a"}


def archive(spark, tmp_path, name):
    root = str(tmp_path / name)
    store.create_archive(spark, root)
    return root


def land(tmp_path, n, *records):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    (folder / f"f{n}.jsonl").write_text("\n".join(json.dumps(r) for r in records) + "\n")
    return str(folder)


def stream(spark, landing, root, **kw):
    query = start_ingest(spark, landing, root, "comment", max_files=1, **kw)
    query.awaitTermination()
    assert query.exception() is None


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    root = archive(spark, tmp_path, "c")
    first = [rc("b", "t1_a", at=2), rc("c", "t1_b", at=3), rc("dup", body="old"), rc("dup", body="new")]
    landing = land(tmp_path, 0, *first)
    stream(spark, landing, root)
    rows = {r.id: r for r in store.current(spark, root, "comment").collect()}
    # The parent is still missing, so b is a root.
    assert {i: r.depth for i, r in rows.items()} == {"b": 0, "c": 1, "dup": 0} and rows["dup"].body == "new"
    seen_first = rows["b"].fetched_at

    second = [rc("a", at=1), rc("b", "t1_a", body="edited", at=2)]
    land(tmp_path, 1, *second)
    stream(spark, landing, root)
    got = store.current(spark, root, "comment")
    rows = {r.id: r for r in got.collect()}
    assert {i: r.depth for i, r in rows.items()} == {"a": 0, "b": 1, "c": 2, "dup": 0}
    assert rows["b"].body == "edited" and rows["b"].fetched_at == seen_first <= rows["b"].updated_at

    numbered = raw(spark, *first, *second).withColumn("n", F.monotonically_increasing_id())
    batch = with_depth(latest(normalize_comments(numbered, raw="raw", keep=["n"]), ["subreddit", "id"], [F.col("n")]))
    columns = ["id", "post_id", "parent_id", "subreddit", "author", "body", "created_epoch", "depth"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, batch.select(*columns).collect()))
    done = store.progress(spark, root).first()
    assert (done.items_fetched, done.cursor_epoch, done.kind) == (6, 10, "comment")


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root = archive(spark, tmp_path, "c")
    landing = land(tmp_path, 0, rc("a"), rc("b", "t1_a"))
    stream(spark, landing, root)
    want = sorted(map(str, store.current(spark, root, "comment").collect()))
    # The batch was written, but its commit got lost: the next start runs it again.
    commit = tmp_path / "c" / "stream" / "commits" / "0"
    commit.unlink()
    (tmp_path / "c" / "stream" / "commits" / ".0.crc").unlink(missing_ok=True)
    stream(spark, landing, root)
    assert sorted(map(str, store.current(spark, root, "comment").collect())) == want


def test_compaction_changes_nothing_and_later_batches_count(spark, tmp_path):
    root = archive(spark, tmp_path, "c")
    landing = land(tmp_path, 0, rc("a"), rc("b", "t1_a"))
    stream(spark, landing, root)
    before = sorted(map(str, store.current(spark, root, "comment").collect()))
    assert store.compact(spark, root, "comment") == 1
    assert sorted(map(str, store.current(spark, root, "comment").collect())) == before
    assert store.stored_versions(spark, root, "comment").count() == 2
    land(tmp_path, 1, rc("b", "t1_a", body="later"))
    stream(spark, landing, root)
    rows = {r.id: r.body for r in store.current(spark, root, "comment").collect()}
    assert rows == {"a": "x", "b": "later"} and store.compact(spark, root, "comment") == 2
    assert {r.id: r.body for r in store.current(spark, root, "comment").collect()} == rows


def test_stream_keeps_only_matching_records(spark, tmp_path):
    root = archive(spark, tmp_path, "c")
    landing = land(tmp_path, 0, rc("a", body="a leaf here"), rc("b", body="leaflet"), {"id": "no link"})
    stream(spark, landing, root, clauses={"all_words": ["leaf"]})
    assert [r.id for r in store.current(spark, root, "comment").collect()] == ["a"]


def test_archive_run_window_and_resume(spark, tmp_path):
    root = archive(spark, tmp_path, "p")
    source = raw(spark, rp("a", at=5), rp("b", "leaf", at=6), rp("late", at=20), rp("other", sub="z"), rp("b", "leaf new", at=6))
    done = runs.archive_run(spark, source, root, "post", ["S"], (0, 20), 0, DAY1, clauses={"any_words": ["leaf"]})
    rows = store.current(spark, root, "post").collect()
    assert [(r.id, r.title, r.fetched_at.day) for r in rows] == [("b", "leaf new", 1)]
    row = done.first()
    assert (row.subreddit, row.kind, row.items_fetched, row.status, row.cursor_epoch) == ("s", "posts", 3, "complete", 20)
    runs.archive_run(spark, source, root, "post", ["S"], (0, 20), 1, DAY2, done=done)
    assert store.current(spark, root, "post").count() == 1
    runs.archive_run(spark, source, root, "post", ["S"], (0, 21), 2, DAY2, done=done)
    rows = {r.id: (r.fetched_at.day, r.updated_at.day) for r in store.current(spark, root, "post").collect()}
    assert rows == {"a": (2, 2), "b": (1, 2), "late": (2, 2)}


def test_walks_are_kept_and_silent_ones_complete(spark, tmp_path):
    root = archive(spark, tmp_path, "p")
    assert store.current(spark, root, "post").count() == 0 and store.walks(spark, root).count() == 0
    runs.archive_run(spark, raw(spark, rp("a", at=5)), root, "post", ["s", "quiet"], (0, 20), 0, DAY1)
    kept = {r.subreddit: (r.status, r.items_fetched, r.cursor_epoch) for r in store.walks(spark, root).collect()}
    assert kept == {"s": ("complete", 1, 20), "quiet": ("complete", 0, 20)}
    runs.archive_run(spark, raw(spark, rp("b", at=6)), root, "post", ["s", "new"], (0, 20), 1, DAY2, resume=True)
    assert [r.id for r in store.current(spark, root, "post").collect()] == ["a"]
    assert {r.subreddit: r.items_fetched for r in store.walks(spark, root).collect()} == {"s": 1, "quiet": 0, "new": 0}


def test_dry_run(spark):
    now = 10 * 86400
    source = raw(spark, rc("a", at=now - 50), rc("b", "t1_a", "re", at=now - 40), rc("c", at=now - 4 * 86400), rc("d", sub="z", at=now - 1))
    counts, preview = runs.dry_run(spark, source, ["s", "z"], now)
    assert tuple(counts.first()) == (2, 1)
    assert [r.line for r in preview.collect()] == ["- (a) x", "  - (a) re"]


def test_filter_run_flags_stay(spark, tmp_path):
    posts, comments = archive(spark, tmp_path, "p"), archive(spark, tmp_path, "c")
    runs.archive_run(spark, raw(spark, rp("p", "Title"), rp("q", "ransom")), posts, "post", ["s"], (0, 99), 0, DAY1)
    runs.archive_run(spark, raw(spark, rc("c1", body="RANSOM note"), rc("c2", body="calm")), comments, "comment", ["s"], (0, 99), 0, DAY1)
    assert runs.filter_run(spark, posts, comments, str(tmp_path / "r0"), [" "], [], 0, DAY2) is None
    counts = runs.filter_run(spark, posts, comments, str(tmp_path / "r1"), ["ransom", "note"], [], 1, DAY2)
    assert {r.kind: r.flagged for r in counts.collect()} == {"posts": 1, "comments": 1}
    report = spark.read.option("header", True).csv(str(tmp_path / "r1" / "flagged_comments")).first()
    assert (report.id, report.matched_terms, report.post_title, report.depth) == ("c1", "note, ransom", "Title", "0")

    # The text changes and no longer matches; the flag stays, the count does not.
    runs.archive_run(spark, raw(spark, rc("c1", body="edited")), comments, "comment", ["s"], (0, 98), 1, DAY3)
    again = runs.filter_run(spark, posts, comments, str(tmp_path / "r2"), ["note"], [r"x{9}"], 2, DAY3)
    assert {r.kind: r.flagged for r in again.collect()} == {"posts": 0, "comments": 0}
    row = store.current(spark, comments, "comment").filter("id = 'c1'").first()
    assert (row.flagged, row.matched_terms, row.body) == (True, ["note", "ransom"], "edited")
    # Running the same flag batch again is harmless.
    runs.filter_run(spark, posts, comments, str(tmp_path / "r3"), ["ransom", "note"], [], 1, DAY2)
    assert store.current(spark, posts, "post").filter("flagged").count() == 1


def test_job_run(spark, tmp_path):
    posts = spark.createDataFrame([("p1", "s1", "Atac", "", 100), ("p2", "s2", "x", "", 100)],
                                  "id string, subreddit string, title string, selftext string, created_epoch bigint")
    comments = spark.createDataFrame([("c1", "s1", "raspuns", 100)], "id string, subreddit string, body string, created_epoch bigint")
    entries = [{"scraping_arg_id": "bad", "scraping_arg": {"target": ""}},
               {"scraping_arg_id": "good", "scraping_arg": {"target": "r/S1, empty"}},
               {"scraping_arg_id": "none", "scraping_arg": {"target": "s2", "allWords": "absent"}}]
    status = runs.job_run(spark, posts, comments, job_list(spark, json.dumps(entries)), str(tmp_path), "box", now=1000)
    rows = {r.job_id: (r.status, r.posts, r.comments) for r in status.collect()}
    assert rows == {"bad": ("error", None, None), "good": ("success", 1, 1), "none": ("success", 0, 0)}
    good = status.filter("job_id = 'good'").first()
    assert good.job_key == "reddit_good_2subs_any_any_1000" and good.source_label == "r/S1, empty"
    assert (tmp_path / "results" / "_SUCCESS").exists()
    lines = (tmp_path / "results" / "_part=good").glob("part*")
    assert [json.loads(line)["id"] for f in sorted(lines) for line in f.read_text().splitlines()] == ["c1", "p1"]
    payloads = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "stats")).filter("job_id = 'good'").collect()]
    assert {p["target"]: p["records"] for p in payloads} == {"s1": 2, "empty": 0}
    assert payloads[0]["platform"] == "REDDIT" and payloads[0]["container_entity_id"] == "box"


def test_walk_progress_of_a_run_skips_it_next_time(spark):
    records = spark.createDataFrame([("s", "posts", 5)], "subreddit string, kind string, created_epoch bigint")
    summary = P.checkpoint_summary(records, "dump", 0, 10)
    assert summary.first().status == "in_progress" and P.remaining(records, summary, "dump", 0, 10).count() == 1


def test_slices_fall_back_and_open_ones_are_repeated(spark, tmp_path):
    root = archive(spark, tmp_path, "p")
    hour = 3600
    main = raw(spark, rp("a", at=10), rp("b", at=hour + 5), rp("c", at=2 * hour + 5), rp("q", at=20, sub="t"))
    mirror = raw(spark, rp("a", title="mirror", at=10), rp("b", title="mirror", at=hour + 5), rp("b2", at=hour + 6), rp("c", title="mirror", at=2 * hour + 5))
    columns = "subreddit string, kind string, backend string, from_epoch bigint, to_epoch bigint"
    broken = [("s", "posts", "main", hour + 100, hour + 200), ("s", "posts", "main", 2 * hour, 2 * hour + 1), ("s", "posts", "mirror", 2 * hour + 5, 2 * hour + 6)]
    window = (0, 3 * hour)

    def go(batch, fails, **kw):
        failures = spark.createDataFrame(fails, columns)
        done = runs.sliced_run(spark, {"main": main, "mirror": mirror}, root, "post", ["s", "T "], window, batch, DAY1, failures, slice_seconds=hour, **kw)
        return {r.subreddit: (r.backend, r.status, r.cursor_epoch, r.items_fetched) for r in done.collect()}

    def rows():
        return {r.id: r.title for r in store.current(spark, root, "post").collect()}

    for _ in range(2):  # the second time the batch is replayed
        assert go(0, broken) == {"s": ("main", "in_progress", 2 * hour, 3), "t": ("main", "complete", 3 * hour, 1)}
        assert rows() == {"a": "t", "b": "mirror", "b2": "t", "q": "t"}
    kept = {(r.subreddit, r.slice_start): (r.source, r.failed, r.records) for r in store.ledger(spark, root).collect()}
    assert kept["s", hour] == ("mirror", ["main"], 2) and kept["s", 2 * hour] == (None, ["main", "mirror"], 0) and len(kept) == 6
    own = spark.createDataFrame([("s", ["nobody", "mirror"])], "subreddit string, backends array<string>")
    assert go(1, [], backends=own)["s"] == ("main", "complete", 3 * hour, 4)
    assert rows() == {"a": "t", "b": "mirror", "b2": "t", "q": "t", "c": "mirror"}
    assert go(2, [])["s"][1] == "complete" and store.current(spark, root, "post").count() == 5


def test_slices_of_cut_windows(spark):
    walks = spark.createDataFrame([("s", 50, 250, ["x", "y"]), ("e", 7, 7, ["x"])], "subreddit string, after_epoch bigint, before_epoch bigint, backends array<string>")
    planned = ledger.slices(walks, 100)
    assert [tuple(r) for r in planned.select("slice_start", "slice_end").orderBy("slice_start").collect()] == [(50, 100), (100, 200), (200, 250)]
    fails = [("s", "x", 0, 50), ("s", "x", 249, 260), ("s", "y", 250, 300), ("s", "x", 120, 120)]
    got = ledger.assign(planned, spark.createDataFrame(fails, "subreddit string, backend string, from_epoch bigint, to_epoch bigint"), ["subreddit"], 100)
    assert {r.slice_start: (r.source, r.failed) for r in got.collect()} == {50: ("x", []), 100: ("x", []), 200: ("y", ["x"])}


def test_runs_keep_the_subreddits_they_asked_for(spark, tmp_path):
    root = archive(spark, tmp_path, "p")
    runs.archive_run(spark, raw(spark, rp("a")), root, "post", ["S ", "quiet"], (0, 100), 0, DAY2)
    runs.sliced_run(spark, {"d": raw(spark, rp("b"))}, root, "post", ["s", "new"], (0, 100), 1, DAY3, slice_seconds=50)
    runs.archive_run(spark, raw(spark, rp("a")), root, "post", ["quiet"], (0, 100), 2, DAY1)
    store.note_subreddits(spark.createDataFrame([("new", "{}")], "name string, raw string"), root, "run-post", 3, DAY1)
    kept = {r.name: (r.first_seen_at.day, r.raw, r.updated_at.day) for r in store.subreddits(spark, root).collect()}
    assert kept == {"s": (2, None, 3), "quiet": (1, None, 2), "new": (1, "{}", 3)}


def test_a_run_writes_its_records_once_and_folds_what_is_asked_for(spark, tmp_path):
    root, before = archive(spark, tmp_path, "p"), len(written_tables())
    walked = runs.archive_run(spark, raw(spark, rp("a", at=5), rp("b", "other")), root, "post", ["s", "quiet"], (0, 20), 0, DAY1)
    assert {(r.subreddit, r.status, r.items_fetched) for r in walked.collect()} == {("s", "complete", 2), ("quiet", "complete", 0)}
    assert not any(p.endswith("/taken") for p in written_tables()[before:])
    titles = store.current(spark, root, "post", columns=("title",))
    assert {"subreddit", "id", "title"} <= set(titles.columns) <= {"subreddit", "id", "title", "arrival"}
    assert {(r.id, r.title) for r in titles.collect()} == {("a", "t"), ("b", "other")}
