"""The source over provider pages."""

from __future__ import annotations

import json

import pytest

from threadmill.session import prepare
from threadmill.sources import pages, store
from threadmill.streaming.ingest import start_ingest


@pytest.fixture(autouse=True)
def _ready(spark):
    pages.register(prepare(spark))


def page(walk, cursor, records, bare=False):
    return (*walk, cursor, json.dumps(records if bare else {"data": records}))


def put(spark, root, *rows):
    spark.createDataFrame(list(rows), pages.PAGE_SCHEMA).write.format(pages.FORMAT).mode("append").save(root)


def rc(i, at, body="x"):
    return {"id": i, "link_id": "t3_p", "body": body, "created_utc": at, "subreddit": "s"}


S, T = ("s", "comments"), ("t", "posts")


def test_windows_and_walks_choose_pages(spark, tmp_path):
    root = str(tmp_path / "pages")
    put(spark, root, page(S, 10, [rc("a", 5), rc("b", 10)]), page(S, 20, [rc("c", 10), rc("d", "19.5"), rc("e", 20)], bare=True),
        page(S, 30, [rc("f", "soon"), rc("g", 30)]), page(T, 7, [{"id": "h"}]), page(T, 8, []), page(T, 9, {"id": "no list"}))
    rows = spark.read.format(pages.FORMAT).load(root)
    assert sorted(json.loads(r.raw)["id"] for r in rows.collect()) == list("abcdefgh")
    got = rows.filter("subreddit = 's' AND created_epoch >= 10 AND created_epoch < 20")
    assert sorted(json.loads(r.raw)["id"] for r in got.collect()) == ["b", "c", "d"]
    assert rows.filter("kind IN ('posts') AND subreddit IN ('s', 't')").count() == 1
    assert rows.filter("created_epoch > 30").count() == 0 and rows.filter("subreddit = 'x'").count() == 0

    def opened(*filters):
        reader = pages.PageReader(root)
        list(reader.pushFilters(list(filters)))
        return [c for p in reader.partitions() for c, _ in p.pages]

    time, sub = ("created_epoch",), ("subreddit",)
    assert opened(pages.EqualTo(sub, "s"), pages.GreaterThan(time, 10), pages.LessThanOrEqual(time, 20)) == [20, 30]
    assert opened(pages.EqualTo(sub, "s"), pages.LessThan(time, 10)) == [10]
    assert opened(pages.In(sub, ("t",)), pages.EqualTo(("kind",), "comments")) == []


def test_stream_goes_on_from_its_cursors(spark, tmp_path):
    landing, root = str(tmp_path / "pages"), str(tmp_path / "archive")
    store.create_archive(spark, root)

    def run():
        query = start_ingest(spark, landing, root, "comment", paged=True)
        query.awaitTermination()
        assert query.exception() is None
        return {r.id: r.body for r in store.current(spark, root, "comment").collect()}

    put(spark, landing, page(S, 10, [rc("a", 5), rc("b", 10, "old")]), page(T, 3, [{"id": "p", "title": "t", "created_utc": 3}]))
    assert run() == {"a": "x", "b": "old"}
    put(spark, landing, page(S, 20, [rc("b", 10, "again at the border"), rc("c", 20)]), page(("u", "comments"), 1, [rc("z", 1)]))
    assert run() == {"a": "x", "b": "again at the border", "c": "x", "z": "x"}
    assert run() == {"a": "x", "b": "again at the border", "c": "x", "z": "x"}
    batches = spark.read.parquet(f"{root}/versions").filter("writer = 'stream'").groupBy("batch").count().collect()
    assert sorted(r["count"] for r in batches) == [2, 3]


def test_long_walks_are_parted_and_nothing_is_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pages, "PAGES_PER_TASK", 2)
    parts = pages._parted({S: [(i, f"{i}.json") for i in range(5)], T: []})
    assert [[c for c, _ in p.pages] for p in parts] == [[0, 1], [2, 3], [4]]
    assert spark.read.format(pages.FORMAT).load(str(tmp_path / "none")).count() == 0


def test_large_pages_are_parted_by_their_bytes(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "pages")
    put(spark, root, *[page(S, 10 * i, [rc(f"{i}{k}", 10 * i, "x" * 100) for k in range(5)]) for i in range(1, 5)])
    monkeypatch.setattr(pages, "BYTES_PER_TASK", 2000)
    assert [[c for c, _ in p.pages] for p in pages.PageReader(root).partitions()] == [[10, 20], [30, 40]]
    upto = pages.PageStreamReader(root).latestOffset()
    parts = pages.PageStreamReader(root).partitions({"walks": "{}"}, upto)
    assert [[c for c, _ in p.pages] for p in parts] == [[10, 20], [30, 40]]
    monkeypatch.setattr(pages, "BYTES_PER_TASK", 10)
    assert len(pages.PageReader(root).partitions()) == 4
    monkeypatch.setattr(pages, "BATCH_ROWS", 2)
    rows = [b.to_pylist() for p in parts for b in pages.PageStreamReader(root).read(p)]
    assert max(map(len, rows)) == 2 and sum(map(len, rows)) == 20
    assert spark.read.format(pages.FORMAT).load(root).filter("created_epoch = 30").count() == 5
