from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from threadmill.operators import flagging, slices
from threadmill.operators.normalize import normalize_posts, storage_rows
from threadmill.plans import runs
from threadmill.schemas import COMMENT, POST
from threadmill.session import prepare, written_tables
from threadmill.sources import archive, raw, sinks


@pytest.fixture(autouse=True)
def _ready(spark):
    prepare(spark)


def write_map(folder, name, data, indent=2):
    folder.mkdir(parents=True, exist_ok=True)
    text = data if isinstance(data, str) else json.dumps(data, ensure_ascii=False, indent=indent)
    (folder / name).write_text(text, encoding="utf-8")


def post(i, **over):
    return {"id": f"p{i}", "subreddit": "s", "title": 'tricky "\n  },\n é', "created_epoch": i, "is_deleted": False,
            "raw": {"k": {"deep": [{"a": 1}, {}]}, "n": None}, "fetched_at": "2024-01-01T00:00:00.5+00:00", **over}


def comment(i, **over):
    return {"id": f"c{i}", "post_id": "p1", "parent_id": "t3_p1", "subreddit": "s", "body": "b", "depth": 0,
            "created_epoch": 100 - i, "flagged": True, "matched_terms": ["x", "y"], **over}


def test_large_map_is_read_in_splits(spark, tmp_path):
    write_map(tmp_path / "s", "posts.json", {f"p{i}": post(i) for i in range(3000)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        pieces = archive._pieces(spark, str(tmp_path), "posts.json")
        assert pieces.rdd.getNumPartitions() > 4
        scan = archive.scan_maps(spark, str(tmp_path), "posts.json")
        rows = archive.stored_posts(scan.records, ["key"])
        assert rows.count() == 3000 and rows.filter(F.concat(F.lit("p"), "created_epoch") != F.col("id")).count() == 0
        one = rows.filter("id = 'p7'").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert one.title == post(7)["title"] and json.loads(one.raw) == post(7)["raw"]
    assert one.fetched_at.microsecond == 500000 and one.flagged is None and scan.broken.count() == 0


@pytest.mark.parametrize("indent", [2, None, 4, 0])
def test_every_layout_reads_the_same(spark, tmp_path, indent):
    data = {"p1": post(1), "odd": 5, "none": None, "p2": post(2)}
    write_map(tmp_path / "s", "posts.json", data, indent)
    scan = archive.scan_maps(spark, str(tmp_path), "posts.json")
    assert sorted(r.key for r in scan.records.collect()) == ["p1", "p2"] and scan.broken.count() == 0


BROKEN = {
    "cut": json.dumps({f"p{i}": post(i) for i in range(3)}, indent=2)[:-40],
    "cut_at_record": json.dumps({f"p{i}": post(i) for i in range(3)}, indent=2).split("\n  },\n")[0] + "\n  },\n",
    "list": "[1, 2]", "text": "no json", "number": "5",
}


@pytest.mark.parametrize("case", BROKEN)
def test_broken_files_count_as_empty(spark, tmp_path, case):
    write_map(tmp_path / "bad", "posts.json", BROKEN[case])
    write_map(tmp_path / "bad", "comments.json", {"c1": comment(1)})
    write_map(tmp_path / "good", "posts.json", {"p1": post(1)})
    got = archive.read_archive(spark, str(tmp_path))
    assert got.posts.count() == 1 and got.comments.count() == 1
    assert [r.folder.rsplit("/", 1)[1] for r in got.failed.collect()] == ["bad"]
    strict = archive.read_archive(spark, str(tmp_path), whole_folders=True)
    assert strict.posts.count() == 1 and strict.comments.count() == 0


def test_empty_maps_and_files(spark, tmp_path):
    write_map(tmp_path / "a", "posts.json", "{}")
    write_map(tmp_path / "b", "posts.json", "")
    got = archive.read_archive(spark, str(tmp_path))
    assert got.posts.count() == 0 and got.failed.count() == 0


def test_discovery(spark, tmp_path):
    write_map(tmp_path / "job" / "one", "posts.json", {})
    write_map(tmp_path / "two", "comments.json", {})
    write_map(tmp_path / "two", "subreddit.json", {})
    found = archive.discover(spark, str(tmp_path))
    assert sorted((r.folder.rsplit("/", 1)[1], r.name) for r in found.collect()) == [("one", "posts.json"), ("two", "comments.json")]
    write_map(tmp_path, "posts.json", {})
    assert [r.name for r in archive.discover(spark, str(tmp_path)).collect()] == ["posts.json"]


def test_one_level_only(spark, tmp_path):
    write_map(tmp_path / "one", "posts.json", {"p1": post(1)})
    write_map(tmp_path / "job" / "two", "posts.json", {"p2": post(2)})
    write_map(tmp_path / "job" / "bad", "posts.json", "{")
    got = archive.read_archive(spark, str(tmp_path), one_level=True)
    assert [r.id for r in got.posts.collect()] == ["p1"] and got.failed.count() == 0


def test_merge_run(spark, tmp_path):
    write_map(tmp_path / "in" / "s", "posts.json", {f"p{i}": post(i) for i in range(5)})
    write_map(tmp_path / "in" / "s", "comments.json", {f"c{i}": comment(i) for i in range(98, 101)})
    write_map(tmp_path / "in" / "t", "posts.json", "{")
    counts, failed = runs.merge_run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [(r.post, r.comment, r.records) for r in counts.collect()] == [(5, 3, 8)] and failed.count() == 1
    lines = [json.loads(line) for f in sorted((tmp_path / "out" / "_part=s").glob("part*")) for line in f.read_text().splitlines()]
    assert [r["id"] for r in lines] == ["c100", "p0", "c99", "p1", "c98", "p2", "p3", "p4"]
    assert lines[0]["matched_terms"] == ["x", "y"] and lines[1]["depth"] is None and "raw" not in lines[1]


def test_merge_keeps_folders_of_one_name_apart(spark, tmp_path):
    write_map(tmp_path / "in" / "j1" / "s", "posts.json", {"p1": post(1)})
    write_map(tmp_path / "in" / "j2" / "s", "posts.json", {"p2": post(2), "p3": post(3)})
    counts, _ = runs.merge_run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted((r.folder, r.post) for r in counts.collect()) == [("j1/s", 1), ("j2/s", 2)]
    back = spark.read.json(str(tmp_path / "out"))
    assert "folder" not in back.columns and sorted((r._part, r.id) for r in back.collect()) == [("j1/s", "p1"), ("j2/s", "p2"), ("j2/s", "p3")]
    write_map(tmp_path / "in", "posts.json", {"top": post(9)})
    counts, _ = runs.merge_run(spark, str(tmp_path / "in"), str(tmp_path / "out2"))
    assert [(r.folder, r.post) for r in counts.collect()] == [(".", 1)]


# --- other sources and sinks -----------------------------------------------------------------


def test_lines_pages_and_job_lists(spark, tmp_path):
    (tmp_path / "lines.jsonl").write_text('{"id": "a"}\n\n  \n{"id": "b"}\nbroken\n[1]\n')
    lines = raw.read_lines(spark, str(tmp_path / "lines.jsonl"))
    assert lines.count() == 4 and [r.raw for r in raw.unreadable(lines).collect()] == ["broken", "[1]"]
    assert sorted(r.id for r in normalize_posts(lines, raw="raw").collect()) == ["a", "b"]
    (tmp_path / "pages.jsonl").write_text('{"data": [{"id": "a"}, {"id": "b"}]}\n[{"id": "c"}]\n{"data": 5}\n{\n')
    assert [json.loads(r.raw)["id"] for r in raw.read_pages(spark, str(tmp_path / "pages.jsonl")).collect()] == ["a", "b", "c"]
    (tmp_path / "jobs.json").write_text('[\n{"target": "aa"}\n]')
    assert raw.read_job_lists(spark, str(tmp_path / "jobs.json")).count() == 1


def post_rows(spark, *ids, subreddit="s"):
    df = spark.createDataFrame([(i, subreddit, n) for n, i in enumerate(ids)], "id string, subreddit string, created_epoch bigint")
    return storage_rows(df, datetime(2024, 1, 1, tzinfo=timezone.utc))


def test_archive_write_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "posts")
    sinks.write_archive(post_rows(spark, "a", "b", subreddit="One"), path)
    sinks.write_archive(post_rows(spark, "c", subreddit="two"), path)
    sinks.write_archive(post_rows(spark, "d", subreddit="one"), path)
    assert sorted((r.folder, r.id) for r in spark.read.parquet(path).collect()) == [("one", "d"), ("two", "c")]


def test_search_reads_only_folders_and_times_it_needs(spark, tmp_path):
    path = str(tmp_path / "posts")
    rows = post_rows(spark, "a", "b", "c", subreddit="one-1").unionByName(post_rows(spark, "d", subreddit="two"))
    sinks.write_archive(rows, path)
    found = slices.search(spark.read.parquet(path), ["ONE-1"], 1, 3).select("id")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan and "IsNotNull(created_epoch)" in plan
    assert "ReadSchema: struct<id:string,subreddit:string,created_epoch:bigint>" in plan
    assert sorted(r.id for r in found.collect()) == ["b", "c"]


def test_append_and_compact_lines(spark, tmp_path):
    lines, out, nested = (str(tmp_path / n) for n in ("lines", "out", "nested"))
    schema = COMMENT
    for n, score in ((0, 1), (1, 2)):
        df = spark.createDataFrame(
            [("a", "t3_p", score), ("b", "t1_a", score + 10)], "id string, parent_id string, score bigint"
        ).withColumns({"subreddit": F.lit("s"), "created_epoch": F.col("score"), "post_id": F.lit("p")})
        sinks.append_lines(storage_rows(df, datetime(2024, 1, 1 + n, tzinfo=timezone.utc)), lines)
    assert spark.read.text(lines).count() == 4
    sinks.compact_lines(spark, lines, schema, [F.col("updated_at")], out, nested)
    rows = spark.read.schema(schema).json(out).orderBy("id").collect()
    assert [(r.id, r.score, r.depth) for r in rows] == [("a", 2, 0), ("b", 12, 1)]
    text = "".join(r.value for r in spark.read.text(nested).coalesce(1).collect())
    assert json.loads(text)["replies"][0]["id"] == "b"


def test_report_has_headers_even_when_empty(spark, tmp_path):
    posts = spark.createDataFrame([], POST)
    comments = spark.createDataFrame([], COMMENT)
    sinks.write_report(flagging.flagged_posts(posts), flagging.flagged_comments(comments, posts), str(tmp_path / "r"))
    head = spark.read.text(str(tmp_path / "r" / "flagged_comments")).first()[0]
    assert head == "id,post_id,subreddit,author,body,score,depth,created_utc,matched_terms,post_title"


LAYOUTS = {
    "compact": lambda d: json.dumps(d, ensure_ascii=False, separators=(",", ":")),
    "plain": lambda d: json.dumps(d),
    "indent 0": lambda d: json.dumps(d, indent=0),
    "indent 4": lambda d: json.dumps(d, indent=4, ensure_ascii=False),
    "tabs": lambda d: json.dumps(d, indent="\t"),
    "line end": lambda d: json.dumps(d) + " \n\n",
    "blanks": lambda d: "\n " + json.dumps(d, separators=(" , ", " : "), indent=3) + "\t",
}
TRICKY = {"title": 'a "quote", {brace} } ] \\ and \\" é }', "nested": {"a": [{"b": "}"}, []], "c": {}}, "empty": ""}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_any_layout_in_many_blocks(spark, tmp_path, layout):
    data = {"first": 1, **{f"p{i}": post(i, **TRICKY) for i in range(400)}, "odd": [{"x": 1}, "}"], "none": None, "last": "}"}
    write_map(tmp_path / "s", "posts.json", LAYOUTS[layout](data))
    write_map(tmp_path / "t", "posts.json", {"p1": post(1)})
    write_map(tmp_path / "e", "posts.json", "{ }" if layout != "line end" else "{}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        scan = archive.scan_maps(spark, str(tmp_path), "posts.json")
        rows = archive.stored_posts(scan.records, ["folder", "key"]).collect()
        assert scan.broken.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = {r.key: (r.title, json.loads(r.raw)) for r in rows if r.folder.endswith("/s")}
    assert got == {f"p{i}": (TRICKY["title"], post(i)["raw"]) for i in range(400)} and len(rows) == 401


@pytest.mark.parametrize("text", [
    '{"a": {"b": 1}', '{"a": {"b": 1}}}', '{"a": {"b": 1}} x', '{"a": {"b": 1}}{"c": {}}', '{"a": {"b": 1} "c": {}}', '{"a": {"b": "}}',
    '[{"a": {}}]', '{"a": {"b": 1},}', ', "a": {"b": 1}}', '{"a": [{"b": 1]}}', "}", "{", '"}"', '{"a": {"b": \\"}}',
])
def test_files_that_are_no_map_in_any_layout(spark, tmp_path, text):
    write_map(tmp_path / "bad", "posts.json", text)
    write_map(tmp_path / "good", "posts.json", json.dumps({"p1": post(1)}))
    scan = archive.scan_maps(spark, str(tmp_path), "posts.json")
    assert [r.key for r in scan.records.collect()] == ["p1"]
    assert [r.folder.rsplit("/", 1)[1] for r in scan.broken.collect()] == ["bad"]


def test_large_compact_map_has_many_tasks(spark, tmp_path):
    """One line of some 30 MB; no task reads more than its block."""
    body = "word { [ " * 100
    data = {f"p{i}": {"id": f"p{i}", "subreddit": "s", "title": body, "created_epoch": i} for i in range(30_000)}
    write_map(tmp_path / "s", "posts.json", json.dumps(data))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000000")
    try:
        rows = archive.stored_posts(archive.scan_maps(spark, str(tmp_path), "posts.json").records)
        seen = rows.agg(F.count("*").alias("n"), F.sum("created_epoch").alias("s"), F.min(F.length("title")).alias("t")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tuple(seen) == (30_000, sum(range(30_000)), len(body))


def test_keywords_of_a_table_are_those_of_a_list(spark):
    rng = random.Random(3)
    letters = "abé \nİ😀."
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(80)] + ["", None, "ABÉ aBé"]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["ABÉ", "  ", "", "not there", "😀", "a"]
    rows = spark.createDataFrame([(f"c{i}", "s", t) for i, t in enumerate(texts)], "id string, subreddit string, body string")
    table = spark.createDataFrame([(w,) for w in [*words, None]], "word string")
    one = flagging.find_terms(rows, words).select("id", "terms").collect()
    other = flagging.find_terms_of(rows, table, "word").select("id", "terms").collect()
    assert {r.id: r.terms for r in other} == {r.id: r.terms for r in one} and len(other) == len(rows.collect())
    none = flagging.find_terms_of(rows, table.filter("word = ''"), "word").collect()
    assert all(r.terms == [] for r in none) and len(none) == len(texts)
    hits = flagging.annotate_hits_of(rows, table, "word")
    assert hits.count() == sum(bool(r.terms) for r in one) and hits.filter("flagged AND flag_reason IS NOT NULL").count() == hits.count()


def test_keywords_are_dealt_out_as_numbers(spark, monkeypatch):
    """Lists of texts were most of what was shuffled and written."""
    rows = spark.createDataFrame([("s", f"r{i}", f"alpha beta{i} the gamma delta" if i % 2 else "none here") for i in range(40)], "subreddit string, id string, body string")
    table = spark.createDataFrame([("Alpha",), ("eta",), ("mm",), ("the gamma",), ("zzz",), (" ",)], "word string")

    def found(words):
        got = {r.id: list(r.terms) for r in flagging.find_terms_of(rows, words, "word").select("id", "terms").collect()}
        path = [p for p in written_tables() if p.endswith("/listed")][-1]
        return got, spark.read.parquet(path).schema["sure"].dataType.simpleString()

    want = {f"r{i}": ["alpha", "eta", "mm", "the gamma"] if i % 2 else [] for i in range(40)}
    assert found(table) == (want, "array<int>")
    no_blanks = {k: [t for t in v if " " not in t] for k, v in want.items()}
    assert found(table.filter("word <> 'the gamma'")) == (no_blanks, "array<int>")
    monkeypatch.setattr(flagging, "NUMBERED_BYTES", 0)
    assert found(table) == (want, "array<string>")
