"""One query per archive operator, each over whole given tables.

Every function takes (spark, folder of the tables) and returns a DataFrame of scalar columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions import text as T
from ..functions.text import list_cell
from ..operators import flagging, jobs, ledger, normalize, progress, slices, stats, threads, timeline, versions
from ..operators.flatten import envelope_items, flatten_replies, unreadable_documents
from ..schemas import COMMENT
from ..sources import buckets, pages, raw, sinks, store
from ..sources.archive import MapScan, records_of_map_text, scan_maps
from ..session import fresh_dir, materialize
from ..streaming.ingest import ingest_once, start_ingest
from . import fixtures as fx
from . import runs

KEYWORDS = ["The", "ation", "été", "ich", "  ", "stupid"]
REGEXES = [r"\bof\s+the\b", r"(?P<first>[aeiou])ng\b", r"[0-9]{3,}"]
WINDOW = (fx.START + 4 * fx.DAY, fx.START + 19 * fx.DAY)
ARRIVAL = ("created_epoch", "event_id")
BUCKETS = 16


# --- normalization ----------------------------------------------------------------------


def norm_posts(spark: SparkSession, d: str) -> DataFrame:
    rows = normalize.normalize_posts(fx.as_json(fx.posts_raw(spark, d, removed=True)), raw="raw")
    return rows.select(
        "id", "subreddit", "author", "title", "selftext", "url", "permalink", "score", "num_comments",
        "created_utc", "created_epoch", "is_deleted", "over_18",
    )


def norm_comments(spark: SparkSession, d: str) -> DataFrame:
    rows = normalize.normalize_comments(fx.as_json(fx.comments_raw(spark, d)), raw="raw")
    return rows.select(
        "id", "post_id", "parent_id", "subreddit", "author", "body", "score", "created_utc",
        "created_epoch", "is_deleted",
    )


def rejected_records(spark: SparkSession, d: str) -> DataFrame:
    rows = normalize.project_comments(fx.damaged_comments(spark, d), raw="raw")
    return (
        normalize.rejected(rows)
        .groupBy(
            F.when(F.col("id").isNull(), F.lit("no id")).otherwise(F.lit("no post")).alias("reason")
        )
        .agg(F.count("*").alias("records"))
    )


def deleted_share_by_subreddit(spark: SparkSession, d: str) -> DataFrame:
    rows = normalize.normalize_posts(fx.posts_raw(spark, d, removed=True))
    return rows.groupBy("subreddit").agg(
        F.count("*").alias("posts"), F.count_if("is_deleted").alias("deleted")
    )


def raw_json_props(spark: SparkSession, d: str) -> DataFrame:
    props = F.try_parse_json("props")
    return fx.table(spark, d, "events").select(
        "event_id",
        F.try_variant_get(props, "$.k", "bigint").alias("k"),
        F.try_variant_get(props, "$.missing", "string").alias("missing"),
    )


def target_names(spark: SparkSession, d: str) -> DataFrame:
    """Names as targets, as folders and with their prefix folded away."""
    source = F.concat(F.lit(" /R/"), F.upper("source"), F.lit(" "), F.col("lang"))
    return fx.table(spark, d, "documents").select(
        "doc_id",
        T.target_key(source).alias("target"),
        T.partition_name(source).alias("folder"),
    )


# --- filters ------------------------------------------------------------------------------


def _post_hits(spark: SparkSession, d: str, **clauses) -> DataFrame:
    return flagging.keep_matching(fx.posts(spark, d), **clauses).select("id")


def filter_all_any_none(spark: SparkSession, d: str) -> DataFrame:
    return _post_hits(
        spark, d, all_words=["of", "THE"], any_words=["by", "with", "été"], none_words=["und", "stupid"]
    )


def filter_none_only(spark: SparkSession, d: str) -> DataFrame:
    return _post_hits(spark, d, none_words=["the", "è"])


def filter_phrase(spark: SparkSession, d: str) -> DataFrame:
    return _post_hits(spark, d, exact_phrase="Of The")


def filter_comments(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.comments(spark, d)
    kept = flagging.keep_matching(rows, any_words=["the", "la", "die"], none_words=["of"])
    return kept.select("id", "subreddit")


def window_slice(spark: SparkSession, d: str) -> DataFrame:
    rows = slices.search(fx.walk_records(spark, d), ["src1", "src4", " SRC7"], *WINDOW)
    return rows.select("id", "subreddit", "kind", "created_epoch")


# --- phase 2 ------------------------------------------------------------------------------


def _flagged(spark: SparkSession, d: str, keywords: list[str], regexes: list[str]) -> DataFrame:
    parts = []
    for kind, rows in (("post", fx.posts(spark, d)), ("comment", fx.comments(spark, d))):
        marked = flagging.annotate(rows, keywords, regexes).filter(flagging.is_flagged())
        parts.append(
            marked.select(
                F.lit(kind).alias("type"), "id", "flag_reason",
                list_cell(F.col("matched_terms")).alias("matched_terms"),
            )
        )
    return parts[0].unionByName(parts[1])


def flag_keywords(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d, KEYWORDS, [])


def flag_many_keywords(spark: SparkSession, d: str) -> DataFrame:
    """Records flagged by a table of keywords: all words of the benchmark's texts, parts of them, and names of parts."""
    words = fx.table(spark, d, "benchmark").select(F.explode(F.split("text", "\\s+")).alias("word"))
    parts = words.select(F.substring("word", 2, 2).alias("word"))
    names = fx.table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    keywords = words.unionByName(parts).unionByName(names)
    found = []
    for kind, rows in (("post", fx.posts(spark, d)), ("comment", fx.comments(spark, d))):
        hits = flagging.annotate_hits_of(rows, keywords, "word")
        found.append(hits.select(F.lit(kind).alias("type"), "id", "flag_reason", list_cell(F.col("matched_terms")).alias("matched_terms")))
    return found[0].unionByName(found[1])


def flag_regex(spark: SparkSession, d: str) -> DataFrame:
    return _flagged(spark, d, [], REGEXES)


def flag_counts(spark: SparkSession, d: str) -> DataFrame:
    posts = flagging.count_matches(fx.posts(spark, d), KEYWORDS, REGEXES)
    comments = flagging.count_matches(fx.comments(spark, d), KEYWORDS, REGEXES)
    return posts.select(F.lit("posts").alias("kind"), "matches").unionByName(
        comments.select(F.lit("comments").alias("kind"), "matches")
    )


def flagged_posts_report(spark: SparkSession, d: str) -> DataFrame:
    rows = flagging.flagged_posts(flagging.annotate(fx.posts(spark, d), KEYWORDS, REGEXES))
    return rows.orderBy(*flagging.report_order()).withColumn(
        "matched_terms", list_cell(F.col("matched_terms"))
    )


def flagged_comments_context(spark: SparkSession, d: str) -> DataFrame:
    # In an archive the flags are stored before the report reads them; so they are here.
    hits = flagging.annotate_hits(fx.comments_of_posts(spark, d), KEYWORDS, REGEXES)
    marked = materialize(hits.drop("raw"), "flagged")
    rows = flagging.flagged_comments(marked, fx.posts(spark, d))
    return rows.orderBy(*flagging.report_order()).withColumn(
        "matched_terms", list_cell(F.col("matched_terms"))
    ).drop("depth")


def filter_run_report(spark: SparkSession, d: str) -> DataFrame:
    """Records taken into two archives, flagged there by a run, and its report read back."""
    root = fresh_dir(spark, "filter")
    when, every = _stamp("2024-02-01 00:00:00"), [f"src{i}" for i in range(20)]
    for kind, rows in (("post", fx.posts_raw(spark, d)), ("comment", fx.comments_raw(spark, d))):
        store.create_archive(spark, f"{root}/{kind}")
        runs.archive_run(spark, fx.as_json(rows), f"{root}/{kind}", kind, every, (0, 1 << 40), 0, when)
    runs.filter_run(spark, f"{root}/post", f"{root}/comment", f"{root}/report", KEYWORDS, REGEXES, 0, when)
    found = []
    for kind in ("post", "comment"):
        rows = spark.read.csv(f"{root}/report/flagged_{kind}s", header=True, multiLine=True, escape='"')
        depth, title = ("depth", "post_title") if kind == "comment" else ("CAST(NULL AS int)", "CAST(NULL AS string)")
        found.append(rows.selectExpr(
            f"'{kind}' AS type", "id", "subreddit", "CAST(score AS bigint) AS score", f"CAST({depth} AS int) AS depth", "created_utc",
            "matched_terms", f"{title} IS NOT NULL AS titled",
        ))
    return found[0].unionByName(found[1])


def lines_compaction(spark: SparkSession, d: str) -> DataFrame:
    """Comments appended as JSON lines, every second turn again with a later score, then compacted and read back."""
    root = fresh_dir(spark, "lines")
    rows = normalize.normalize_comments(fx.as_json(fx.comments_raw(spark, d)), raw="raw")
    even = F.regexp_extract("id", r"_(\d+)$", 1).cast("int") % 2 == 0
    later = rows.filter(even).withColumn("score", F.col("score") + 100)
    for day, part in ((1, rows), (2, later)):
        sinks.append_lines(normalize.storage_rows(part, _stamp(f"2024-02-0{day} 00:00:00")), f"{root}/lines")
    lines = raw.read_lines(spark, f"{root}/lines")
    schema = StructType([f for f in COMMENT.fields if f.name in normalize.storage_rows(rows, _stamp("2024-02-01 00:00:00")).columns])
    sinks.compact_lines(spark, f"{root}/lines", schema, [F.col("updated_at")], f"{root}/current")
    current = raw.read_lines(spark, f"{root}/current").select(F.from_json("raw", schema).alias("r")).select("r.*")
    return current.select(
        "id", "parent_id", "body", "score", "depth", F.dayofmonth("updated_at").alias("day"), F.lit(lines.count()).cast("bigint").alias("lines")
    )


# --- threads --------------------------------------------------------------------------------


def comment_depth(spark: SparkSession, d: str) -> DataFrame:
    return threads.resolve_forest(fx.comments(spark, d)).select("id", "depth")


def comments_with_depth(spark: SparkSession, d: str) -> DataFrame:
    return threads.with_depth(fx.comments(spark, d)).select("id", "depth", "author", "score", "body")


def late_parent_depth(spark: SparkSession, d: str) -> DataFrame:
    """Threads kept over two batches: the second brings every third comment, among them parents of earlier ones."""
    rows = fx.comments(spark, d).select("subreddit", "id", "parent_id")
    late = F.pmod(F.regexp_extract("id", r"_(\d+)$", 1).cast("int"), F.lit(3)) == 0
    forest = materialize(threads.whole_forest(rows.filter(~late)), "forest")
    changes = materialize(threads.forest_changes(forest, rows.filter(late)), "changes")
    return threads.with_changes(forest, changes).select("id", "parent", "depth", "root_id")


def depth_histogram(spark: SparkSession, d: str) -> DataFrame:
    return (
        threads.resolve_forest(fx.comments(spark, d))
        .groupBy(F.coalesce("depth", F.lit(-1)).alias("depth"))
        .agg(F.count("*").alias("comments"))
    )


def thread_roots(spark: SparkSession, d: str) -> DataFrame:
    return threads.thread_roots(threads.resolve_forest(fx.comments(spark, d))).select(
        "root_id", "comments", "max_depth"
    )


def orphans(spark: SparkSession, d: str) -> DataFrame:
    return threads.orphans(fx.comments(spark, d)).select("id", "parent_id")


def child_edges(spark: SparkSession, d: str) -> DataFrame:
    return threads.child_edges(fx.comments(spark, d)).select("parent", "child", "epoch")


def children_per_comment(spark: SparkSession, d: str) -> DataFrame:
    return threads.children_summary(fx.comments(spark, d))


def thread_preview(spark: SparkSession, d: str) -> DataFrame:
    return threads.thread_preview(fx.comments(spark, d))


def dry_run_counts(spark: SparkSession, d: str) -> DataFrame:
    return threads.sample_counts(fx.comments(spark, d))


def nested_threads(spark: SparkSession, d: str) -> DataFrame:
    fields = ["id", "parent_id", "author", "score", "created_epoch", "is_deleted"]
    rows = threads.nested_fragments(fx.comments(spark, d), fields)
    return rows.select("root_id", "id", "depth", "closes", "fragment")


def _line_trees(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each turn as one JSON document, each line a reply to the one before."""
    lines = F.split("text", "\n")
    numbered = F.transform(lines, lambda line, i: F.struct(line.alias("line"), i.alias("i")))

    def wrap(inner, item):
        body = F.to_json(F.struct(item["i"].cast("string").alias("id"), item["line"].alias("body")))
        open_record = F.substr(body, F.lit(1), F.length(body) - 1)
        # The three forms replies come in: list, envelope, and children beside empty replies.
        return F.when(
            item["i"] % 3 == 0, F.concat(open_record, F.lit(',"replies":['), inner, F.lit("]}"))
        ).when(
            item["i"] % 3 == 1,
            F.concat(open_record, F.lit(',"replies":{"data":['), inner, F.lit("]}}")),
        ).otherwise(
            F.concat(open_record, F.lit(',"replies":"","children":['), inner, F.lit("]}"))
        )

    nested = F.concat(F.lit('{"data":['), F.aggregate(F.reverse(numbered), F.lit(""), wrap), F.lit("]}"))
    return fx.table(spark, d, "conversations").select("conv_id", "turn", nested.alias("tree"))


def flatten_tree(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each turn, nested under one another, taken apart again."""
    record = F.try_parse_json("raw")
    return flatten_replies(_line_trees(spark, d), "tree", ["conv_id", "turn"]).select(
        "conv_id", "turn", "level",
        F.try_variant_get(record, "$.id", "bigint").alias("line_no"),
        F.try_variant_get(record, "$.body", "string").alias("line"),
    )


def _word_trees(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document as one JSON document, each a reply to the one before, in all forms of replies.

    A text has up to thousands of words, far more levels than the JSON reader takes. Every tenth
    document lacks its end.
    """
    words = F.transform(F.split("text", "\\s+"), lambda w, i: F.struct(i.alias("id"), w.alias("body"), F.array(F.struct(i.alias("n"))).alias("notes")))

    def opened(w, i):
        # The record ends in a list, so one brace goes.
        form = F.when(i % 3 == 0, ',"replies":[').when(i % 3 == 1, ',"replies":{"data":[').otherwise(',"replies":"","children":[')
        return F.concat(F.rtrim(F.to_json(w), F.lit("}")), form)

    closed = F.transform(F.reverse("words"), lambda w: F.when(w["id"] % 3 == 1, "]}}").otherwise("]}"))
    end = F.when(F.col("doc_id") % 10 == 0, "").otherwise("]}")
    tree = F.concat(F.lit('{"data":['), F.array_join(F.transform("words", opened), ""), F.array_join(closed, ""), end)
    return fx.spread(fx.table(spark, d, "documents")).select("doc_id", words.alias("words")).select("doc_id", tree.alias("tree"))


def flatten_deep(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document, nested thousands of levels deep, taken apart again."""
    record = F.try_parse_json("raw")
    return flatten_replies(_word_trees(spark, d), "tree", ["doc_id"]).select(
        "doc_id", "level",
        F.try_variant_get(record, "$.id", "bigint").alias("word_no"),
        F.try_variant_get(record, "$.body", "string").alias("word"),
        F.try_variant_get(record, "$.notes[0].n", "bigint").alias("note"),
    )


def flatten_unreadable(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose nested words are no JSON; ``flatten_deep`` has no rows for them."""
    return unreadable_documents(_word_trees(spark, d), "tree", ["doc_id"])


# --- timeline -------------------------------------------------------------------------------


def timeline_query(spark: SparkSession, d: str) -> DataFrame:
    rows = timeline.timeline(fx.posts(spark, d), fx.comments(spark, d))
    return rows.select(
        "type", "id", "post_id", "parent_id", "subreddit", "author", "title", "body", "score",
        "created_utc", "created_epoch", "is_deleted", "over_18",
    )


def count_by_type(spark: SparkSession, d: str) -> DataFrame:
    return timeline.count_by_type(timeline.timeline_rows(fx.posts(spark, d), fx.comments(spark, d)))


def merge_counts(spark: SparkSession, d: str) -> DataFrame:
    return timeline.count_by_folder(
        timeline.timeline_rows(fx.posts(spark, d), fx.comments(spark, d))
    )


def first_n_per_subreddit(spark: SparkSession, d: str) -> DataFrame:
    return slices.first_pages(fx.posts(spark, d), pages=2, page_size=5).select(
        "id", "subreddit", "created_epoch"
    )


def dry_run_slice(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.walk_records(spark, d)
    return slices.dry_run_slice(rows, ["src3", "src4"], fx.START + 9 * fx.DAY, page_size=20).select(
        "id", "subreddit", "created_epoch"
    )


# --- upserts --------------------------------------------------------------------------------


def _order():
    return [F.col(c) for c in ARRIVAL]


def dedup_last_wins(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.snapshots(spark, d).drop("fetched_at", "updated_at")
    return versions.latest(rows, ["subreddit", "id"], _order())


def first_seen(spark: SparkSession, d: str) -> DataFrame:
    rows = versions.first_seen(fx.snapshots(spark, d), ["subreddit", "id"], "fetched_at", _order())
    return rows.select("id", F.unix_timestamp("fetched_at").alias("first_seen_epoch"))


def _two_batches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots as stored table and new batch, each reduced to current rows, with a flag."""
    marked = fx.snapshots(spark, d).withColumns(
        {
            "flagged": F.when((F.col("event_id") % 2 == 0) & (F.col("score") >= 40), F.lit(True)),
            "flag_reason": F.lit(None).cast("string"),
        }
    )
    even = F.col("event_id") % 2 == 0
    return (
        versions.fold_versions(marked.filter(even), _order()),
        versions.fold_versions(marked.filter(~even), _order()),
    )


def _merged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "subreddit", "id", "kind", "score", "event_id", "flagged",
        F.unix_timestamp("fetched_at").alias("fetched"),
        F.unix_timestamp("updated_at").alias("updated"),
    )


def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    return _merged(versions.merge_upsert(*_two_batches(spark, d)))


def upsert_small_batch(spark: SparkSession, d: str) -> DataFrame:
    return _merged(versions.merge_small_batch(*_two_batches(spark, d)))


def upsert_in_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The same with the stored table in buckets, where the batch is all that is shuffled."""
    old, new = _two_batches(spark, d)
    path = fresh_dir(spark, "buckets")
    buckets.write_buckets(old, path, BUCKETS)
    base = buckets.read_buckets(spark, path, old.schema.simpleString()[7:-1], BUCKETS)
    return _merged(buckets.upsert(base, new, BUCKETS))


def upsert_by_versions(spark: SparkSession, d: str) -> DataFrame:
    """The same table from all versions at once, as a compaction builds it."""
    rows = fx.snapshots(spark, d).withColumns(
        {
            "flagged": F.when(F.col("score") >= 40, F.lit(True)),
            "flag_reason": F.lit(None).cast("string"),
        }
    )
    return _merged(versions.fold_versions(rows, _order()))


def score_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Scores of purchases refreshed from later errors of the same user."""
    rows = fx.snapshots(spark, d).drop("fetched_at", "updated_at")
    known = versions.latest(rows.filter(F.col("kind") == "purchase"), ["subreddit", "id"], _order())
    fresh = versions.latest(rows.filter(F.col("kind") == "error"), ["subreddit", "id"], _order())
    return versions.refresh_existing(known, fresh, ["score"]).select("id", "kind", "score", "event_id")


def subreddit_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Subreddits seen in documents, then seen again with comments."""
    first, second = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
    old = versions.subreddit_rows(
        fx.table(spark, d, "documents").select(
            F.col("source").alias("name"),
            F.concat(F.lit('{"lang":"'), F.col("lang"), F.lit('"}')).alias("raw"),
            F.col("doc_id").alias("arrival"),
        ),
        _stamp(first),
    )
    new = versions.subreddit_rows(
        fx.table(spark, d, "conversations").select(
            F.concat(F.lit(" SRC"), (F.col("conv_id") % 25).cast("string")).alias("name")
        ),
        _stamp(second),
    )
    rows = versions.upsert_subreddits(old, new)
    return rows.select(
        "name", F.unix_timestamp("first_seen_at").alias("first_seen"), "raw",
        F.unix_timestamp("updated_at").alias("updated"),
    )


def _stamp(text: str):
    from datetime import datetime, timezone

    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


# --- statistics and progress ------------------------------------------------------------------


def _listed_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets to report on: one per nation, so some have no records and some records no target."""
    return fx.table(spark, d, "nation").select(
        F.concat(F.lit("r/Src"), (F.col("n_nationkey") + 5).cast("string")).alias("target")
    )


def target_stats(spark: SparkSession, d: str) -> DataFrame:
    records = timeline.timeline_rows(fx.posts(spark, d), fx.comments(spark, d))
    return stats.target_stats(records, _listed_targets(spark, d))


def checkpoint_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = slices.in_window(fx.walk_records(spark, d), *WINDOW)
    asked = fx.table(spark, d, "nation").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("subreddit"),
        F.explode(F.array(F.lit("posts"), F.lit("comments"))).alias("kind"),
    )
    return progress.checkpoint_summary(rows, "arctic_shift", *WINDOW, walks=asked)


def _half_way(spark: SparkSession, d: str) -> DataFrame:
    """Progress after the window's first part; walks of even sources count as complete."""
    early = slices.in_window(fx.walk_records(spark, d), WINDOW[0], WINDOW[0] + 5 * fx.DAY)
    rows = progress.checkpoint_summary(early, "arctic_shift", *WINDOW)
    even = F.expr("CAST(substr(subreddit, 4) AS INT) % 2 = 0")
    return rows.withColumn("status", F.when(even, F.lit("complete")).otherwise(F.col("status")))


def progress_fraction(spark: SparkSession, d: str) -> DataFrame:
    rows = progress.progress_view(_half_way(spark, d), 600.0)
    return rows.select(
        "subreddit", "kind", "reached",
        F.floor(F.col("fraction") * 10000 + 0.5).cast("bigint").alias("fraction_bp"),
        F.floor(F.col("eta_seconds") + 0.5).cast("bigint").alias("eta"),
    )


def resume_skip(spark: SparkSession, d: str) -> DataFrame:
    rows = progress.remaining(
        fx.walk_records(spark, d), _half_way(spark, d), "arctic_shift", *WINDOW
    )
    return rows.select("id", "subreddit", "kind", "created_epoch")


def progress_merge(spark: SparkSession, d: str) -> DataFrame:
    later = checkpoint_summary(spark, d).filter(F.col("kind") == "posts")
    return progress.merge_progress(_half_way(spark, d), later)


def source_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Clicks, filled up with errors, signups, views and purchases, per subreddit and hour."""
    rows = fx.walk_records(spark, d)
    kinds = ("click", "error", "signup", "view", "purchase")
    by_type = [rows.filter(F.col("event_type") == t) for t in kinds]
    hour = F.floor(F.col("created_epoch") / 3600)
    return progress.serve_with_fallback(by_type, [F.col("subreddit"), hour]).select(
        "id", "subreddit", "event_type", "created_epoch"
    )


LEDGER_KEYS = ["subreddit", "kind"]
LEDGER_WIDTH = 3600


def _ledger_parts(spark: SparkSession, d: str):
    """Walks over events, two sources, and their failures.

    The dump lacks every tenth event and fails the hours of some signups; the mirror has all and
    fails those of fewer. Odd subreddits ask the mirror first.
    """
    rows = fx.walk_records(spark, d).withColumn("number", F.substring("id", 2, 20).cast("bigint"))
    sources = {"dump": rows.filter("number % 10 > 0"), "mirror": rows}
    failing = rows.filter("event_type = 'signup'").select(*LEDGER_KEYS, "number", "created_epoch")
    fails = failing.select(
        *LEDGER_KEYS, F.explode(F.expr("filter(array(IF(number % 3 = 0, 'dump', NULL), IF(number % 4 = 1, 'mirror', NULL)), b -> b IS NOT NULL)")).alias("backend"),
        F.col("created_epoch").alias("from_epoch"), (F.col("created_epoch") + 60).alias("to_epoch"),
    )
    order = F.when(F.regexp_extract("subreddit", "([0-9]+)", 1).cast("int") % 2 == 1, F.array(F.lit("mirror"), F.lit("dump"))).otherwise(F.array(F.lit("dump"), F.lit("mirror")))
    walks = rows.select(*LEDGER_KEYS).distinct().select(
        *LEDGER_KEYS, F.lit(WINDOW[0] + 1000).alias("after_epoch"), F.lit(WINDOW[1]).alias("before_epoch"), order.alias("backends")
    )
    return sources, fails, ledger.slices(walks, LEDGER_WIDTH)


def slice_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Who serves each hour of each walk, and how many records."""
    sources, fails, planned = _ledger_parts(spark, d)
    assigned = materialize(ledger.assign(planned, fails, LEDGER_KEYS, LEDGER_WIDTH), "assigned")
    taken = ledger.take(sources, assigned, LEDGER_KEYS, LEDGER_WIDTH)
    return ledger.entries(assigned, taken, LEDGER_KEYS, LEDGER_WIDTH).select(
        *LEDGER_KEYS, *ledger.SLICE, "source", list_cell(F.col("failed")).alias("failed"), "records"
    )


def slice_resume(spark: SparkSession, d: str) -> DataFrame:
    """Progress of each walk after a second run that repeats the open hours, with only the dump failing again."""
    sources, fails, planned = _ledger_parts(spark, d)
    first = materialize(ledger.assign(planned, fails, LEDGER_KEYS, LEDGER_WIDTH), "first")
    done = materialize(ledger.entries(first, ledger.take(sources, first, LEDGER_KEYS, LEDGER_WIDTH), LEDGER_KEYS, LEDGER_WIDTH), "done")
    again = ledger.open_slices(planned, done, LEDGER_KEYS).filter("slice_start % 7200 = 0")
    again = materialize(ledger.assign(again, fails.filter("backend = 'dump'"), LEDGER_KEYS, LEDGER_WIDTH), "again")
    new = ledger.entries(again, ledger.take(sources, again, LEDGER_KEYS, LEDGER_WIDTH), LEDGER_KEYS, LEDGER_WIDTH)
    return ledger.walk_progress(ledger.merged(done, new, LEDGER_KEYS), LEDGER_KEYS)


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Each event as a provider page: as envelope, bare list, empty, broken or foreign JSON."""
    return fx.table(spark, d, "events").selectExpr(
        "event_id AS page",
        f"""CASE event_id % 6
          WHEN 0 THEN concat('{{"data":[{{"id":"a","created_utc":', {fx.START} + event_id, '}},{{"id":"b","created_utc":"', {fx.START} + user_id, '.5"}}]}}')
          WHEN 1 THEN concat('[{{"id":"a","created_utc":', {fx.START} + event_id, '}},{{"id":"b","created_utc":"soon"}},{{"id":"c"}}]')
          WHEN 2 THEN '{{"data":[]}}'
          WHEN 3 THEN '{{"data":'
          WHEN 4 THEN '{{"data":{{"id":"a"}}}}'
          ELSE concat('{{"data":[', props, ']}}') END AS payload""",
    )


def page_cursor(spark: SparkSession, d: str) -> DataFrame:
    return progress.page_cursors(_pages(spark, d), "payload", ["page"])


def deep_page_cursor(spark: SparkSession, d: str) -> DataFrame:
    """Cursors of pages whose second record nests all words of a document; those without their end are broken."""
    item = F.expr("substr(tree, 10, length(tree) - 11)")
    pages = _word_trees(spark, d).select(
        F.col("doc_id").alias("page"),
        F.concat(
            F.lit('{"data":[{"id":"a","created_utc":'), (F.lit(fx.START) + F.col("doc_id")).cast("string"), F.lit("},"), item,
            F.lit(',{"id":"z","created_utc":"'), (F.lit(fx.START) + 2 * F.col("doc_id")).cast("string"), F.lit('.5"}]}'),
        ).alias("payload"),
    )
    return progress.page_cursors(pages, "payload", ["page"])


def page_items(spark: SparkSession, d: str) -> DataFrame:
    items = _pages(spark, d).select(
        "page", F.posexplode(envelope_items(F.try_parse_json("payload"))).alias("place", "item")
    )
    return items.select(
        "page", "place",
        F.try_variant_get("item", "$.id", "string").alias("id"),
        F.try_variant_get("item", "$.k", "bigint").alias("k"),
    )


def unreadable_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Pages that cannot be read, with the reason, beside the cursors that leave them open."""
    return unreadable_documents(_pages(spark, d), "payload", ["page"])


def id_map_records(spark: SparkSession, d: str) -> DataFrame:
    """Turns stored as id-keyed maps, read back record by record; other members are skipped."""
    text = F.concat(
        F.lit('{"'), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"),
        F.lit('": '), F.to_json(F.struct("role", "text")), F.lit(', "note": 5, "gone": null}'),
    )
    stored = fx.table(spark, d, "conversations").select(text.alias("value"))
    rows = records_of_map_text(stored, "value")
    return rows.select(
        "key",
        F.try_variant_get("record", "$.role", "string").alias("role"),
        F.try_variant_get("record", "$.text", "string").alias("text"),
    )


def _map_files(spark: SparkSession, d: str) -> MapScan:
    """Turns written as id-keyed map files, one per 10 conversations, and scanned again.

    The files have the usual indented layout, a compact one in one line, or one with blanks
    around everything; every seventh file lacks its end.
    """
    by_key = Window.partitionBy("folder").orderBy("conv_id", "turn")
    record = F.to_json(F.struct("role", "text"))
    key = F.concat(F.lit('"'), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"), F.lit('"'))
    layout = F.col("folder") % 3
    rows = fx.table(spark, d, "conversations").withColumn("folder", F.floor(F.col("conv_id") / 10)).select(
        "folder", "conv_id", "turn", layout.alias("layout"), key.alias("key"), record.alias("record"),
        F.lag("turn").over(by_key).isNull().alias("first"), F.lead("turn").over(by_key).isNull().alias("last"),
    )
    inner = F.expr("substr(record, 2, length(record) - 2)")
    broken = F.col("folder") % 7 == 3
    text = (
        F.when(layout == 0, F.concat(F.when(F.col("first"), "{\n  ").otherwise("  "), "key", F.lit(": {\n    "), inner, F.lit("\n  }"),
                                     F.when(~F.col("last"), ",\n").when(broken, "").otherwise("\n}")))
        .when(layout == 1, F.concat(F.when(F.col("first"), "{").otherwise(","), "key", F.lit(":"), "record", F.when(F.col("last") & ~broken, "}").otherwise("")))
        .otherwise(F.concat(F.when(F.col("first"), "\t{ ").otherwise(" , "), "key", F.lit(" : { "), inner, F.lit(" }"),
                            F.when(F.col("last") & ~broken, F.lit(' , "note" : [ { "n" : 1 } ] } ')).otherwise("")))
    )
    root = fresh_dir(spark, "maps")
    files = rows.select("folder", "conv_id", "turn", text.alias("value")).repartition("folder").sortWithinPartitions("folder", "conv_id", "turn")
    # The map stands in one line of blank-separated rows, or in the lines its rows bring along.
    files.select("folder", "value").write.partitionBy("folder").option("lineSep", " ").text(root)
    return scan_maps(spark, root, "*.txt")


def map_files(spark: SparkSession, d: str) -> DataFrame:
    """Records of map files in several layouts."""
    return _map_files(spark, d).records.select(
        F.regexp_extract("folder", r"=(\d+)$", 1).cast("bigint").alias("folder"), "key",
        F.try_variant_get("record", "$.role", "string").alias("role"),
        F.try_variant_get("record", "$.text", "string").alias("text"),
    )


def map_files_broken(spark: SparkSession, d: str) -> DataFrame:
    """Folders whose map file cannot be read."""
    broken = _map_files(spark, d).broken
    return broken.select(F.regexp_extract("folder", r"=(\d+)$", 1).cast("bigint").alias("folder"))


# --- jobs ---------------------------------------------------------------------------------------


def job_specs(spark: SparkSession, d: str) -> DataFrame:
    entries = jobs.job_entries(fx.job_payloads(spark, d), "payload")
    rows = jobs.parse_jobs(entries)
    return rows.select(
        "job_id", "error",
        F.array_join("warnings", "; ").alias("warnings"),
        F.array_join("subreddits", ",").alias("subreddits"),
        "start_epoch", "end_epoch", F.col("last_days").cast("bigint").alias("last_days"),
        F.array_join("all_words", ",").alias("all_words"),
        F.array_join("any_words", ",").alias("any_words"),
        F.array_join("none_words", ",").alias("none_words"),
        "exact_phrase", "fetch_posts", "fetch_comments",
        F.array_join("backends", ",").alias("backends"), "max_pages",
    )


def job_windows(spark: SparkSession, d: str) -> DataFrame:
    parsed = jobs.parse_jobs(jobs.job_entries(fx.job_payloads(spark, d), "payload"))
    rows = materialize(jobs.job_windows(parsed, fx.JOBS_NOW), "jobs").filter(F.col("error").isNull())
    return rows.select(
        "job_id", "after_epoch", "before_epoch", jobs.job_key(rows, fx.JOBS_NOW).alias("job_key")
    )


def _ready_targets(spark: SparkSession, d: str) -> DataFrame:
    parsed = jobs.parse_jobs(jobs.job_entries(fx.nation_jobs(spark, d), "payload"))
    # Posts, comments and statistics all need the targets: parse the payloads once.
    return jobs.job_targets(materialize(jobs.job_windows(parsed, fx.JOBS_NOW), "jobs"))


def _job_records(spark: SparkSession, d: str, targets: DataFrame | None = None) -> DataFrame:
    targets = _ready_targets(spark, d) if targets is None else targets
    return timeline.timeline_rows(
        jobs.match_jobs(fx.posts(spark, d), targets, "post"),
        jobs.match_jobs(fx.comments(spark, d), targets, "comment"),
        extra=["job_id"],
    )


def job_matches(spark: SparkSession, d: str) -> DataFrame:
    return _job_records(spark, d).select("job_id", "type", "id", "subreddit", "created_epoch")


def job_matches_many(spark: SparkSession, d: str) -> DataFrame:
    """Matches of a job per customer, some of first pages of five records only."""
    parsed = jobs.parse_jobs(jobs.job_entries(fx.customer_jobs(spark, d), "payload"))
    targets = jobs.job_targets(materialize(jobs.job_windows(parsed, fx.JOBS_NOW), "jobs"))
    found = timeline.timeline_rows(
        jobs.match_jobs(fx.posts(spark, d), targets, "post", page_size=5),
        jobs.match_jobs(fx.comments(spark, d), targets, "comment", page_size=5),
        extra=["job_id"],
    )
    return found.select("job_id", "type", "id", "subreddit", "created_epoch")


def job_target_stats(spark: SparkSession, d: str) -> DataFrame:
    targets = _ready_targets(spark, d)
    listed = targets.select("job_id", "target", "position")
    return stats.target_stats(_job_records(spark, d, targets), listed, by=["job_id"])


def job_first_pages(spark: SparkSession, d: str) -> DataFrame:
    """Job matches where every second job takes its first pages of five records only."""
    parsed = jobs.parse_jobs(jobs.job_entries(fx.nation_jobs(spark, d, pages=True), "payload"))
    targets = jobs.job_targets(materialize(jobs.job_windows(parsed, fx.JOBS_NOW), "jobs"))
    found = timeline.timeline_rows(
        jobs.match_jobs(fx.posts(spark, d), targets, "post", page_size=5),
        jobs.match_jobs(fx.comments(spark, d), targets, "comment", page_size=5),
        extra=["job_id"],
    )
    return found.select("job_id", "type", "id", "subreddit", "created_epoch")


def job_run_report(spark: SparkSession, d: str) -> DataFrame:
    """One status row per job of a whole job run: errors, output name, and counts of the results read back."""
    lists = fx.nation_jobs(spark, d).unionByName(fx.job_payloads(spark, d).filter("job % 12 BETWEEN 6 AND 10").select("payload"))
    done = runs.job_run(spark, fx.posts(spark, d), fx.comments(spark, d), lists, fresh_dir(spark, "jobs"), "container-1", fx.JOBS_NOW)
    return done.select("job_id", "status", "error", "job_key", "posts", "comments")


def job_counts(spark: SparkSession, d: str) -> DataFrame:
    return timeline.count_by_folder(_job_records(spark, d), "job_id")


def job_stats_payload(spark: SparkSession, d: str) -> DataFrame:
    return stats.stats_payload(job_target_stats(spark, d), "container-1")


# --- streaming ------------------------------------------------------------------------------------


def page_source(spark: SparkSession, d: str) -> DataFrame:
    """Events written as provider pages, a page per walk and day, streamed from there into an archive."""
    record = F.to_json(F.struct(
        "id", F.concat(F.lit("t3_p"), (F.col("created_epoch") % 50).cast("string")).alias("link_id"), "subreddit",
        F.col("event_type").alias("body"), F.col("created_epoch").alias("created_utc"),
    ))
    rows = fx.walk_records(spark, d).select("subreddit", "created_epoch", "id", record.alias("record"))
    day = F.floor(F.col("created_epoch") / fx.DAY)
    items = F.transform(F.array_sort(F.collect_list(F.struct("created_epoch", "id", "record"))), lambda r: r["record"])
    paged = rows.groupBy("subreddit", day.alias("day")).agg(F.max("created_epoch").alias("cursor"), F.array_join(items, ",").alias("items"))
    root = fresh_dir(spark, "pages")
    pages.register(spark)
    payload = F.concat(F.lit('{"data":['), "items", F.lit("]}"))
    paged.select("subreddit", F.lit("comments").alias("kind"), "cursor", payload.alias("payload")).write.format(pages.FORMAT).mode("append").save(f"{root}/pages")
    store.create_archive(spark, f"{root}/archive")
    start_ingest(spark, f"{root}/pages", f"{root}/archive", "comment", paged=True).awaitTermination()
    shown = ["id", "post_id", "subreddit", "body", "created_epoch"]
    found = store.current(spark, f"{root}/archive", "comment", depth=False, columns=shown).select(*shown)
    # The same source read as a table, its window chosen before pages are opened.
    batch = spark.read.format(pages.FORMAT).load(f"{root}/pages").filter(
        (F.col("subreddit") == "src3") & (F.col("created_epoch") >= WINDOW[0]) & (F.col("created_epoch") < WINDOW[1])
    )
    inside = batch.select("subreddit", F.get_json_object("raw", "$.id").alias("id"), F.lit(True).alias("in_window"))
    # On the whole key, by which current rows are dealt out already.
    return found.join(inside, ["subreddit", "id"], "left").select(*shown, F.coalesce("in_window", F.lit(False)).alias("in_window"))


def stream_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Raw comments landed as JSON files, streamed into the archive, with current rows read back."""
    rows = ingest_once(spark, fx.as_json(fx.comments_raw(spark, d)), kind="comment")
    return rows.select(
        "id", "post_id", "parent_id", "subreddit", "author", "body", "score", "created_epoch",
        "is_deleted", "depth",
    )


QUERIES = {
    "norm_posts": norm_posts,
    "norm_comments": norm_comments,
    "rejected_records": rejected_records,
    "deleted_share_by_subreddit": deleted_share_by_subreddit,
    "raw_json_props": raw_json_props,
    "target_names": target_names,
    "filter_all_any_none": filter_all_any_none,
    "filter_none_only": filter_none_only,
    "filter_phrase": filter_phrase,
    "filter_comments": filter_comments,
    "window_slice": window_slice,
    "flag_keywords": flag_keywords,
    "flag_many_keywords": flag_many_keywords,
    "flag_regex": flag_regex,
    "flag_counts": flag_counts,
    "flagged_posts_report": flagged_posts_report,
    "flagged_comments_context": flagged_comments_context,
    "filter_run_report": filter_run_report,
    "lines_compaction": lines_compaction,
    "comment_depth": comment_depth,
    "comments_with_depth": comments_with_depth,
    "depth_histogram": depth_histogram,
    "late_parent_depth": late_parent_depth,
    "thread_roots": thread_roots,
    "orphans": orphans,
    "child_edges": child_edges,
    "children_per_comment": children_per_comment,
    "thread_preview": thread_preview,
    "dry_run_counts": dry_run_counts,
    "nested_threads": nested_threads,
    "flatten_tree": flatten_tree,
    "flatten_deep": flatten_deep,
    "flatten_unreadable": flatten_unreadable,
    "timeline": timeline_query,
    "count_by_type": count_by_type,
    "merge_counts": merge_counts,
    "first_n_per_subreddit": first_n_per_subreddit,
    "dry_run_slice": dry_run_slice,
    "dedup_last_wins": dedup_last_wins,
    "first_seen": first_seen,
    "upsert_merge": upsert_merge,
    "upsert_small_batch": upsert_small_batch,
    "upsert_in_buckets": upsert_in_buckets,
    "upsert_by_versions": upsert_by_versions,
    "score_refresh": score_refresh,
    "subreddit_upsert": subreddit_upsert,
    "target_stats": target_stats,
    "checkpoint_summary": checkpoint_summary,
    "progress_fraction": progress_fraction,
    "resume_skip": resume_skip,
    "progress_merge": progress_merge,
    "source_fallback": source_fallback,
    "slice_ledger": slice_ledger,
    "slice_resume": slice_resume,
    "page_cursor": page_cursor,
    "deep_page_cursor": deep_page_cursor,
    "unreadable_inputs": unreadable_inputs,
    "page_items": page_items,
    "id_map_records": id_map_records,
    "map_files": map_files,
    "map_files_broken": map_files_broken,
    "job_specs": job_specs,
    "job_windows": job_windows,
    "job_matches": job_matches,
    "job_matches_many": job_matches_many,
    "job_target_stats": job_target_stats,
    "job_run_report": job_run_report,
    "job_counts": job_counts,
    "job_first_pages": job_first_pages,
    "job_stats_payload": job_stats_payload,
    "stream_upsert": stream_upsert,
    "page_source": page_source,
}
