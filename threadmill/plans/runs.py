"""The four runs of the archiver: archive a window, flag, match jobs, merge."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import flagging, jobs, ledger, normalize, progress, slices, stats, threads, timeline
from ..schemas import FLAG_COLUMNS, FLAGGED_COMMENT_COLUMNS, FLAGGED_POST_COLUMNS
from ..session import materialize, prepare
from ..sources import archive, sinks, store


def archive_run(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    kind: str,
    subreddits: list[str],
    window: tuple[int, int],
    batch_id: int,
    batch_time: datetime,
    clauses: dict | None = None,
    done: DataFrame | None = None,
    backend: str = "dump",
    resume: bool = False,
) -> DataFrame:
    """Take the records of a window into the archive at ``root``; returns progress rows.

    The rows are kept in the archive's table of walks, one for every subreddit asked for, also
    if it had no record. With ``resume`` that table tells what is done.

    ``raw`` is a dump: JSON text in a ``raw`` column, or columns. ``clauses`` are the arguments
    of :func:`content_filter`. ``done`` is the progress so far: complete walks are skipped and
    open ones go on from their cursor. Progress counts raw records, not just the kept ones.
    """
    prepare(spark)
    normal = normalize.normalize_comments if kind == "comment" else normalize.normalize_posts
    rows = normal(_with_place(raw), raw="raw" if raw.columns == ["raw"] else None, keep=["file", "block"])
    rows = slices.search(rows, subreddits, *window).withColumn("kind", F.lit(f"{kind}s"))
    done = store.walks(spark, root) if resume and done is None else done
    if done is not None:
        rows = progress.remaining(rows, done, backend, *window)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if clauses:
        # Parsed once for the archive and for the progress, which counts what the clauses leave out too.
        rows = materialize(rows, "taken")
    asked = spark.createDataFrame([(s.strip().lower(), f"{kind}s") for s in subreddits], "subreddit string, kind string")
    if done is not None:
        mine = (F.col("backend") == backend) & (F.col("window_start_epoch") == window[0]) & (F.col("window_end_epoch") == window[1])
        finished = done.filter(mine & (F.col("status") == "complete")).select("subreddit", "kind")
        asked = asked.join(finished, ["subreddit", "kind"], "left_anti")
    kept = flagging.keep_matching(rows, **(clauses or {}))
    arrival = _arrival(batch_id, batch_time, F.col("file"), F.col("block"), F.col("row"))
    placed = kept.withColumn("arrival", arrival)
    stored = normalize.storage_rows(placed, batch_time, ["arrival"])
    written = store.append_versions(stored, root, kind, "run", batch_id)
    # Without clauses all records were kept, so what was written tells the progress.
    walked = rows if clauses else written.withColumn("kind", F.lit(f"{kind}s"))
    # A batch run reads its window to the end.
    summary = progress.checkpoint_summary(walked, backend, *window, walks=asked, finished=True)
    summary = materialize(summary, "walks")
    store.write_walks(summary, root, f"run-{kind}-{backend}", batch_id)
    names = spark.createDataFrame([(s,) for s in subreddits], "name string")
    store.note_subreddits(names, root, f"run-{kind}", batch_id, batch_time)
    return summary


def sliced_run(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    kind: str,
    subreddits: list[str],
    window: tuple[int, int],
    batch_id: int,
    batch_time: datetime,
    failures: DataFrame | None = None,
    backends: DataFrame | None = None,
    clauses: dict | None = None,
    slice_seconds: int = 86400,
) -> DataFrame:
    """Take a window into the archive from several sources, slice by slice; returns progress rows.

    ``sources`` are dumps by name, in the order they are asked; ``backends`` (``subreddit,
    backends``) gives some walks an order of their own, as a job's does. ``failures``
    (``subreddit, kind, backend, from_epoch, to_epoch``) are the times a source could not serve: the
    next one is asked for their slices, and where all fail the slice stays open. The archive keeps
    the ledger: a later run of the same window takes the open slices alone. Progress stands
    under the first source's name.
    """
    prepare(spark)
    keys, kinds = ["subreddit", "kind"], f"{kind}s"
    normal = normalize.normalize_comments if kind == "comment" else normalize.normalize_posts
    rows = {}
    for name, raw in sources.items():
        part = normal(_with_place(raw), raw="raw" if raw.columns == ["raw"] else None, keep=["file", "block"])
        rows[name] = slices.search(part, subreddits, *window).withColumn("kind", F.lit(kinds))
    asked = spark.createDataFrame([(s.strip().lower(), kinds, *window) for s in dict.fromkeys(subreddits)],
                                  "subreddit string, kind string, after_epoch bigint, before_epoch bigint")
    order = F.array(*[F.lit(name) for name in sources])
    if backends is not None:
        asked = asked.join(backends.select("subreddit", "backends"), "subreddit", "left")
        # A source that is not there cannot be asked.
        own = F.filter("backends", lambda b: F.array_contains(order, b))
        asked = asked.withColumn("backends", F.when(F.size(own) > 0, own).otherwise(order))
    else:
        asked = asked.withColumn("backends", order)
    # A batch that runs again takes the same slices as at first.
    known = store.ledger(spark, root, without=(f"run-{kind}", batch_id))
    planned = ledger.open_slices(ledger.slices(asked, slice_seconds), known, keys)
    assigned = materialize(ledger.assign(planned, failures, keys, slice_seconds), "assigned")
    taken = ledger.take(rows, assigned, keys, slice_seconds)
    taken = materialize(taken.withColumn("row", F.monotonically_increasing_id()), "taken")
    kept = flagging.keep_matching(taken, **(clauses or {}))
    arrival = _arrival(batch_id, batch_time, F.col("file"), F.col("block"), F.col("row"))
    stored = normalize.storage_rows(kept.withColumn("arrival", arrival), batch_time, ["arrival"])
    store.append_versions(stored, root, kind, "run", batch_id)
    # After the records: a run that is lost before here leaves its slices open.
    store.write_ledger(ledger.entries(assigned, taken, keys, slice_seconds), root, f"run-{kind}", batch_id)
    here = ledger.slices(asked, slice_seconds).select(*keys, *ledger.SLICE)
    walked = ledger.walk_progress(store.ledger(spark, root).join(here, [*keys, *ledger.SLICE], "left_semi"), keys)
    summary = walked.select(
        "subreddit", F.lit(next(iter(sources))).alias("backend"), "kind", F.lit(window[0]).cast("bigint").alias("window_start_epoch"),
        F.lit(window[1]).cast("bigint").alias("window_end_epoch"), "cursor_epoch", "status", "items_fetched",
    )
    summary = materialize(summary, "walks")
    store.write_walks(summary, root, f"run-{kind}-{next(iter(sources))}", batch_id)
    names = spark.createDataFrame([(s,) for s in subreddits], "name string")
    store.note_subreddits(names, root, f"run-{kind}", batch_id, batch_time)
    return summary


def _with_place(raw: DataFrame) -> DataFrame:
    """The records with the file and block they were read from, which order equal arrivals
    whatever splits Spark reads; records that come from no file have none."""
    try:
        return raw.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    except AnalysisException:
        return raw.select("*", F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"))


def _arrival(batch_id: int, batch_time: datetime, file=None, block=None, row=None):
    return F.struct(
        F.lit(batch_time).alias("landed"), F.lit(batch_id).cast("bigint").alias("batch"),
        (F.lit("") if file is None else file).alias("file"),
        (F.lit(0).cast("bigint") if block is None else block).alias("block"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )


def dry_run(
    spark: SparkSession, raw: DataFrame, subreddits: list[str], now: int, last_days: int = 3,
    pages: int = 2, page_size: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """Comment and root counts, and a thread preview, of a small slice; nothing is stored."""
    prepare(spark)
    rows = normalize.normalize_comments(raw, raw="raw" if raw.columns == ["raw"] else None)
    part = slices.dry_run_slice(rows, subreddits, now, last_days, pages, page_size)
    sample = materialize(part.drop("raw").dropDuplicates(["subreddit", "id"]), "sample", small=True)
    return threads.sample_counts(sample), threads.thread_preview(sample)


def filter_run(
    spark: SparkSession,
    posts_root: str,
    comments_root: str,
    report: str,
    keywords: list[str],
    regexes: list[str],
    batch_id: int,
    batch_time: datetime,
) -> DataFrame | None:
    """Flag the archive by keyword and regex, write the report, return the counts.

    Only records that match now are written, as versions that add the flags; flags set by
    earlier runs stay. Without any term nothing is done at all.
    """
    prepare(spark)
    if not flagging.has_terms(keywords, regexes):
        return None
    counts = []
    for kind, root in (("post", posts_root), ("comment", comments_root)):
        rows = store.current(spark, root, kind, depth=False, without=("flags", batch_id))
        hits = flagging.annotate_hits(rows, keywords, regexes)
        written = store.append_versions(
            hits.withColumn("arrival", _arrival(batch_id, batch_time)), root, kind, "flags", batch_id
        )
        counts.append(
            written.agg(F.count("*").alias("flagged")).select(F.lit(f"{kind}s").alias("kind"), "flagged")
        )
    # Each archive is folded once for the flagged rows, and once for the titles, with only the columns
    # that the report has. Flagged posts are sorted from that one shuffle.
    posts = store.current(spark, posts_root, "post", columns=(*FLAGGED_POST_COLUMNS, *FLAG_COLUMNS))
    titles = store.current(spark, posts_root, "post", columns=("title",))
    comments = store.current(spark, comments_root, "comment", columns=(*FLAGGED_COMMENT_COLUMNS, *FLAG_COLUMNS))
    marked = materialize(comments.filter(flagging.is_flagged()), "flagged")
    sinks.write_report(
        flagging.flagged_posts(posts),
        materialize(flagging.flagged_comments(marked, titles), "flagged_comments"), report,
    )
    return counts[0].unionByName(counts[1])


def job_run(
    spark: SparkSession,
    posts: DataFrame,
    comments: DataFrame,
    job_lists: DataFrame,
    out: str,
    container_id: str,
    now: int,
    default_window: tuple[str | None, str | None] | None = None,
) -> DataFrame:
    """All jobs over the archive in one pass: results, statistics, and one status row per job.

    A job that cannot be run gets its error in its status row and does not stop the others.
    """
    prepare(spark)
    list_key = "list" if "list" in job_lists.columns else None
    entries = jobs.job_entries(job_lists, "payload", list_key=list_key)
    parsed = materialize(
        jobs.job_windows(jobs.parse_jobs(entries, default_window=default_window), now), "jobs"
    )
    targets = materialize(jobs.job_targets(parsed), "targets")
    found = timeline.timeline_rows(
        jobs.match_jobs(posts, targets, "post"), jobs.match_jobs(comments, targets, "comment"),
        extra=["job_id"],
    )
    # Sorting into files looks at its input twice; the matches are found once.
    sinks.write_job_results(materialize(found, "found"), f"{out}/results")
    results = sinks.read_job_results(spark, f"{out}/results")
    per_target = stats.target_stats(
        results, targets.select("job_id", "target", "position"), by=["job_id"]
    )
    sinks.write_payloads(stats.stats_payload(per_target, container_id), f"{out}/stats")
    counts = timeline.count_by_folder(results, "job_id").drop("records")
    return (
        parsed.join(counts, "job_id", "left")
        .select(
            "job_id",
            F.when(F.col("error").isNull(), F.lit("success")).otherwise(F.lit("error")).alias("status"),
            "error", F.array_join("warnings", "; ").alias("warnings"), "source_label",
            F.when(F.col("error").isNull(), jobs.job_key(parsed, now)).alias("job_key"),
            F.when(F.col("error").isNull(), F.coalesce("post", F.lit(0))).alias("posts"),
            F.when(F.col("error").isNull(), F.coalesce("comment", F.lit(0))).alias("comments"),
        )
    )


def merge_run(spark: SparkSession, root: str, out: str) -> tuple[DataFrame, DataFrame]:
    """Merge each folder's posts and comments into one timeline; counts, and failed folders.

    A map in ``root`` itself makes it the only folder. Folders are told apart by their path
    below ``root``. The parsed records are stored once: sorting them into files looks at them
    twice, and so do the counts.
    """
    prepare(spark)
    nested = not archive.root_holds_maps(spark, root)
    found = archive.read_archive(spark, root, whole_folders=True, nested=nested)
    rows = timeline.timeline_rows(found.posts, found.comments, extra=["folder"])
    rows = rows.withColumn("folder", archive.relative_folder(F.col("folder"), root))
    rows = materialize(rows, "merge")
    sinks.write_merged(rows, out, by="folder")
    failed = found.failed.withColumn("folder", archive.relative_folder(F.col("folder"), root))
    return timeline.count_by_folder(rows, "folder"), failed
