"""The archive as tables: a stored base, and the record versions that came after it.

A batch only appends what it brought, to ``versions/writer=<name>/batch=<id>``, so it costs
what it brings, however large the archive is. The current rows are the base folded with the
versions since (``current``), and ``compact`` writes them down as the next base. Each writer
(the stream, window runs, flag runs) counts its own batches upwards. Posts and comments are
two such archives.

An archive of comments also keeps the forest of its threads. A batch adds the rows that it changes
there, so reading the archive joins depths instead of working them out. Batches that the kept
forest has not seen, whatever the reason, are added when it is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..functions.text import partition_name
from ..operators.threads import FOREST, KEY, forest_changes, resolve_forest, whole_forest, with_changes, with_depth
from ..operators.versions import fold_versions, latest, subreddit_rows
from ..schemas import COMMENT, POST
from ..session import prepare

# Place of a version in the order of arrival.
ARRIVAL = StructType(
    [
        StructField("landed", TimestampType()),
        StructField("batch", LongType()),
        StructField("file", StringType()),
        StructField("block", LongType()),
        StructField("row", LongType()),
    ]
)
_COMMITS = "version bigint, path string, upto map<string,bigint>"
# A forest is the rows at ``paths``, later ones over earlier ones, and knows these batches.
_FORESTS = "seq bigint, paths array<string>, batches array<string>"
_TREE_ROWS = "subreddit string, id string, parent string, depth int, root_id string"
# So many sets of changes are folded when a forest is read; the next one writes it as a whole.
MOST_CHANGES = 16


def _schema(kind: str) -> StructType:
    return StructType([*(COMMENT if kind == "comment" else POST).fields, StructField("arrival", ARRIVAL)])


def _version_schema(kind: str) -> StructType:
    places = [StructField("writer", StringType()), StructField("batch", LongType())]
    return StructType([*_schema(kind).fields, *places])


def create_archive(spark: SparkSession, root: str) -> None:
    """An empty archive: no base, nothing folded yet, and an empty batch so that it can be read."""
    prepare(spark)
    for table, columns in (("versions", "id string"), ("progress", "subreddit string"), ("walks", "subreddit string"), ("ledger", "subreddit string"), ("subreddits", "name string")):
        nothing = spark.createDataFrame([], columns)
        nothing.write.mode("errorifexists").parquet(f"{root}/{table}/writer=none/batch=-1")
    spark.createDataFrame([(0, [], [])], _FORESTS).coalesce(1).write.mode("errorifexists").parquet(f"{root}/forests")
    _commit(spark, root, 0, None, {}, "error")


def _commit(spark: SparkSession, root: str, version: int, path: str | None, upto: dict, mode: str) -> None:
    row = spark.createDataFrame([(version, path, upto)], _COMMITS).coalesce(1)
    row.write.mode(mode).parquet(f"{root}/commits")


def _last_commit(spark: SparkSession, root: str):
    commits = spark.read.schema(_COMMITS).parquet(f"{root}/commits")
    return commits.orderBy(F.desc("version")).first()


def append_versions(rows: DataFrame, root: str, kind: str, writer: str, batch_id: int) -> DataFrame:
    """Add the record versions of one batch and return them; doing it again replaces them.

    ``rows`` are in table form with an ``arrival`` column. The batch's progress is kept
    beside it, and the kept forest takes in the comments.
    """
    place = f"writer={writer}/batch={batch_id}"
    target = f"{root}/versions/{place}"
    # Records are kept with their raw text, so texts stand there twice; zstd sees that.
    rows.select(*_schema(kind).fieldNames()).write.mode("overwrite").option("compression", "zstd").parquet(target)
    written = rows.sparkSession.read.schema(_schema(kind)).parquet(target)
    (
        written.groupBy("subreddit")
        .agg(F.count("*").alias("items"), F.max("created_epoch").alias("cursor_epoch"))
        .withColumn("kind", F.lit(kind))
        .write.mode("overwrite").parquet(f"{root}/progress/{place}")
    )
    if kind == "comment":
        refresh_forest(rows.sparkSession, root)
    return written


def _versions(spark: SparkSession, root: str, kind: str) -> DataFrame:
    return spark.read.schema(_version_schema(kind)).parquet(f"{root}/versions")


def stored_versions(
    spark: SparkSession, root: str, kind: str, without: tuple[str, int] | None = None
) -> DataFrame:
    """The base and the versions that came after it.

    ``without`` leaves out one batch (writer, id): the one about to be written again.
    """
    commit = _last_commit(spark, root)
    writer, batch = F.col("writer"), F.col("batch")
    since = _versions(spark, root, kind)
    # Conditions on partition columns: files of folded batches are not opened.
    for name, last in (commit["upto"] or {}).items():
        since = since.filter((writer != name) | (batch > last))
    if without is not None:
        since = since.filter((writer != without[0]) | (batch != without[1]))
    since = since.drop("writer", "batch")
    if commit["path"] is None:
        return since
    base = spark.read.schema(_schema(kind)).parquet(commit["path"])
    return base.select(*_schema(kind).fieldNames()).unionByName(since)


def current(
    spark: SparkSession, root: str, kind: str, depth: bool = True,
    without: tuple[str, int] | None = None, columns: Iterable[str] | None = None,
) -> DataFrame:
    """The current row of every record; comments with their depth unless not wanted.

    With ``columns`` rows have only these beside their keys, and only these are shuffled.
    """
    versions = stored_versions(spark, root, kind, without)
    wanted = versions
    if columns is not None:
        keep = {*KEY, "arrival", *columns}
        wanted = versions.select(*[c for c in versions.columns if c in keep])
    rows = fold_versions(wanted, [F.col("arrival")])
    if kind != "comment" or not depth:
        return rows
    if without is not None:
        # One batch is looked away from, so the kept forest does not apply.
        links = latest(
            versions.select("subreddit", "id", "parent_id", "arrival"), ["subreddit", "id"],
            [F.col("arrival")],
        )
        return with_depth(rows, resolve_forest(links))
    forest, _, missing = _kept_forest(spark, root)
    if missing:
        forest = with_changes(forest, forest_changes(forest, _links_of(spark, root, missing)))
    return with_depth(rows, forest)


def _kept_forest(spark: SparkSession, root: str):
    """The forest as it is kept, its commit, and the batches it does not know."""
    commit = spark.read.schema(_FORESTS).parquet(f"{root}/forests").orderBy(F.desc("seq"), F.desc(F.size("batches"))).first()
    folded = _last_commit(spark, root)["upto"] or {}
    there = _versions(spark, root, "comment").select("writer", "batch").distinct().collect()
    known = set(commit["batches"])
    missing = sorted(
        (r["writer"], r["batch"]) for r in there
        if r["writer"] != "none" and r["batch"] > folded.get(r["writer"], -1) and f"{r['writer']}/{r['batch']}" not in known
    )
    paths = commit["paths"]
    if not paths:
        return spark.createDataFrame([], _TREE_ROWS), commit, missing
    read = [spark.read.schema(_TREE_ROWS).parquet(p) for p in paths]
    if len(read) == 1:
        return read[0], commit, missing
    rows = reduce(lambda x, y: x.unionByName(y), [df.withColumn("nth", F.lit(i)) for i, df in enumerate(read)])
    last = F.max_by(F.struct("parent", "depth", "root_id"), "nth")
    return rows.groupBy(*KEY).agg(last.alias("row")).select(*KEY, "row.*").select(*FOREST), commit, missing


def _links(spark: SparkSession, root: str) -> DataFrame:
    """The current parent of every comment."""
    return latest(stored_versions(spark, root, "comment").select(*KEY, "parent_id", "arrival"), KEY, [F.col("arrival")])


def _links_of(spark: SparkSession, root: str, batches: list[tuple[str, int]]) -> DataFrame:
    """The current parent of every comment that the batches brought."""
    wanted = spark.createDataFrame(batches, "writer string, batch bigint")
    keys = _versions(spark, root, "comment").join(F.broadcast(wanted), ["writer", "batch"], "left_semi").select(*KEY).distinct()
    versions = stored_versions(spark, root, "comment").select(*KEY, "parent_id", "arrival")
    return latest(versions.join(keys, KEY, "left_semi"), KEY, [F.col("arrival")])


def refresh_forest(spark: SparkSession, root: str, whole: bool = False) -> None:
    """Let the kept forest take in the batches it does not know; ``whole`` writes it anew as one table.

    Two writers at once do no harm: one of their commits counts, and the other's batches are
    unknown to it until the next refresh.
    """
    forest, commit, missing = _kept_forest(spark, root)
    if not missing and not whole:
        return
    path = f"{root}/forest/{uuid.uuid4().hex}"
    changes = None
    if missing:
        # Without a forest so far no batch is known, and the missing ones brought every comment.
        changes = forest_changes(forest, _links_of(spark, root, missing)) if commit["paths"] else whole_forest(_links(spark, root))
    if not commit["paths"]:
        out, paths = changes if changes is not None else forest, [path]
    elif whole or len(commit["paths"]) >= MOST_CHANGES:
        out, paths = forest if changes is None else with_changes(forest, changes), [path]
    else:
        out, paths = changes, [*commit["paths"], path]
    out.select(*FOREST).write.parquet(path)
    # Batches that the base has taken in need no mention any more.
    folded = _last_commit(spark, root)["upto"] or {}
    known = [b for b in commit["batches"] if int(b.rsplit("/", 1)[1]) > folded.get(b.rsplit("/", 1)[0], -1)]
    row = (commit["seq"] + 1, paths, [*known, *[f"{w}/{b}" for w, b in missing]])
    spark.createDataFrame([row], _FORESTS).coalesce(1).write.mode("append").parquet(f"{root}/forests")


_WALKS = (
    "subreddit string, backend string, kind string, window_start_epoch bigint, window_end_epoch bigint, "
    "cursor_epoch bigint, status string, items_fetched bigint"
)


def write_walks(rows: DataFrame, root: str, writer: str, batch_id: int) -> None:
    """Keep the progress rows of one batch; doing it again replaces them."""
    rows.select(*[c.split()[0] for c in _WALKS.split(", ")]).write.mode("overwrite").parquet(
        f"{root}/walks/writer={writer}/batch={batch_id}"
    )


def walks(spark: SparkSession, root: str) -> DataFrame:
    """The last progress row of every walk and window."""
    rows = spark.read.schema(f"{_WALKS}, writer string, batch bigint").parquet(f"{root}/walks")
    keys = ["subreddit", "backend", "kind", "window_start_epoch", "window_end_epoch"]
    rest = F.struct("cursor_epoch", "status", "items_fetched")
    return rows.groupBy(*keys).agg(F.max_by(rest, "batch").alias("last")).select(*keys, "last.*")


_SUBREDDITS = "name string, first_seen_at timestamp, raw string, updated_at timestamp"


def note_subreddits(names: DataFrame, root: str, writer: str, batch_id: int, batch_time) -> None:
    """Keep the subreddits that a batch asked for (``name``, and ``raw`` if known); doing it again replaces them."""
    subreddit_rows(names, batch_time).write.mode("overwrite").parquet(f"{root}/subreddits/writer={writer}/batch={batch_id}")


def subreddits(spark: SparkSession, root: str) -> DataFrame:
    """All subreddits ever asked for: seen first, the last record known of each, and asked for last."""
    rows = spark.read.schema(f"{_SUBREDDITS}, writer string, batch bigint").parquet(f"{root}/subreddits")
    known = F.col("raw").isNotNull()
    return rows.groupBy("name").agg(
        F.min("first_seen_at").alias("first_seen_at"),
        F.max_by(F.when(known, F.col("raw")), F.when(known, F.struct("updated_at", "batch"))).alias("raw"),
        F.max("updated_at").alias("updated_at"),
    )


_LEDGER = "subreddit string, kind string, slice_start bigint, slice_end bigint, source string, failed array<string>, records bigint"


def write_ledger(rows: DataFrame, root: str, writer: str, batch_id: int) -> None:
    """Keep the ledger rows of one batch; doing it again replaces them."""
    rows.select(*[c.split()[0] for c in _LEDGER.split(", ")]).write.mode("overwrite").parquet(
        f"{root}/ledger/writer={writer}/batch={batch_id}"
    )


def ledger(spark: SparkSession, root: str, without: tuple[str, int] | None = None) -> DataFrame:
    """The last ledger row of every slice; ``without`` leaves out one batch (writer, id)."""
    rows = spark.read.schema(f"{_LEDGER}, writer string, batch bigint").parquet(f"{root}/ledger")
    if without is not None:
        rows = rows.filter((F.col("writer") != without[0]) | (F.col("batch") != without[1]))
    keys = ["subreddit", "kind", "slice_start", "slice_end"]
    last = F.max_by(F.struct("source", "failed", "records"), "batch").alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def progress(spark: SparkSession, root: str) -> DataFrame:
    """Records taken in and time reached, per subreddit and kind, over all batches."""
    schema = (
        "subreddit string, items bigint, cursor_epoch bigint, kind string, "
        "writer string, batch bigint"
    )
    return (
        spark.read.schema(schema).parquet(f"{root}/progress")
        .groupBy("subreddit", "kind")
        .agg(F.sum("items").alias("items_fetched"), F.max("cursor_epoch").alias("cursor_epoch"))
    )


def compact(spark: SparkSession, root: str, kind: str) -> int:
    """Write the current rows as the next base; readers switch over with the commit row.

    Nothing that is being read gets overwritten, and a failed run leaves no commit. No writer
    may be active meanwhile.
    """
    commit = _last_commit(spark, root)
    if kind == "comment":
        refresh_forest(spark, root, whole=True)
    reached = _versions(spark, root, kind).groupBy("writer").agg(F.max("batch").alias("last"))
    upto = {**(commit["upto"] or {}), **{r["writer"]: r["last"] for r in reached.collect()}}
    version = commit["version"] + 1
    path = f"{root}/base/version={version}"
    order = ["folder", "created_epoch", "id"]
    (
        current(spark, root, kind)
        .withColumn("folder", partition_name(F.col("subreddit")))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite").partitionBy("folder").parquet(path)
    )
    _commit(spark, root, version, path, upto, "append")
    return version
