"""Raw record files -> archive, in micro-batches that can be stopped, replayed and resumed.

Each batch appends to the archive (see ``sources.store``) under its batch id, so a replayed
batch replaces what its first try wrote. Records of any age are taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.flagging import keep_matching
from ..operators.normalize import normalize_comments, normalize_posts, storage_rows
from ..session import fresh_dir, prepare
from ..sources import pages
from ..sources.store import append_versions, create_archive, current


def read_landing(spark: SparkSession, landing: str, max_files: int) -> DataFrame:
    """Raw JSON lines as they land, each with where and when it landed."""
    return (
        spark.readStream.option("maxFilesPerTrigger", max_files)
        .text(landing)
        .select(
            F.col("value").alias("raw"),
            F.col("_metadata.file_modification_time").alias("landed"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


def read_pages(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Records of a folder of provider pages (see ``sources.pages``) as they come; a page's cursor
    stands for the time it landed."""
    pages.register(spark)
    return (
        spark.readStream.format(pages.FORMAT)
        .load(root)
        .filter(F.col("kind") == f"{kind}s")
        .select("raw", F.timestamp_seconds("cursor").alias("landed"), "file", F.lit(0).cast("bigint").alias("block"))
    )


def _append_batch(
    batch: DataFrame, batch_id: int, root: str, kind: str, clauses: dict, fallback: str | None
) -> None:
    # Files are ordered by landing time and name. Within a file block the running number
    # follows the lines, so that the later of two copies wins.
    arrival = F.struct(
        "landed", F.lit(batch_id).cast("bigint").alias("batch"), "file", "block",
        F.monotonically_increasing_id().alias("row"),
    )
    normal = normalize_comments if kind == "comment" else normalize_posts
    parsed = normal(
        batch.select("raw", arrival.alias("arrival")),
        raw="raw", fallback=None if fallback is None else F.lit(fallback), keep=["arrival"],
    )
    parsed = keep_matching(parsed, **clauses)
    # The landing time of the file is the batch time: a replay writes the same stamps.
    rows = storage_rows(parsed, F.col("arrival.landed"), keep=["arrival"])
    append_versions(rows, root, kind, "stream", batch_id)


def start_ingest(
    spark: SparkSession,
    landing: str,
    root: str,
    kind: str,
    clauses: dict | None = None,
    fallback: str | None = None,
    max_files: int = 1000,
    paged: bool = False,
) -> StreamingQuery:
    """Take in everything that has landed and stop; a later start goes on from there.

    ``landing`` holds record lines, or with ``paged`` provider pages by walk and cursor.
    ``clauses`` are the arguments of :func:`content_filter`: only matching records are kept.
    """
    prepare(spark)

    def append(batch: DataFrame, batch_id: int) -> None:
        _append_batch(batch, batch_id, root, kind, clauses or {}, fallback)

    landed = read_pages(spark, landing, kind) if paged else read_landing(spark, landing, max_files)
    return (
        landed.writeStream.foreachBatch(append)
        .option("checkpointLocation", f"{root}/stream")
        .trigger(availableNow=True)
        .start()
    )


def ingest_once(spark: SparkSession, raw: DataFrame, kind: str, files_per_batch: int = 1000) -> DataFrame:
    """Land ``raw`` JSON records as files, stream them into a new archive, return its rows."""
    prepare(spark)
    root = fresh_dir(spark, "ingest")
    raw.select("raw").write.text(f"{root}/landing")
    create_archive(spark, f"{root}/archive")
    query = start_ingest(spark, f"{root}/landing", f"{root}/archive", kind, max_files=files_per_batch)
    query.awaitTermination()
    return current(spark, f"{root}/archive", kind)
