"""Writers. Hot subreddits and jobs are range-split over tasks, never written by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.flagging import report_order
from ..operators.threads import NESTED_ORDER, nested_fragments, with_depth
from ..operators.timeline import chronological
from ..operators.versions import latest
from ..functions.text import list_cell, partition_name
from ..schemas import TIMELINE
from ..session import materialize


def write_archive(df: DataFrame, path: str) -> None:
    """Replace the subreddit partitions that ``df`` holds, and no others.

    Ranging by (subreddit, time, id) splits a hot subreddit over many tasks and lays its
    files out in time order, so that window filters skip most of them.
    """
    order = ["folder", "created_epoch", "id"]
    (
        df.withColumn("folder", partition_name(F.col("subreddit")))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("folder")
        .parquet(path)
    )


def append_lines(df: DataFrame, path: str) -> None:
    """Cheap append of records as JSON lines; duplicates are settled by compaction."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def compact_lines(
    spark: SparkSession, lines: str, schema, arrival: list, out: str, nested: str | None = None
) -> None:
    """Rewrite appended lines as current records; comments get depths and nested documents."""
    rows = latest(spark.read.schema(schema).json(lines), ["subreddit", "id"], arrival)
    if "parent_id" in rows.columns:
        rows = with_depth(rows)
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(out)
    if nested is not None:
        write_nested(spark.read.schema(rows.schema).json(out), nested)


def write_nested(comments: DataFrame, path: str) -> None:
    """Nested thread documents per subreddit as text: files and lines in order, one root after
    another; the lines of a root join to one JSON document."""
    (
        # Range sorting looks at its input twice.
        materialize(nested_fragments(comments), "nested")
        .repartitionByRange(*NESTED_ORDER)
        .sortWithinPartitions(*NESTED_ORDER)
        .select("subreddit", "fragment")
        .write.mode("overwrite")
        .partitionBy("subreddit")
        .text(path)
    )


def write_merged(records: DataFrame, path: str, by: str = "subreddit") -> None:
    """The timeline of each subreddit (or folder) as JSON lines in chronological order."""
    order = [F.col("_part"), *chronological()]
    (
        records.withColumn("_part", F.col(by))
        # A folder or job is the place of its records, not one of their fields.
        .drop(*{by} - set(TIMELINE.fieldNames()))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .partitionBy("_part")
        .json(path)
    )


def write_job_results(records: DataFrame, path: str) -> None:
    """Results per job. ``_SUCCESS`` appears last and marks the output as complete."""
    write_merged(records, path, by="job_id")


def read_job_results(spark: SparkSession, path: str) -> DataFrame:
    """The written results again, for reporting, with their ``job_id``."""
    schema = StructType([*TIMELINE.fields, StructField("_part", StringType())])
    return spark.read.schema(schema).json(path).withColumnRenamed("_part", "job_id")


def write_report(posts: DataFrame, comments: DataFrame, path: str) -> None:
    """The flagged report as two CSV tables, sorted; an empty table has its header only."""
    for name, rows in (("flagged_posts", posts), ("flagged_comments", comments)):
        (
            rows.orderBy(*report_order())
            .withColumn("matched_terms", list_cell(F.col("matched_terms")))
            .write.mode("overwrite")
            .option("header", "true")
            .option("escape", '"')
            .csv(f"{path}/{name}")
        )


def write_payloads(payloads: DataFrame, path: str, job: str = "job_id") -> None:
    """JSON report rows, one folder per job."""
    payloads.select(job, "payload").write.mode("overwrite").partitionBy(job).text(path)
