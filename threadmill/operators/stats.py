"""Per-target statistics of exported records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import nonempty, target_key
from ..functions.times import iso_wall_clock, wall_clock
from ..schemas import PLATFORM, RESULT_CONTENT, TARGET_TYPE, UNKNOWN_TARGET


def record_time() -> Column:
    """Creation time from ISO text, else from the epoch."""
    return wall_clock(F.col("created_utc"), F.col("created_epoch"))


def target_stats(records: DataFrame, targets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Record count and oldest date of each target; targets without records count 0.

    ``targets`` has a ``target`` column. Records of a subreddit nobody listed are reported
    under the name they carry. With ``by`` (such as ``job_id``) both sides are split by it.
    """
    split = by or []
    counted = (
        records.select(
            *split,
            F.coalesce(nonempty(F.col("subreddit")), F.lit("")).alias("name"),
            record_time().alias("at"),
        )
        .groupBy(*split, "name")
        .agg(F.count("*").alias("n"), F.min("at").alias("oldest"))
        .withColumn("key", target_key(F.col("name")))
    )
    # Two listed forms of one name: the one listed last takes the records.
    place = [F.col("position")] if "position" in targets.columns else [F.col("target")]
    listed = targets.withColumn("key", target_key(F.col("target")))
    owner = listed.groupBy(*split, "key").agg(F.max_by("target", F.struct(*place)).alias("owner"))
    owned = counted.join(owner, [*split, "key"], "left").select(
        *split,
        F.coalesce("owner", nonempty(F.col("name")), F.lit(UNKNOWN_TARGET)).alias("target"),
        "n", "oldest",
    )
    silent = listed.select(
        *split, "target", F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("timestamp_ntz").alias("oldest"),
    )
    return (
        owned.unionByName(silent)
        .groupBy(*split, "target")
        .agg(F.sum("n").alias("records"), F.min("oldest").alias("oldest"))
        .select(
            *split, "target", F.lit(TARGET_TYPE).alias("target_type"), "records",
            iso_wall_clock(F.col("oldest")).alias("oldest_post_date"),
        )
    )


def stats_payload(stats: DataFrame, container_id: str, job: str = "job_id") -> DataFrame:
    """One JSON report per job and target."""
    body = F.struct(
        F.lit(container_id).alias("container_entity_id"),
        F.col(job).alias("scraping_arg_id"),
        F.lit(PLATFORM).alias("platform"),
        F.lit(RESULT_CONTENT).alias("scraping_content"),
        "target", "target_type", "records", "oldest_post_date",
    )
    return stats.select(job, "target", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


def result_payload(records: DataFrame, container_id: str, source: Column, job: str = "job_id") -> DataFrame:
    """One JSON row per record, wrapped like a result report.

    The records of a job stay separate rows: one array for a whole job has no size bound.
    """
    detail = F.struct(*[c for c in records.columns if c != job])
    result = F.struct(
        F.lit(container_id).alias("container_entity_id"),
        F.lit(RESULT_CONTENT).alias("scraping_content"),
        source.alias("source"),
        F.array(detail).alias("post_details"),
    )
    body = F.struct(F.lit(container_id).alias("source_id"), result.alias("result"))
    return records.select(job, F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))
