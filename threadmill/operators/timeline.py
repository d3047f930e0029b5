"""Posts and comments as one typed chronological stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import COMMENT_TIMELINE_COLUMNS, FLAG_COLUMNS, POST_TIMELINE_COLUMNS, TIMELINE


def _typed(df: DataFrame, kind: str, columns: tuple[str, ...], extra: list[str]) -> DataFrame:
    own = set(df.columns)
    wanted = set(columns) | set(FLAG_COLUMNS)
    return df.select(
        *extra,
        F.lit(kind).alias("type"),
        *[
            (F.col(f.name) if f.name in own and f.name in wanted else F.lit(None))
            .cast(f.dataType).alias(f.name)
            for f in TIMELINE.fields
            if f.name != "type"
        ],
    )


def timeline_rows(posts: DataFrame, comments: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Both kinds under one schema; fields a kind does not have are null, ``raw`` is left out."""
    keep = extra or []
    return _typed(posts, "post", POST_TIMELINE_COLUMNS, keep).unionByName(
        _typed(comments, "comment", COMMENT_TIMELINE_COLUMNS, keep)
    )


def chronological() -> list[Column]:
    """Sort order of a timeline: time (none counts as 0), id, posts before comments."""
    return [
        F.coalesce("created_epoch", F.lit(0)).asc(),
        F.coalesce("id", F.lit("")).asc(),
        F.desc("type"),
    ]


def timeline(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One globally sorted timeline, range-partitioned by Spark's sort."""
    return timeline_rows(posts, comments).orderBy(*chronological())


def _kind_counts() -> list[Column]:
    kind = F.col("type")
    return [
        F.count_if(kind == "post").alias("post"),
        F.count_if(kind == "comment").alias("comment"),
    ]


def count_by_type(records: DataFrame) -> DataFrame:
    """One row: posts and comments, zero when there are none; other types are not counted."""
    return records.agg(*_kind_counts())


def count_by_folder(records: DataFrame, folder: str = "subreddit") -> DataFrame:
    """Posts, comments and their sum per folder."""
    return records.groupBy(folder).agg(*_kind_counts()).withColumn(
        "records", F.col("post") + F.col("comment")
    )
