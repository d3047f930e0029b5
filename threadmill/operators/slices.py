"""Which records to look at: time window, subreddits, first pages, samples."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window, functions as F


def in_window(df: DataFrame, after: int, before: int) -> DataFrame:
    """Records of [after, before); a plain range on a column, so Parquet can skip by it."""
    return df.filter((F.col("created_epoch") >= after) & (F.col("created_epoch") < before))


def of_subreddits(df: DataFrame, names: list[str]) -> DataFrame:
    """Records of the named subreddits; of a written archive only their folders are read."""
    wanted = [n.strip().lower() for n in names]
    if "folder" in df.columns:
        folders = {re.sub("[^a-z0-9_]+", "_", n) or "_" for n in wanted}
        df = df.filter(F.col("folder").isin(sorted(folders)))
    return df.filter(F.col("subreddit").isin(wanted))


def search(
    df: DataFrame, subreddits: list[str], after: int, before: int, cursor: int | None = None
) -> DataFrame:
    """Slice of an archive table, from the cursor on when there is one."""
    return in_window(of_subreddits(df, subreddits), after if cursor is None else cursor, before)


# A subreddit is cut into this many parts before its first rows are picked.
PARTS = 64


def first_pages(df: DataFrame, pages: int, page_size: int, by: list[str] | None = None) -> DataFrame:
    """The first ``pages`` pages per subreddit (and kind), in ascending time order.

    Up to its window group limit, Spark keeps no more rows than asked for per group and input
    partition before the shuffle. For a larger limit the rows are first picked from parts of
    each group, so a huge subreddit never goes through one task as a whole.
    """
    keys, limit = by or ["subreddit"], pages * page_size
    if limit >= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
        df = _first_rows(df.withColumn("_part", part), [*keys, "_part"], limit).drop("_part")
    return _first_rows(df, keys, limit)


def _first_rows(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.coalesce("created_epoch", F.lit(0)), "id")
    ranked = df.withColumn("_place", F.row_number().over(order))
    return ranked.filter(F.col("_place") <= limit).drop("_place")


def dry_run_slice(
    df: DataFrame, subreddits: list[str], now: int, last_days: int = 3, pages: int = 2,
    page_size: int = 100,
) -> DataFrame:
    """A small slice to try things out: first subreddit, last days, first pages."""
    return first_pages(
        search(df, subreddits[:1], now - last_days * 86400, now), pages, page_size
    )
