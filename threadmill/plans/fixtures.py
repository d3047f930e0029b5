"""The given tables seen as raw discussion records.

Documents become posts, conversation turns become comments, events become snapshots of
records that arrive again and again. Everything is derived in Spark from whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import in_iso_range
from ..operators.normalize import normalize_comments, normalize_posts
from ..session import prepare, spread

# 2024-01-01T00:00:00Z, the first second of the derived archive.
START = 1704067200
DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def posts_raw(spark: SparkSession, sf_dir: str, removed: bool = False) -> DataFrame:
    """Documents as raw posts, in columns, with the flaws raw records have.

    With ``removed`` every 23rd text is the marker of a removed post; else all texts are whole.
    """
    selftext = "CASE WHEN doc_id % 23 = 0 THEN '[removed]' ELSE text END" if removed else "text"
    return spread(table(spark, sf_dir, "documents")).selectExpr(
        "CASE WHEN doc_id % 47 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN concat('t3_', CAST(doc_id AS STRING)) ELSE CAST(doc_id AS STRING) END AS id",
        "CASE WHEN doc_id % 5 = 0 THEN concat(' ', upper(source)) ELSE source END AS subreddit",
        "CASE WHEN doc_id % 17 = 0 THEN '[deleted]' WHEN doc_id % 29 = 0 THEN '' ELSE concat('u', CAST(doc_id % 97 AS STRING)) END AS author",
        "substr(text, 1, 60) AS title",
        f"{selftext} AS selftext",
        "CASE WHEN doc_id % 47 = 0 THEN concat('t3_', CAST(doc_id AS STRING)) END AS name",
        "CASE WHEN doc_id % 6 > 0 THEN concat('https://example.org/', CAST(doc_id AS STRING)) END AS url",
        "concat('/r/', source, '/comments/', CAST(doc_id AS STRING)) AS permalink",
        "CASE WHEN doc_id % 43 = 0 THEN 'many' ELSE CAST(doc_id % 12 AS STRING) END AS num_comments",
        "CASE WHEN doc_id % 31 = 0 THEN '5.7' WHEN doc_id % 37 = 0 THEN NULL ELSE CAST(doc_id % 201 - 50 AS STRING) END AS score",
        f"CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN concat(CAST({START} + doc_id * 60 AS STRING), '.9') "
        f"ELSE CAST({START} + doc_id * 60 AS STRING) END AS created_utc",
        "doc_id % 11 = 0 AS over_18",
    )


def comments_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as raw comments, orphans and cycles included."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "concat('c', CAST(conv_id AS STRING), '_', CAST(turn AS STRING)) AS id",
        "concat('t3_', CAST(conv_id AS STRING)) AS link_id",
        "CASE WHEN conv_id % 19 = 7 AND turn = 0 THEN concat('t1_c', CAST(conv_id AS STRING), '_1') "
        "WHEN turn = 0 THEN concat('t3_', CAST(conv_id AS STRING)) "
        "WHEN conv_id % 13 = 5 AND turn = 2 THEN 't1_missing' "
        "WHEN turn % 4 = 3 THEN concat('t1_c', CAST(conv_id AS STRING), '_', CAST(turn - 2 AS STRING)) "
        "ELSE concat('t1_c', CAST(conv_id AS STRING), '_', CAST(turn - 1 AS STRING)) END AS parent_id",
        "concat('src', CAST(conv_id % 20 AS STRING)) AS subreddit",
        "CASE WHEN role = 'system' THEN '[deleted]' ELSE concat(role, CAST(conv_id % 10 AS STRING)) END AS author",
        "text AS body",
        "CAST(turn * 3 - conv_id % 5 AS STRING) AS score",
        f"CAST({START} + conv_id * 3600 + turn * 60 AS STRING) AS created_utc",
    )


def as_json(raw: DataFrame) -> DataFrame:
    """Raw records as the JSON text a provider would send."""
    return raw.select(F.to_json(F.struct(*raw.columns)).alias("raw"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_posts(posts_raw(spark, sf_dir))


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_comments(comments_raw(spark, sf_dir))


def comments_of_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments filed under the subreddit of the post they belong to, where it is known."""
    home = posts(spark, sf_dir).select(F.col("id").alias("post_id"), F.col("subreddit").alias("home"))
    rows = comments(spark, sf_dir)
    return rows.join(home, "post_id", "left").select(
        *[F.coalesce("home", "subreddit").alias(c) if c == "subreddit" else F.col(c) for c in rows.columns]
    )


def damaged_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as raw JSON comments, some without id, name or post."""
    return as_json(
        table(spark, sf_dir, "conversations").selectExpr(
            "CASE WHEN conv_id % 11 = 0 THEN '' ELSE concat('c', CAST(conv_id AS STRING), '_', CAST(turn AS STRING)) END AS id",
            "CASE WHEN conv_id % 22 = 0 THEN NULL ELSE concat('t1_c', CAST(conv_id AS STRING), '_', CAST(turn AS STRING)) END AS name",
            "CASE WHEN turn = 3 THEN NULL WHEN conv_id % 9 = 0 THEN '' ELSE concat('t3_', CAST(conv_id AS STRING)) END AS link_id",
            "concat('src', CAST(conv_id % 20 AS STRING)) AS subreddit",
            "text AS body",
        )
    )


def event_epoch() -> Column:
    return F.unix_timestamp(F.col("ts").cast("timestamp"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as repeated snapshots of one record per user, in arrival order."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("subreddit"),
        F.col("event_type").alias("kind"),
        F.col("event_id"),
        event_epoch().alias("created_epoch"),
        F.floor(F.col("value")).cast("bigint").alias("score"),
        F.col("props").alias("raw"),
        F.timestamp_seconds(in_iso_range(event_epoch())).alias("fetched_at"),
        F.timestamp_seconds(in_iso_range(event_epoch())).alias("updated_at"),
    )


def walk_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records of (subreddit, kind) walks."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("subreddit"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("posts"))
        .otherwise(F.lit("comments")).alias("kind"),
        F.col("event_type"),
        event_epoch().alias("created_epoch"),
    )


def job_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job payload per customer, covering good and bad forms of every field."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS job",
        """concat('[{"scraping_arg_id": ', CAST(c_custkey AS STRING), ', "scraping_arg": {',
          CASE c_custkey % 12
            WHEN 0 THEN concat('"target": "src', c_nationkey, '"')
            WHEN 1 THEN concat('"target": "r/Src', c_nationkey, '"')
            WHEN 2 THEN concat('"target": "/r/src', c_nationkey, '/"')
            WHEN 3 THEN concat('"target": "https://example.com/r/Src', c_nationkey, '/comments/abc"')
            WHEN 4 THEN concat('"target": "src', c_nationkey, ', SRC', c_nationkey + 1, ',,"')
            WHEN 5 THEN concat('"target": ["Src', c_nationkey, '", null, "r/src', c_nationkey + 2, '", "src', c_nationkey, '"]')
            WHEN 6 THEN '"target": null'
            WHEN 7 THEN '"target": "https://example.com/nothing"'
            WHEN 8 THEN '"target": "x"'
            WHEN 9 THEN '"target": ["src1", 5]'
            WHEN 10 THEN '"target": "  "'
            ELSE concat('"subreddits": "src', c_nationkey, '"') END,
          CASE c_custkey % 7
            WHEN 1 THEN ', "startDate": "01.01.2025", "endDate": "31.01.2025"'
            WHEN 2 THEN ', "startDate": "2024-01-02T03:04:05Z", "endDate": "2024-01-10"'
            WHEN 3 THEN ', "startDate": "01.01.2025"'
            WHEN 4 THEN ', "startDate": "31.01.2025", "endDate": "1.1.2025"'
            WHEN 5 THEN ', "startDate": "next spring", "endDate": "01.02.2025"'
            WHEN 6 THEN concat(', "lastDays": "', CASE c_custkey % 70 WHEN 6 THEN 30000 WHEN 13 THEN 3000000000 ELSE c_custkey % 5 END, '"')
            ELSE '' END,
          CASE c_custkey % 3
            WHEN 0 THEN ', "allWords": "blue  red blue", "anyWords": [" green grey", "red", 7]'
            WHEN 1 THEN ', "noneWords": ["Rain"], "exactPhrase": "  open   water "'
            ELSE ', "exactPhrase": "  "' END,
          CASE c_custkey % 4
            WHEN 0 THEN ', "fetchPosts": true, "fetchComments": 0'
            WHEN 1 THEN ', "fetchPosts": " YES ", "fetchComments": "off"'
            WHEN 2 THEN ', "maxPages": 3, "backends": "pullpush, arctic_shift,pullpush"'
            ELSE ', "language": "ro", "oops": 1, "lastdays": 2' END,
          CASE WHEN c_custkey % 13 = 0 THEN ', "backends": ["nope"]' ELSE '' END,
          '}}]') AS payload""",
    )


def nation_jobs(spark: SparkSession, sf_dir: str, pages: bool = False) -> DataFrame:
    """One search job per nation, to be matched against the derived archive.

    With ``pages`` every second job asks for its first one to three pages only.
    """
    paged = "CASE WHEN n_nationkey % 2 = 0 THEN concat(', \"maxPages\": ', n_nationkey % 3 + 1) ELSE '' END," if pages else ""
    return table(spark, sf_dir, "nation").selectExpr(
        f"""concat('{{"scraping_arg_id": "n', CAST(n_nationkey AS STRING), '", "scraping_arg": {{"target": ["src',
           n_nationkey % 20, '", "src', (n_nationkey + 7) % 20, '"]',
           CASE n_nationkey % 3
             WHEN 0 THEN ', "startDate": "01.01.2024", "endDate": "05.01.2024"'
             WHEN 1 THEN ', "startDate": "2024-01-01", "endDate": "2024-12-31"'
             ELSE ', "lastDays": 20' END,
           CASE n_nationkey % 5
             WHEN 0 THEN ', "anyWords": "the und"'
             WHEN 1 THEN ', "allWords": ["of", "The"], "noneWords": "und"'
             WHEN 2 THEN ', "exactPhrase": "Of  the"'
             WHEN 3 THEN ', "noneWords": ["the", "è"]'
             ELSE '' END,
           CASE WHEN n_nationkey % 4 = 3 THEN ', "fetchComments": false' ELSE '' END,
           {paged} '}}}}') AS payload"""
    )


# Words that customers' jobs ask for; some are common in the given texts, some are not there.
JOB_WORDS = ["the", "of", "and", "und", "die", "le", "de", "la", "et", "que", "for", "that", "this", "nicht", "ein", "zu", "été", "è", "quixotic", "zebra"]


def customer_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search job per customer: many jobs that share few words."""
    word = f"element_at(array({', '.join(repr(w) for w in JOB_WORDS)}), CAST(%s AS INT) %% {len(JOB_WORDS)} + 1)"
    return table(spark, sf_dir, "customer").selectExpr(
        f"""concat('{{"scraping_arg_id": "c', c_custkey, '", "scraping_arg": {{"target": ["src', c_custkey % 20, '"],
           "startDate": "2024-01-0', c_custkey % 9 + 1, '", "endDate": "2024-01-1', c_custkey % 10, '"',
           CASE WHEN c_custkey % 4 < 2 THEN concat(', "allWords": ["', {word % 'c_custkey'}, '", "', upper({word % '(c_custkey + 1)'}), '"]') ELSE '' END,
           CASE WHEN c_custkey % 3 = 0 THEN concat(', "anyWords": ["', {word % '(c_custkey * 7)'}, '", "', {word % '(c_custkey * 3 + 5)'}, '"]') ELSE '' END,
           CASE WHEN c_custkey % 5 = 1 THEN concat(', "noneWords": ["', {word % '(c_custkey * 11 + 2)'}, '"]') ELSE '' END,
           CASE WHEN c_custkey % 7 = 0 THEN ', "maxPages": 2' ELSE '' END, '}}}}') AS payload"""
    )


# "Now" of the jobs above: 2024-01-25T00:00:00Z.
JOBS_NOW = START + 24 * DAY
