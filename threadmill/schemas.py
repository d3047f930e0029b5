"""Column types of the archive tables and the fixed values of the record format."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values -----------------------------------------------------------------
# Field names, markers and labels below are part of the record format: results only
# agree with existing archives when they are exactly these.

DELETED_MARKERS = ("[deleted]", "[removed]")
POST_PREFIX = "t3_"
COMMENT_PREFIX = "t1_"
TEXT_SEPARATOR = " \n "
FLAG_REASON = "keyword-match"
UNKNOWN_TARGET = "unknown"
TARGET_TYPE = "subreddit"
PLATFORM = "REDDIT"
RESULT_CONTENT = "REDDIT_POSTS"
JOB_KEY_PREFIX = "reddit"
DEFAULT_WINDOW_DAYS = 365
PREVIEW_LINES = 40
PREVIEW_WIDTH = 70
SAMPLE_COMMENTS = 2000

POST_TIMELINE_COLUMNS = (
    "id", "subreddit", "author", "title", "selftext", "url", "permalink",
    "score", "num_comments", "created_utc", "created_epoch", "is_deleted", "over_18",
)
COMMENT_TIMELINE_COLUMNS = (
    "id", "post_id", "parent_id", "subreddit", "author", "body", "score", "depth",
    "created_utc", "created_epoch", "is_deleted",
)
FLAG_COLUMNS = ("flagged", "flag_reason", "matched_terms")
FLAGGED_POST_COLUMNS = (
    "id", "subreddit", "author", "title", "selftext", "score",
    "created_utc", "permalink", "matched_terms",
)
FLAGGED_COMMENT_COLUMNS = (
    "id", "post_id", "subreddit", "author", "body", "score",
    "depth", "created_utc", "matched_terms", "post_title",
)
JOB_FIELDS = (
    "target", "subreddits", "startDate", "endDate", "lastDays",
    "allWords", "anyWords", "noneWords", "exactPhrase", "language",
    "fetchPosts", "fetchComments", "backends", "backendSettings", "maxPages",
)
KNOWN_BACKENDS = ("arctic_shift", "pullpush", "reddit_api", "dump")
TRUE_WORDS = ("1", "true", "yes", "y", "on")
# --- end of fixed values ------------------------------------------------------------


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_FLAG_FIELDS = (
    ("flagged", BooleanType()),
    ("flag_reason", StringType()),
    ("matched_terms", ArrayType(StringType())),
)

POST = _struct(
    ("id", StringType()),
    ("subreddit", StringType()),
    ("author", StringType()),
    ("title", StringType()),
    ("selftext", StringType()),
    ("url", StringType()),
    ("permalink", StringType()),
    ("score", LongType()),
    ("num_comments", LongType()),
    ("created_utc", StringType()),
    ("created_epoch", LongType()),
    ("is_deleted", BooleanType()),
    ("over_18", BooleanType()),
    ("raw", StringType()),
    ("fetched_at", TimestampType()),
    ("updated_at", TimestampType()),
    *_FLAG_FIELDS,
)

COMMENT = _struct(
    ("id", StringType()),
    ("post_id", StringType()),
    ("parent_id", StringType()),
    ("subreddit", StringType()),
    ("author", StringType()),
    ("body", StringType()),
    ("score", LongType()),
    ("depth", IntegerType()),
    ("created_utc", StringType()),
    ("created_epoch", LongType()),
    ("is_deleted", BooleanType()),
    ("raw", StringType()),
    ("fetched_at", TimestampType()),
    ("updated_at", TimestampType()),
    *_FLAG_FIELDS,
)

SUBREDDIT = _struct(
    ("name", StringType()),
    ("first_seen_at", TimestampType()),
    ("raw", StringType()),
    ("updated_at", TimestampType()),
)

PROGRESS = _struct(
    ("subreddit", StringType()),
    ("backend", StringType()),
    ("kind", StringType()),
    ("window_start_epoch", LongType()),
    ("window_end_epoch", LongType()),
    ("cursor_epoch", LongType()),
    ("status", StringType()),
    ("items_fetched", LongType()),
)

TIMELINE = _struct(
    ("type", StringType()),
    *[
        (name, POST[name].dataType if name in POST.fieldNames() else COMMENT[name].dataType)
        for name in dict.fromkeys(
            POST_TIMELINE_COLUMNS + COMMENT_TIMELINE_COLUMNS + FLAG_COLUMNS
        )
    ],
)
