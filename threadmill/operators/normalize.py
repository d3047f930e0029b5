"""Raw provider records -> typed posts and comments."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.fields import ColumnFields, TakenFields
from ..functions.times import iso_utc
from ..schemas import COMMENT, POST


def _own_id(fields) -> Column:
    return T.strip_type_prefix(F.coalesce(T.nonempty(fields.text("id")), fields.text("name")))


def _subreddit(fields, fallback: Column | None) -> Column:
    return F.coalesce(T.canonical_subreddit(fields.text("subreddit"), fallback), F.lit(""))


def _post_columns(fields, raw: Column, fallback: Column | None) -> list[Column]:
    author = T.clean_author(fields.text("author"))
    selftext = fields.text("selftext")
    epoch = fields.epoch("created_utc")
    return [
        _own_id(fields).alias("id"),
        _subreddit(fields, fallback).alias("subreddit"),
        author.alias("author"),
        fields.text("title").alias("title"),
        selftext.alias("selftext"),
        fields.text("url").alias("url"),
        fields.text("permalink").alias("permalink"),
        fields.whole("score").alias("score"),
        fields.whole("num_comments").alias("num_comments"),
        iso_utc(epoch).alias("created_utc"),
        epoch.alias("created_epoch"),
        (author.isNull() | T.is_marker(selftext)).alias("is_deleted"),
        fields.flag("over_18").alias("over_18"),
        raw.alias("raw"),
    ]


def _comment_columns(fields, raw: Column, fallback: Column | None) -> list[Column]:
    author = T.clean_author(fields.text("author"))
    body = fields.text("body")
    epoch = fields.epoch("created_utc")
    return [
        _own_id(fields).alias("id"),
        T.strip_type_prefix(fields.text("link_id")).alias("post_id"),
        fields.text("parent_id").alias("parent_id"),
        _subreddit(fields, fallback).alias("subreddit"),
        author.alias("author"),
        body.alias("body"),
        fields.whole("score").alias("score"),
        iso_utc(epoch).alias("created_utc"),
        epoch.alias("created_epoch"),
        (author.isNull() | T.is_marker(body)).alias("is_deleted"),
        raw.alias("raw"),
    ]


def _project(
    df: DataFrame, columns, raw: str | None, fallback: Column | None, keep: list[str] | None
) -> DataFrame:
    keep = keep or []
    if raw is None:
        whole_row = F.to_json(F.struct(*[c for c in df.columns if c not in keep]))
        return df.select(*columns(ColumnFields(df), whole_row, fallback), *keep)
    known = [] if fallback is None else [fallback.alias("_fallback")]
    # Exploding the one parsed record keeps filters on its fields above the parser; pushed
    # below it, they would parse every record a second time.
    parsed = df.select(
        F.col(raw).alias("_raw"), F.explode(F.array(F.try_parse_json(raw))).alias("_record"),
        *known, *keep,
    )
    spare = F.col("_fallback") if known else None
    # Its fields are held the same way: copied into every column and filter that uses them, they
    # make one step so long that the JVM never compiles it.
    fields = TakenFields(F.col("_record"), "_fields")
    wanted = columns(fields, F.col("_raw"), spare)
    held = parsed.select("_raw", F.explode(F.array(fields.struct())).alias("_fields"), *(["_fallback"] if known else []), *keep)
    return held.select(*wanted, *keep)


def project_posts(
    df: DataFrame, raw: str | None = None, fallback: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every input record as a post row, also those that have no id."""
    return _project(df, _post_columns, raw, fallback, keep)


def project_comments(
    df: DataFrame, raw: str | None = None, fallback: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every input record as a comment row, also those without id or post."""
    return _project(df, _comment_columns, raw, fallback, keep)


def has_identity(df: DataFrame) -> Column:
    """A record counts only with an id, and a comment only with its post."""
    present = F.col("id").isNotNull()
    return present & F.col("post_id").isNotNull() if "post_id" in df.columns else present


def normalize_posts(
    df: DataFrame, raw: str | None = None, fallback: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Typed posts. ``raw`` names the JSON text column; without it the dump is columnar.

    ``fallback`` is the subreddit of records that name none; ``keep`` columns pass through.
    """
    rows = project_posts(df, raw, fallback, keep)
    return rows.filter(has_identity(rows))


def normalize_comments(
    df: DataFrame, raw: str | None = None, fallback: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Typed comments; ``parent_id`` keeps its prefix, which tells posts from comments."""
    rows = project_comments(df, raw, fallback, keep)
    return rows.filter(has_identity(rows))


def rejected(rows: DataFrame) -> DataFrame:
    """Projected rows that :func:`has_identity` turns down, for counting or quarantine."""
    return rows.filter(~has_identity(rows))


def storage_rows(
    df: DataFrame, batch_time: datetime | Column, keep: list[str] | None = None
) -> DataFrame:
    """Rows in table form: one time stamp for the whole batch, annotations still unset."""
    schema = COMMENT if "post_id" in df.columns else POST
    stamp = batch_time if isinstance(batch_time, Column) else F.lit(batch_time)
    own = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name in own:
            value = F.col(field.name)
        elif field.name in ("fetched_at", "updated_at"):
            value = stamp
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns, *(keep or []))
