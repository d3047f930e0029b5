"""Keyed upserts: last write wins, first-seen and annotation columns stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import FLAG_COLUMNS

RECORD_KEY = ("subreddit", "id")


def latest(df: DataFrame, keys: list[str], arrival: list[Column]) -> DataFrame:
    """The last row to arrive for each key.

    ``max_by`` reduces each input partition to one row per key before the shuffle, so a
    key that was re-sent very often costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*arrival)).alias("_last")
    return df.groupBy(*keys).agg(last).select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns]
    )


def first_seen(df: DataFrame, keys: list[str], stamp: str, arrival: list[Column]) -> DataFrame:
    """The stamp each key came with at its first arrival."""
    known = F.col(stamp).isNotNull()
    first = F.min_by(F.when(known, F.col(stamp)), F.when(known, F.struct(*arrival)))
    return df.groupBy(*keys).agg(first.alias(stamp))


def fold_versions(
    versions: DataFrame, arrival: list[Column], keys: tuple[str, ...] = RECORD_KEY
) -> DataFrame:
    """Collapse all stored versions of each record into its current row.

    Columns come from the last version, ``fetched_at`` from the first, annotations from the
    last version that has any. One shuffle, on the record key.
    """
    order = F.struct(*arrival)
    flags = [c for c in FLAG_COLUMNS if c in versions.columns]
    kept = [c for c in versions.columns if c not in keys and c not in flags and c != "fetched_at"]
    aggregates = [F.max_by(F.struct(*kept), order).alias("_last")]
    if "fetched_at" in versions.columns:
        known = F.col("fetched_at").isNotNull()
        aggregates.append(
            F.min_by(F.when(known, F.col("fetched_at")), F.when(known, order)).alias("fetched_at")
        )
    if flags:
        noted = F.col(flags[0]).isNotNull()
        aggregates.append(
            F.max_by(F.when(noted, F.struct(*flags)), F.when(noted, order)).alias("_flags")
        )
    folded = versions.groupBy(*keys).agg(*aggregates)

    def column(name: str) -> Column:
        if name in keys or name == "fetched_at":
            return F.col(name)
        return F.col(f"_flags.{name}" if name in flags else f"_last.{name}").alias(name)

    return folded.select(*[column(c) for c in versions.columns])


def _merged_columns(columns: list[str], keys: tuple[str, ...]) -> list[Column]:
    """Column rules where old row ``o`` and new row ``n`` share a key; either may be absent."""
    is_new = F.col("n._new").isNotNull()
    out = []
    for name in columns:
        old, new = F.col(f"o.{name}"), F.col(f"n.{name}")
        if name in keys:
            value = F.coalesce(new, old)
        elif name == "fetched_at":
            value = F.coalesce(old, new)
        elif name in FLAG_COLUMNS:
            value = F.when(F.col("o.flagged").isNotNull(), old).otherwise(new)
        else:
            value = F.when(is_new, new).otherwise(old)
        out.append(value.alias(name))
    return out


def merge_upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...] = RECORD_KEY) -> DataFrame:
    """Upsert ``new`` into ``old``; both must be unique on the key (see :func:`latest`)."""
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    return o.join(n, on, "full_outer").select(*_merged_columns(old.columns, keys))


def merge_small_batch(
    old: DataFrame, new: DataFrame, keys: tuple[str, ...] = RECORD_KEY
) -> DataFrame:
    """:func:`merge_upsert` for a batch that is small beside the table.

    A full outer join must shuffle the whole table. Written as left join plus anti join,
    Spark may broadcast the batch when its own size check allows, and then the table is only
    streamed through; otherwise it falls back to shuffled joins with the same result.
    """
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    kept = o.join(n, on, "left").select(*_merged_columns(old.columns, keys))
    # Only keys of the batch can be here, so this side is never larger than the batch.
    hit = old.select(*keys).join(new.select(*keys), list(keys), "left_semi")
    added = new.join(hit, list(keys), "left_anti").select(*old.columns)
    return kept.unionByName(added)


def refresh_existing(
    old: DataFrame, fresh: DataFrame, columns: list[str], keys: tuple[str, ...] = RECORD_KEY
) -> DataFrame:
    """Take newer values of ``columns`` for known keys; unknown keys are not added."""
    n = fresh.select(*keys, *columns).withColumn("_new", F.lit(True)).alias("n")
    o = old.alias("o")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    hit = F.col("n._new").isNotNull()
    return o.join(n, on, "left").select(
        *[
            F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
            if c in columns
            else F.col(f"o.{c}").alias(c)
            for c in old.columns
        ]
    )


def upsert_subreddits(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keep ``first_seen_at``, keep ``raw`` when the new one is null, move ``updated_at``."""
    o, n = old.alias("o"), new.alias("n")
    return o.join(n, F.col("o.name") == F.col("n.name"), "full_outer").select(
        F.coalesce("n.name", "o.name").alias("name"),
        F.coalesce("o.first_seen_at", "n.first_seen_at").alias("first_seen_at"),
        F.coalesce("n.raw", "o.raw").alias("raw"),
        F.coalesce("n.updated_at", "o.updated_at").alias("updated_at"),
    )


def subreddit_rows(names: DataFrame, batch_time) -> DataFrame:
    """New subreddit rows of a batch from a ``name`` column (and ``raw`` when there is one).

    The last ``raw`` that is not null counts: the one with the greatest ``arrival`` (any
    orderable column); batches without that column may only name each subreddit once.
    """
    stamp = F.lit(batch_time)
    raw = F.lit(None).cast("string")
    if "raw" in names.columns:
        # Of equal arrivals the greatest text, so that runs repeat exactly.
        order = F.struct(*[c for c in ("arrival", "raw") if c in names.columns])
        raw = F.max_by("raw", F.when(F.col("raw").isNotNull(), order))
    clean = names.withColumn("name", F.lower(F.regexp_replace("name", r"(?U)^\s+|\s+$", "")))
    return clean.groupBy("name").agg(raw.alias("raw")).select(
        "name", stamp.alias("first_seen_at"), "raw", stamp.alias("updated_at")
    )
