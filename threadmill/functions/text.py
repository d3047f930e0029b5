"""Text expressions with the archive's exact blank, case and cut rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..schemas import COMMENT_PREFIX, DELETED_MARKERS, PREVIEW_WIDTH, TEXT_SEPARATOR


def nonempty(text: Column) -> Column:
    """Null for the empty string."""
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Trim every Unicode blank; Spark's own ``trim`` only removes spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def joined_text(*parts: Column) -> Column:
    """The parts that hold text, joined into the one text that clauses look at."""
    return F.concat_ws(TEXT_SEPARATOR, *[nonempty(p) for p in parts])


def strip_type_prefix(thing_id: Column) -> Column:
    """``t3_abc`` -> ``abc``; anything not shaped like ``t?_x`` stays as it is."""
    return F.when(F.like(thing_id, F.lit(r"t_\__%")), F.substr(thing_id, F.lit(4))).otherwise(
        nonempty(thing_id)
    )


def parent_comment_id(parent_id: Column) -> Column:
    """Id of the parent comment, or null when the parent is the post."""
    return F.when(
        F.startswith(parent_id, F.lit(COMMENT_PREFIX)),
        nonempty(F.substr(parent_id, F.lit(len(COMMENT_PREFIX) + 1))),
    )


def clean_author(author: Column) -> Column:
    return F.when(~author.isin(*DELETED_MARKERS, ""), author)


def is_marker(text: Column) -> Column:
    return F.coalesce(text.isin(*DELETED_MARKERS), F.lit(False))


def canonical_subreddit(name: Column, fallback: Column | None = None) -> Column:
    """Lowercased, stripped name; the fallback only replaces a missing or empty one."""
    known = nonempty(name) if fallback is None else F.coalesce(nonempty(name), fallback)
    return F.lower(strip(known))


def partition_name(name: Column) -> Column:
    """Name that is safe as a folder."""
    cleaned = F.regexp_replace(F.lower(strip(name)), r"[^a-z0-9_]+", "_")
    return F.when(cleaned == "", F.lit("_")).otherwise(cleaned)


def target_key(name: Column) -> Column:
    """Fold ``r/Name``, ``/r/name`` and ``name`` together for comparing targets."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(strip(name)), r"^/+", ""), r"^r/", ""
    )


def list_cell(values: Column) -> Column:
    """A list as one report cell."""
    return F.array_join(values, ", ")


def preview_line(depth: Column, author: Column, body: Column) -> Column:
    """One indented line of a thread preview."""
    flat = F.replace(F.coalesce(body, F.lit("")), F.lit("\n"), F.lit(" "))
    short = F.when(
        F.length(flat) > PREVIEW_WIDTH,
        F.concat(F.substr(flat, F.lit(1), F.lit(PREVIEW_WIDTH - 3)), F.lit("...")),
    ).otherwise(flat)
    who = F.coalesce(nonempty(author), F.lit(DELETED_MARKERS[0]))
    return F.concat(
        F.repeat(F.lit("  "), depth),
        F.lit("- ("), who, F.lit(") "), short,
    )


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
