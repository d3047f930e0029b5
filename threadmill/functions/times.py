"""Time expressions. Records carry UTC seconds; text forms are always UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import nonempty, strip

# Seconds of 0001-01-01 and of the last second of 9999: the range ISO text can hold.
_MIN_EPOCH = -62135596800
_MAX_EPOCH = 253402300799

_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# Date, optional time (captured), optional offset (left out).
_ISO_TEXT = (
    r"(?U)^\s*([0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?)"
    r"([Zz]|[+-][0-9]{2}(:?[0-9]{2}){0,2})?\s*$"
)

# The date forms a job payload may use.
_JOB_DATE_FORMATS = ("d.M.yyyy", "yyyy-M-d", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'")


def epoch_seconds(text: Column) -> Column:
    """Whole seconds of a number or numeric text, cut toward zero; else null."""
    number = F.when(F.rlike(text, F.lit(_DECIMAL)), text).try_cast("double")
    return number.try_cast("bigint")


def in_iso_range(epoch: Column) -> Column:
    return F.when(epoch.between(_MIN_EPOCH, _MAX_EPOCH), epoch)


def iso_utc(epoch: Column) -> Column:
    """``2024-01-01T00:00:00+00:00``."""
    return F.date_format(F.timestamp_seconds(in_iso_range(epoch)), "yyyy-MM-dd'T'HH:mm:ssxxx")


def minute_label(epoch: Column) -> Column:
    """``2024-01-01 00:00``, or ``?`` when there is no time."""
    return F.coalesce(
        F.date_format(F.timestamp_seconds(in_iso_range(epoch)), "yyyy-MM-dd HH:mm"), F.lit("?")
    )


def wall_clock(iso_text: Column, epoch: Column | None = None) -> Column:
    """Timestamp of ISO text with its offset dropped, not applied; else of the epoch."""
    parsed = F.regexp_extract(iso_text, _ISO_TEXT, 1).try_cast("timestamp_ntz")
    if epoch is None:
        return parsed
    return F.coalesce(parsed, F.timestamp_seconds(in_iso_range(epoch)).cast("timestamp_ntz"))


def iso_wall_clock(moment: Column) -> Column:
    """ISO text without offset; the fraction only when there is one."""
    return F.regexp_replace(
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", ""
    )


def job_date_epoch(text: Column) -> Column:
    """Epoch of a job date in any accepted form; null when blank or not a date."""
    clean = nonempty(strip(text))
    parsed = F.coalesce(*[F.try_to_timestamp(clean, F.lit(f)) for f in _JOB_DATE_FORMATS])
    return F.unix_timestamp(parsed)

