from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted shapes: a date; a date and time joined by "T", with an optional "Z" and, before the "Z",
# an optional fraction of one to six digits; a date and time joined by white space. One- or two-digit
# fields are fine, the year has four digits. Field ranges are checked by the cast.
_MONTH = r"\d{4}-\d{1,2}-"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_AFTER_T = rf"T{_CLOCK}(?:(?:\.\d{{1,6}})?Z)?"
FEED_TIME = rf"^{_MONTH}\d{{1,2}}(?:{_AFTER_T}| {_CLOCK})?$"
# The same with more white space before the time, or a day padded with a space; rare, so apart.
SPACED_TIME = rf"^{_MONTH}(?: \d|\d{{1,2}})(?:{_AFTER_T}|\s+{_CLOCK})?$"

# A complete time with an offset, the only kind the JSON feeds compare with a checkpoint.
OFFSET_TIME = (
    r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)$"
)


def parse_timestamp(text: Column) -> Column:
    """Feed time text to a UTC instant; null when no accepted shape fits."""
    single = F.regexp_replace(F.replace(text, F.lit("- "), F.lit("-")), r"\s+", " ")
    return F.when(text.rlike(FEED_TIME), text.try_cast("timestamp")).when(
        text.rlike(SPACED_TIME), single.try_cast("timestamp")
    )


def unix_seconds(number: Column) -> Column:
    """Unix seconds (integer or fractional, numeric column) to a UTC instant."""
    return F.timestamp_micros(F.round(number.cast("double") * 1_000_000).cast("long"))


def has_offset_time(text: Column) -> Column:
    """The instant of a time text that carries an offset, else null."""
    return F.when(text.rlike(OFFSET_TIME), text.try_cast("timestamp"))


def duration_seconds(started: Column, completed: Column) -> Column:
    return (F.unix_micros(completed) - F.unix_micros(started)) / F.lit(1_000_000.0)
