"""Best-effort timestamp parsing, UTC, millisecond precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings besides ISO 8601. Key: shape, value: Spark pattern.
SHAPES = {
    r"^\d{1,2}/\d{1,2}/\d{4}": "d/M/yyyy[ H:mm[:ss[.SSS]]]",
    r"^\d{1,2}-\d{1,2}-\d{4}": "d-M-yyyy[ H:mm[:ss[.SSS]]]",
    r"^\d{1,2}\.\d{1,2}\.\d{4}": "d.M.yyyy[ H:mm[:ss[.SSS]]]",
    r"^\d{4}/\d{1,2}/\d{1,2}": "yyyy/M/d[ H:mm[:ss[.SSS]]]",
    r"^\d{14}$": "yyyyMMddHHmmss",
    r"^\d{8}$": "yyyyMMdd",
    r"^\d{1,2} [A-Za-z]{3} \d{4} .* [A-Z]{3}$": "d MMM yyyy HH:mm:ss zzz",
    r"^\d{1,2} [A-Za-z]{3} \d{4}": "d MMM yyyy[ HH:mm:ss]",
}


def to_millis(moment: Column) -> Column:
    """Cut below the millisecond, before any DISTINCT sees the value."""
    return F.date_trunc("MILLISECOND", moment)


def parse_best_effort(text: Column) -> Column:
    """Timestamp of the years 1 to 9999 UTC, or NULL when no spelling fits.

    ISO 8601 has its first dash in fifth place. That is tested first and without a
    pattern match, so ordinary rows cost one cast and never reach the other spellings.
    """
    trimmed = F.trim(text)
    iso = F.when(F.substring(trimmed, 5, 1) == "-", F.try_to_timestamp(trimmed))
    unnamed_day = F.regexp_replace(trimmed, "^[A-Za-z]{3}, ", "")
    # Only digits of these lengths are epochs: seconds, milliseconds, microseconds.
    digits = trimmed.try_cast("bigint")
    other = (
        F.when(trimmed.rlike(r"^\d{9,10}$"), F.timestamp_seconds(digits))
        .when(trimmed.rlike(r"^\d{13}$"), F.timestamp_millis(digits))
        .when(trimmed.rlike(r"^\d{16}$"), F.timestamp_micros(digits))
    )
    for shape, pattern in SHAPES.items():
        other = other.when(unnamed_day.rlike(shape), F.try_to_timestamp(unnamed_day, F.lit(pattern)))
    moment = to_millis(F.coalesce(iso, other))
    # What no calendar date can hold in UTC would end every later step that lists days.
    return F.when(F.year(moment).between(1, 9999), moment)


def load_moment() -> Column:
    return to_millis(F.current_timestamp())
