"""Calendar parts and fractional-day differences of timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000

# Suffix of each part and how Spark derives it (weekday: Monday = 0).
PARTS = {
    "month": F.month,
    "year": F.year,
    "day": F.dayofmonth,
    "weekday": F.weekday,
}


def days_between(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in fractional days; null when either side is null."""
    return micros(_column(end) - _column(start)) / F.lit(float(MICROS_PER_DAY))


def micros(gap: Column) -> Column:
    """Microseconds of a difference of two time stamps without zone, whatever the session's zone is."""
    seconds = F.extract(F.lit("SECOND"), gap) * 1_000_000
    minutes = (F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)) * 60 + F.extract(F.lit("MINUTE"), gap)
    return minutes.cast("bigint") * 60_000_000 + seconds.cast("bigint")


def date_part_names(columns: list[str]) -> list[str]:
    return [f"{column}_{part}" for column in columns for part in PARTS]


def date_parts(columns: list[str]) -> dict[str, Column]:
    """Month, year, day of month and weekday of every column, keyed by output name."""
    return {
        f"{column}_{part}": derive(F.col(column)).cast("bigint")
        for column in columns
        for part, derive in PARTS.items()
    }


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
