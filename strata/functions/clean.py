"""Column expressions for cleaning semi-structured input. Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(column: str) -> Column:
    """``'12.5%'`` to 12.5."""
    return F.replace(F.col(column), F.lit("%"), F.lit("")).try_cast("float")


def year_of_month_text(column: str) -> Column:
    """``'Jan-1998'`` to 1998.0."""
    return F.substring(column, 5, 4).try_cast("double")


def employment_years(column: str) -> Column:
    """``'10+ years'`` to 10, ``'< 1 year'`` to 0, ``'n/a'`` to null."""
    text = F.trim(F.col(column))
    return F.when(text.startswith("<"), F.lit("0")).otherwise(F.regexp_extract(text, r"^(\d+)", 1)).try_cast("float")


def verified_status(column: str) -> Column:
    """Source-verified counts as verified."""
    return F.trim(F.replace(F.col(column), F.lit("Source Verified"), F.lit("Verified")))


def engagement(column: str) -> Column:
    """Tier of an activity count; an unknown count falls into the last tier."""
    # Tier bounds.
    n = F.col(column)
    return F.when(n <= 2, "LOW").when(n <= 10, "MEDIUM").otherwise("HIGH")


def fahrenheit(kelvin: Column) -> Column:
    return (kelvin - 273.15) * 9 / 5 + 32


def magnitude(*axes: Column) -> Column:
    """Rounded length of a vector."""
    return F.round(F.sqrt(sum((a * a for a in axes[1:]), axes[0] * axes[0])))


def hour_epoch(ts: Column) -> Column:
    """Epoch seconds of the hour a time falls into."""
    return F.unix_seconds(F.date_trunc("HOUR", ts))


def lifetime_days(first: Column, last: Column) -> Column:
    """Whole days, rounded, between two epoch-millisecond values."""
    return F.round((last - first) / F.lit(86_400_000))


def suffix(column: str, n: int = 3) -> Column:
    return F.right(F.col(column), F.lit(n))


def key_in_file_name(column: str) -> Column:
    """Text between the last underscore and ``.json``."""
    return F.regexp_extract(column, r"_([^_]*)\.json$", 1)


def date_in_file_name(column: str, pattern: str, fmt: str) -> Column:
    """Date spelled in a file name: `pattern` has one group, read with format `fmt`."""
    return F.try_to_date(F.regexp_extract(column, pattern, 1), fmt)
