"""Column expressions for speeds, times and bins."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from speedloom import fixed_values as fv


def valid_speed(value: Column) -> Column:
    """Speed as double; null unless 0 < speed <= 120 (NaN and bad text included)."""
    speed = value.try_cast("double")
    # NaN orders above every number, so the upper bound rejects it too.
    ok = (speed > fv.SPEED_MIN_EXCLUSIVE) & (speed <= fv.SPEED_MAX_INCLUSIVE)
    return F.when(ok, speed)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _shape(time_format: str) -> str:
    """Regular expression for texts of a numeric time format."""

    def part(letters: re.Match) -> str:
        width = len(letters.group())
        return r"\d{1,2}" if width == 1 else rf"\d{{{width}}}"

    return "^" + re.sub(r"([yMdHms])\1*", part, time_format) + "$"


def parse_time(text: Column, formats: tuple[str, ...] = fv.TIME_FORMATS) -> Column:
    """Timestamp from ISO text or one of ``formats``; unreadable text gives null."""
    trimmed = F.trim(text)
    # A bare year or year-month is not a time stamp, although a cast would take it.
    iso = F.when(trimmed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), trimmed.try_cast("timestamp"))
    # Only texts of the right shape are parsed: a failed parse costs an exception each.
    other = [F.when(trimmed.rlike(_shape(f)), F.try_to_timestamp(trimmed, F.lit(f))) for f in formats]
    return F.coalesce(iso, *other)


def slot_start(ts: Column, freq_min: int) -> Column:
    """Start of the ``freq_min``-minute slot holding ``ts``."""
    return F.window(ts, f"{int(freq_min)} minutes")["start"]


def bin_lower(value: Column, width: float = fv.HISTOGRAM_WIDTH) -> Column:
    return F.floor(value / F.lit(float(width))) * F.lit(float(width))


def minute_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def shown(value: Column, digits: int) -> Column:
    """``value`` rounded for display: as a decimal, so that the last bit of a mean, which depends on the order of
    summation, does not decide where it ends in 5."""
    return F.round(value.cast("decimal(20,12)"), digits).cast("double")
