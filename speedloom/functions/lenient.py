"""Tolerant conversions for loosely typed request and file fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speedloom.functions.readings import parse_time

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Seconds of 9999-12-31; larger numbers are no time stamps.
_MAX_EPOCH = 253402300799.0


def number_in(text: Column) -> Column:
    """Number from text; blank, 'auto' and words give null (too large ones infinity)."""
    # Only numbers are cast: a failed cast costs an exception inside, even as a try.
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def finite(number: Column) -> Column:
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def whole(number: Column, low: int | None = None, high: int | None = None) -> Column:
    """Whole part of a number within [low, high]; otherwise null."""
    least, most = -(2**31) if low is None else low, 2**31 - 1 if high is None else high
    # Cutting off the fraction may bring a number just outside back in.
    inside = (number > least - 1) & (number < most + 1)
    return F.when(inside, number).try_cast("int")


def instant(seconds: Column, text: Column) -> Column:
    """Timestamp from epoch seconds where given, else from date text."""
    from_epoch = F.timestamp_seconds(F.when(F.abs(seconds) <= _MAX_EPOCH, seconds))
    return F.when(seconds.isNull(), parse_time(text)).otherwise(from_epoch)


def lenient_double(text: Column) -> Column:
    """Number from text; blank, 'auto', words, NaN and infinities give null."""
    return finite(number_in(text))


def lenient_int(text: Column, low: int | None = None, high: int | None = None) -> Column:
    """Whole number (fraction cut off) within [low, high]; otherwise null."""
    return whole(number_in(text), low, high)


def lenient_timestamp(text: Column) -> Column:
    """Timestamp from epoch seconds or date text; otherwise null."""
    return instant(number_in(text), text)
