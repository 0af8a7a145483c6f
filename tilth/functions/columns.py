"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a number becomes NULL."""
    return nan_to_null(F.trim(as_col(c)).try_cast("double"))


def to_timestamp_ntz(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp without zone; anything else becomes NULL."""
    c = as_col(c)
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return parsed.cast("timestamp_ntz")


#: Formats in which times are tried, in order; None is what a cast to timestamp takes (ISO 8601).
TIME_FORMATS = (None, "M/d/yyyy H:mm[:ss]", "M/d/yyyy h:mm[:ss] a", "yyyy/M/d H:mm[:ss]", "d-MMM-yyyy H:mm[:ss]", "d.M.yyyy H:mm[:ss]", "yyyyMMdd'T'HHmmss")


def first_time(c: Column | str, formats: Sequence[str | None] = TIME_FORMATS) -> Column:
    """Text to timestamp without zone, in the first format that it fits; NULL when it fits none."""
    return F.coalesce(*(to_timestamp_ntz(F.trim(as_col(c)), fmt) for fmt in formats))


def micros(c: Column | str) -> Column:
    """Wall-clock microseconds since 1970, whatever the session zone."""
    instant = as_col(c).cast("timestamp_ntz").cast("timestamp")
    return F.unix_micros(F.from_utc_timestamp(instant, F.current_timezone()))


def day(c: Column | str) -> Column:
    return F.to_date(as_col(c))


def year_of(c: Column | str) -> Column:
    return F.year(as_col(c)).cast("int")


def doy_of(c: Column | str) -> Column:
    return F.dayofyear(as_col(c)).cast("int")


def db_to_power(c: Column | str) -> Column:
    return F.pow(F.lit(10.0), as_col(c) / F.lit(10.0))


def power_to_db(c: Column | str) -> Column:
    """10 log10(p); NULL where p is not positive."""
    c = as_col(c)
    return F.when(c > 0, F.lit(10.0) * F.log10(c))


def clip_low(c: Column | str, low: float = 0.0) -> Column:
    """max(c, low) that keeps NULL as NULL."""
    c = as_col(c)
    return F.when(c > low, c).when(c.isNotNull(), F.lit(low))


def mean_ignoring_null(*cols: Column | str) -> Column:
    """Row mean over the non-null columns; NULL when all are."""
    cols = [as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.try_divide(total, count.cast("double"))


def hashed_order(*ids: Column | str) -> Column:
    """Repeatable order for rows at one instant, and evenly spread over shards.

    The order of equal instants is arbitrary in the domain; taking it from a
    hash lets :mod:`tilth.operators.scan` cut a crowded instant into shards
    that are contiguous in this same order.
    """
    return F.md5(F.concat_ws("|", *[as_col(c).cast("string") for c in ids]))
