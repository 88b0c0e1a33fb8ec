"""Date expressions on ``timestamp_ntz`` columns.

None of them depends on the session time zone: wall-clock values go in and
wall-clock values come out.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = date | datetime


def as_datetime(moment: Moment) -> datetime:
    """A plain date means its midnight; a zoned value has no wall-clock meaning here."""
    if not isinstance(moment, datetime):
        return datetime.combine(moment, time())
    if moment.tzinfo is not None:
        raise ValueError(f"expected a value without time zone, got {moment!r}")
    return moment


def timestamp_literal(moment: Moment) -> Column:
    # Through text: a Python datetime literal would become a zoned timestamp.
    return F.lit(as_datetime(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def trunc_day(moment: Column) -> Column:
    """Midnight of the day, still a ``timestamp_ntz``."""
    return moment.cast("date").cast("timestamp_ntz")


def parse_dmy(text: Column) -> Column:
    """Day/month/year text such as ``31/12/2008`` to its midnight."""
    return F.to_timestamp_ntz(text, F.lit("dd/MM/yyyy"))


def day_between(moment: Column, first: Column | Moment, last: Column | Moment) -> Column:
    """``trunc_day(moment) BETWEEN first AND last``, as a range on ``moment`` itself.

    Only ``moment`` is truncated. A ``first`` with a time of day therefore
    rules out the whole of its own day, while the day of ``last`` counts whole.
    With literal bounds both comparisons reach the Parquet scan.
    """
    return from_day(moment, first) & until_day(moment, last)


def from_day(moment: Column, first: Column | Moment) -> Column:
    """The lower half of :func:`day_between`."""
    if isinstance(first, Column):
        midnight = trunc_day(first)
        next_day = F.date_add(first.cast("date"), 1).cast("timestamp_ntz")
        return moment >= F.when(first == midnight, first).otherwise(next_day)
    first = as_datetime(first)
    midnight = datetime.combine(first.date(), time())
    return moment >= timestamp_literal(
        first if first == midnight else midnight + timedelta(days=1)
    )


def until_day(moment: Column, last: Column | Moment) -> Column:
    """The upper half of :func:`day_between`."""
    if isinstance(last, Column):
        return moment < F.date_add(last.cast("date"), 1).cast("timestamp_ntz")
    return moment < timestamp_literal(as_datetime(last).date() + timedelta(days=1))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``; fractions of both are dropped first."""
    days = F.datediff(end, start).cast("bigint")
    return days * F.lit(24 * 60 * 60) + _second_of_day(end) - _second_of_day(start)


def _second_of_day(moment: Column) -> Column:
    return F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
