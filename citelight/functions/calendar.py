"""Dates, weeks and timestamps. All clocks are UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_week(day: ColumnOrName) -> Column:
    """ISO year and week, ``2026-07``; NULL for a NULL day."""
    day = F.to_date(_col(day))
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def week_monday(day: ColumnOrName) -> Column:
    """First day of the ISO week."""
    return F.trunc(F.to_date(_col(day)), "week")


def sunday_week(day: ColumnOrName) -> Column:
    """First day of the week when weeks start on Sunday."""
    day = F.to_date(_col(day))
    return F.date_sub(day, F.dayofweek(day) - 1)


def parse_timestamp(text: ColumnOrName) -> Column:
    """ISO-8601 text (``Z`` or an offset) to a timestamp; NULL when it does not parse."""
    return F.try_to_timestamp(_col(text))


def snapshot_day(text: ColumnOrName, run_day: Column) -> Column:
    """Day of an ISO-8601 text, the run's day when the text is missing or invalid."""
    return F.coalesce(F.to_date(parse_timestamp(text)), run_day)


def text_day(text: ColumnOrName) -> Column:
    """The leading ``YYYY-MM-DD`` of a timestamp text."""
    return F.substring(_col(text), 1, 10).try_cast("date")


def firestore_timestamp(stamp: ColumnOrName) -> Column:
    """``{_seconds, _nanoseconds}`` to a timestamp (microsecond precision)."""
    stamp = _col(stamp)
    micros = stamp["_seconds"].cast("bigint") * F.lit(1_000_000) + F.floor(
        F.coalesce(stamp["_nanoseconds"], F.lit(0)) / F.lit(1000)
    )
    return F.timestamp_micros(micros)
