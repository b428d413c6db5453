"""Date expressions. Text that is not a date becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from lakesteps.functions.text import trim_ws

# Seconds of 0001-01-01 and 9999-12-31T23:59:59, the span a DATE can hold.
_EPOCH_LO, _EPOCH_HI = -62135596800, 253402300799


def parse_date_strict(c: Column) -> Column:
    """``yyyy-MM-dd`` only.

    A cast alone would also take ``2024-05`` and ``2024``; behind the pattern it is exact, and far
    cheaper than a formatter.
    """
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}\z"), c.try_cast("date"))


def parse_partial_date(c: Column) -> Column:
    """Day, month (``2024-05``), quarter (``2024-Q3``) or year text to the first day of it."""
    text = trim_ws(c)
    year = F.substring(text, 1, 4)
    quarter_month = F.element_at(
        F.array(*[F.lit(m) for m in ("-01", "-04", "-07", "-10")]),
        F.substring(text, 7, 1).try_cast("int"),
    )
    full = (
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text)
        .when(text.rlike(r"^\d{4}-\d{2}\z"), F.concat(text, F.lit("-01")))
        .when(text.rlike(r"^\d{4}-Q[1-4]\z"), F.concat(year, quarter_month, F.lit("-01")))
        .when(text.rlike(r"^\d{4}\z"), F.concat(text, F.lit("-01-01")))
    )
    return full.try_cast("date")


def parse_or_null(c: Column, formats: Sequence[str], to: str = "date") -> Column:
    """The first format that fits; NULL when none does."""
    parsed = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])
    return F.to_date(parsed) if to == "date" else parsed


def epoch_to_date(c: Column, tz: str = "UTC") -> Column:
    """Epoch-seconds text to the calendar day in ``tz``, whatever the session zone is."""
    seconds = trim_ws(c).try_cast("bigint")
    bounded = F.when(seconds.between(_EPOCH_LO, _EPOCH_HI), seconds)
    zero = F.lit(0)
    wall = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        zero, zero, zero, bounded.cast("decimal(18,6)")
    )
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), wall))


def iso_to_date(c: Column) -> Column:
    """``2024-05-01T10:20:30`` to its day."""
    return F.try_to_date(c, "yyyy-MM-dd'T'HH:mm:ss")


def heading_to_date(c: Column, year: Column) -> Column:
    """``Wednesday, May 1`` plus a year to a date."""
    month_day = F.split_part(c, F.lit(", "), F.lit(2))
    text = F.concat(month_day, F.lit(" "), year.cast("string"))
    return F.try_to_date(text, "MMM d yyyy")


def duration_days(start: Column, end: Column) -> Column:
    """Days covered, both ends counted."""
    return F.datediff(end, start) + 1


def week_sunday(d: Column) -> Column:
    """Week of the year, Sunday first, 0 before the first Sunday (``weekofyear`` is ISO)."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def is_weekend(d: Column) -> Column:
    return F.dayofweek(d).isin(1, 7)


def day_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
