"""Date expressions that do not depend on the session time zone or on today."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_day(seconds: Column) -> Column:
    """The UTC date of epoch seconds."""
    days = F.floor(seconds / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def day_key(
    text: Column | None = None,
    seconds: Column | None = None,
    moment: Column | None = None,
    as_of: str | None = None,
) -> Column:
    """`yyyy-MM-dd` from a string that starts with a date or holds epoch seconds,
    else from epoch seconds, else from a timestamp, else the given day."""
    choices = []
    if text is not None:
        choices.append(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10)))
        number = F.when(text.rlike(r"^\d{9,11}(\.\d*)?$"), text.try_cast("double"))
        choices.append(epoch_day(number).cast("string"))
    if seconds is not None:
        choices.append(epoch_day(seconds).cast("string"))
    if moment is not None:
        choices.append(F.substring(moment.cast("string"), 1, 10))
    if as_of is not None:
        choices.append(F.lit(as_of))
    return F.coalesce(*choices)


def within_days(date: Column, as_of: str, days: int) -> Column:
    """True for dates on or after `as_of - days`; false for older and for unreadable dates."""
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    return F.coalesce(date.try_cast("date") >= first, F.lit(False))
