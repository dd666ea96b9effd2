"""Retail weeks. A week is named by the Saturday that ends it."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

SATURDAY = 5        # weekday(): Monday = 0


def is_week_end(d: Column) -> Column:
    return F.weekday(d) == SATURDAY


def week_ending(d: Column) -> Column:
    return F.next_day(F.date_sub(d, 1), "SAT")


def last_completed_week(d: Column) -> Column:
    """The newest Saturday strictly before `d`."""
    return F.date_sub(week_ending(d), 7)


def week_starting(week: Column) -> Column:
    return F.date_sub(week, 6)


def week_range(start: Column, end: Column) -> Column:
    """Array of the Saturdays from start to end; NULL when the bounds are no Saturdays or out of order."""
    ok = is_week_end(start) & is_week_end(end) & (start <= end)
    return F.when(ok, F.sequence(start, end, F.expr("interval 7 days")))


def checked_week_range(start: Column, end: Column) -> Column:
    """As `week_range`, raising on bad bounds."""
    text = F.concat(F.lit("window bounds must be Saturdays in order, got "), F.coalesce(start.cast("string"), F.lit("NULL")),
                    F.lit(" .. "), F.coalesce(end.cast("string"), F.lit("NULL")))
    weeks = week_range(start, end)
    return F.when(weeks.isNotNull(), weeks).otherwise(F.raise_error(text).cast("array<date>"))


def weeks_ago(week: Column, latest: Column) -> Column:
    return (F.date_diff(latest, week) / 7).cast("int")


def month_name(week: Column) -> Column:
    return F.date_format(week, "MMM yyyy")
