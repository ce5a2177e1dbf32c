"""Heating-season calendar: October 1 to May 31, labelled like '2025-26'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import as_col


def season_start_year(c: Column | str) -> Column:
    d = as_col(c)
    return F.year(d) - F.when(F.month(d) < 10, 1).otherwise(0)


def label_of_year(start_year: Column | str) -> Column:
    y = as_col(start_year)
    return F.concat_ws("-", y.cast("string"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def season_label(c: Column | str) -> Column:
    """Label of the season a date falls in; NULL from June to September and for NULL dates."""
    d = as_col(c)
    return F.when(~F.month(d).between(6, 9), label_of_year(season_start_year(d)))


def start_year_of(label: Column | str) -> Column:
    return F.substring(as_col(label), 1, 4).cast("int")


def first_day(start_year: Column | str) -> Column:
    return F.make_date(as_col(start_year), F.lit(10), F.lit(1))


def last_day(start_year: Column | str) -> Column:
    return F.make_date(as_col(start_year) + 1, F.lit(5), F.lit(31))


def season_bounds(label: Column | str) -> tuple[Column, Column]:
    year = start_year_of(label)
    return first_day(year), last_day(year)


def prev_season(label: Column | str) -> Column:
    return label_of_year(start_year_of(label) - 1)


def month_label(c: Column | str) -> Column:
    return F.substring(as_col(c).cast("date").cast("string"), 1, 7)


def boundary_minutes(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed between two naive timestamps.

    Built from date, hour and minute, so no session time zone is involved.
    """
    a, b = as_col(start), as_col(end)
    days = F.datediff(F.to_date(b), F.to_date(a)).cast("long")
    return days * 1440 + (F.hour(b) - F.hour(a)) * 60 + (F.minute(b) - F.minute(a))


def close_minutes(created: Column | str, closed: Column | str) -> Column:
    """Minutes to close, only when the close is not before the start."""
    created, closed = as_col(created), as_col(closed)
    return F.when(closed >= created, boundary_minutes(created, closed))
