"""Tolerant casts: text that does not parse becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_num(c: Column | str, to: str = "double") -> Column:
    return as_col(c).try_cast(to)


def try_whole(c: Column | str) -> Column:
    """Text holding a whole number; a fraction is rounded half up."""
    return as_col(c).try_cast("decimal(38,0)").try_cast("int")


def try_int_rounded(c: Column | str) -> Column:
    """Text to double to int. A bare int cast would truncate, so round first."""
    return F.round(as_col(c).try_cast("double")).try_cast("int")


def try_ts(c: Column | str, zoned: bool = False) -> Column:
    return as_col(c).try_cast("timestamp" if zoned else "timestamp_ntz")


def utc_wall_clock(c: Column | str) -> Column:
    """A zoned instant as the naive UTC time, whatever the session zone is."""
    micros = F.unix_micros(as_col(c)) * F.expr("interval '0.000001' second")
    return F.lit("1970-01-01").cast("timestamp_ntz") + micros


def iso_text(c: Column | str) -> Column:
    """A naive timestamp as ISO text. A plain cast involves no session time zone."""
    return F.replace(as_col(c).cast("string"), F.lit(" "), F.lit("T"))


def null_if_any(c: Column | str, *sentinels: str) -> Column:
    value = as_col(c)
    return F.when(~value.isin(*sentinels), value)


def in_or_false(c: Column | str, values: list[str] | tuple[str, ...]) -> Column:
    return F.coalesce(as_col(c).isin(*values), F.lit(False))


def null_safe_least(*cols: Column | str) -> Column:
    """``least`` that is NULL when any argument is NULL."""
    cols = [as_col(c) for c in cols]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.least(*cols))
