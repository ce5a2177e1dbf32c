"""Windows over a changing source, with counts that must reconcile."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_label
from ..operators.profile import counts_by
from .files import delete, folders, replace


class Extract(NamedTuple):
    rows: DataFrame
    upper: str | None
    expected: int


class ReconciliationError(RuntimeError):
    """Fewer or more rows arrived than the source announced."""


def extract_since(df: DataFrame, ts: str, lower, type_filter: Column | None = None) -> Extract:
    """Rows changed after ``lower``, up to the newest change known when asked.

    The upper bound is pinned first, so a source that moves on meanwhile cannot
    change the batch. Both bounds are plain comparisons and reach the scan.
    """
    kind = df.schema[ts].dataType
    changed = df.filter(F.col(ts) > F.lit(lower).cast(kind))
    if type_filter is not None:
        changed = changed.filter(type_filter)
    # the bound travels as text: a Python datetime would pass through the driver's time zone
    known = changed.agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).cast("string").alias("upper")
    ).first()
    if known["n"] == 0:
        return Extract(changed.limit(0), None, 0)
    pinned = changed.filter(F.col(ts) <= F.lit(known["upper"]).cast(kind))
    return Extract(pinned, known["upper"], known["n"])


def between_half_open(df: DataFrame, ts: str, start, end) -> DataFrame:
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def land(df: DataFrame, expected: int, path: str, *keys: str, rebalance: bool = True) -> None:
    """Write the rows once, count them on the way, and show them only if the count is right.

    They go to a folder that readers of ``path`` do not see. If ``expected`` rows
    arrived, their partitions (by ``keys``) replace those of ``path``; otherwise the
    folder is removed and nothing has changed. Rebalancing gathers a partition's rows
    into few files; AQE splits one that holds much more than the others.
    """
    spark, pending, seen = df.sparkSession, f"{path}/_pending-{uuid.uuid4().hex}", Observation()
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    (rows.hint("rebalance", *keys) if rebalance else rows).write.partitionBy(*keys).parquet(pending)
    try:
        collected = seen.get["n"]
        if collected != expected:
            raise ReconciliationError(f"source announced {expected:,} rows, {collected:,} arrived")
        found = [""]
        for _ in keys:
            found = [f"{f}/{name}" for f in found for name in folders(spark, f"{pending}{f}") if "=" in name]
        for folder in found:
            replace(spark, f"{pending}{folder}", f"{path}{folder}")
    finally:
        delete(spark, pending)


def reconcile_report(source: DataFrame, got: DataFrame, by: str) -> DataFrame:
    """Expected and collected rows per group of either side."""
    expected = counts_by(source, [by], "expected")
    both = expected.join(counts_by(got, [by], "collected"), [by], "full")
    both = both.fillna(0, subset=["expected", "collected"])
    return both.withColumn("ok", F.col("expected") == F.col("collected"))


def month_spans(spans: DataFrame, first: Column, last: Column) -> DataFrame:
    """Half-open months from the month of ``first`` through that of ``last``, one row each.

    None when ``last`` lies before ``first``.
    """
    a, b = F.trunc(first, "month"), F.trunc(last, "month")
    start = F.explode(F.when(a <= b, F.sequence(a, b, F.expr("interval 1 month"))))
    return spans.select(start.alias("first_day")).select(
        month_label("first_day").alias("label"),
        "first_day",
        F.add_months("first_day", 1).alias("next_first_day"),
    )


def month_windows(spark: SparkSession, start: str, today: str) -> DataFrame:
    """Months from ``start`` ('YYYY-MM') through the month of ``today``."""
    first = F.to_date(F.lit(f"{start}-01"))
    return month_spans(spark.range(1), first, F.to_date(F.lit(today)))


def month_windows_of(df: DataFrame, ts: str) -> DataFrame:
    """Every month between the first and the last row, without gaps."""
    ends = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    return month_spans(ends, F.to_date("a"), F.to_date("b"))


def counts_by_month(df: DataFrame, ts: str, start: str, today: str, out: str = "created_month") -> DataFrame:
    """Rows per month of the window; months without rows are listed with 0."""
    months = month_windows(df.sparkSession, start, today).select(F.col("label").alias(out))
    inside = df.filter(
        (F.col(ts) >= F.to_date(F.lit(f"{start}-01")))
        & (F.col(ts) < F.add_months(F.trunc(F.lit(today).cast("date"), "month"), 1))
    )
    counts = counts_by(inside, [month_label(ts).alias(out)])
    return months.join(counts, [out], "left").fillna(0, subset=["n"])


def checked_load(extract: Extract, path: str, *keys: str) -> int:
    """Land an extract if its rows are all there; an empty extract writes nothing."""
    if extract.expected:
        land(extract.rows, extract.expected, path, *keys)
    return extract.expected


def distinct_values(df: DataFrame, key: str) -> DataFrame:
    return counts_by(df, [key]).orderBy(F.asc_nulls_last(key))

