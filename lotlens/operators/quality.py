"""Data-quality checks: each returns the offending rows, none when the data is good."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import counts_by, duplicated


def check_unique(df: DataFrame, key: str) -> DataFrame:
    return duplicated(df.filter(F.col(key).isNotNull()), [key])


def check_not_null(df: DataFrame, column: str, *show: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).select(*(show or [column]))


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list with their counts; NULL passes."""
    odd = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return counts_by(odd, [column])


def check_range(df: DataFrame, key: str, column: str, low: float, high: float) -> DataFrame:
    """Rows outside the range; NULL passes."""
    return df.filter((F.col(column) < low) | (F.col(column) > high)).select(key, column)


def check_no_fan_out(mart: DataFrame, fact: DataFrame) -> DataFrame:
    """Seasons in which the mart counts more complaints than there are."""
    real = (
        fact.filter(F.col("heat_season").isNotNull() & F.col("bbl").isNotNull())
        .groupBy("heat_season")
        .agg(F.count_if("is_no_heat").alias("fact_total"))
    )
    return beyond(mart, real)


def beyond(mart: DataFrame, real: DataFrame) -> DataFrame:
    """Seasons in which the mart counts more than ``fact_total`` of ``real``."""
    counted = mart.groupBy("heat_season").agg(F.sum("no_heat_complaints").alias("mart_total"))
    return counted.join(real, "heat_season").filter(F.col("mart_total") > F.col("fact_total"))


def nulls(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def odd_values(column: str, values: Sequence[str]) -> Column:
    """Number of values outside the list; NULL passes."""
    return F.count_distinct(F.when(~F.col(column).isin(*values), F.col(column)))


def outside(column: str, low: float, high: float) -> Column:
    return F.count_if((F.col(column) < low) | (F.col(column) > high))


class Failing(NamedTuple):
    """A check that an aggregate of its table answers: how much of it fails."""

    name: str
    table: DataFrame
    failing: Column


class Offending(NamedTuple):
    """A check that needs rows of its own: those that offend."""

    name: str
    rows: DataFrame


Check = Failing | Offending


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """One row per check with its number of offending rows, as one plan.

    All aggregates of one table share a scan of it.
    """
    tables: dict[int, list[Failing]] = {}
    for check in checks:
        if isinstance(check, Failing):
            tables.setdefault(id(check.table), []).append(check)
    counted = [
        of[0].table.agg(*[c.failing.alias(f"c{i}") for i, c in enumerate(of)]).select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("failing_rows"))
                        for i, c in enumerate(of)
                    ]
                )
            )
        )
        for of in tables.values()
    ]
    counted += [
        c.rows.agg(F.count(F.lit(1)).alias("failing_rows")).select(F.lit(c.name).alias("check"), "failing_rows")
        for c in checks
        if isinstance(c, Offending)
    ]
    return reduce(DataFrame.unionAll, counted).select(
        "check", (F.col("failing_rows") == 0).alias("passed"), "failing_rows"
    )


def run_summary(results: DataFrame, models_built: int, built_at: str) -> DataFrame:
    """Totals of a run, as published next to the data."""
    return results.agg(
        F.count(F.lit(1)).alias("tests_total"),
        F.count_if("passed").alias("tests_passed"),
    ).select(
        F.lit(built_at).alias("built_at"),
        "tests_total",
        "tests_passed",
        F.lit(models_built).cast("long").alias("models_built"),
    )


def may_publish(results: DataFrame) -> bool:
    """Publish only when every check passed. Freshness is not among the checks."""
    return results.filter(~F.col("passed")).isEmpty()


def freshness(
    df: DataFrame,
    loaded: str,
    now: str,
    warn_days: int = 3,
    error_days: int = 5,
    zone: str | None = None,
) -> DataFrame:
    """Age of the newest load at ``now`` (UTC); ``zone`` is the wall clock ``loaded`` is kept in.

    A table without any load is an error.
    """
    newest: Column = F.max(loaded)
    if zone:
        newest = F.convert_timezone(F.lit(zone), F.lit("UTC"), newest)
    aged = df.agg(newest.alias("max_loaded")).withColumn(
        "_now", F.lit(now).cast("timestamp_ntz")
    )
    late = lambda days: F.col("_now") > F.col("max_loaded") + F.make_dt_interval(F.lit(days))
    return aged.select(
        "max_loaded",
        F.datediff(F.to_date("_now"), F.to_date("max_loaded")).alias("age_days"),
        F.when(F.col("max_loaded").isNull() | late(error_days), "error")
        .when(late(warn_days), "warn")
        .otherwise("pass")
        .alias("status"),
    )
