"""Joins that keep a whole population, or measure how much of it matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(df: DataFrame, other: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a global aggregate) as scalar subqueries."""
    return df.withColumns({c: other.select(c).scalar() for c in other.columns})


def keep_zeros(
    population: DataFrame, counts: DataFrame, on: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Left join of unique counts; rows without any stay, with 0."""
    joined = population.join(counts.select(*on, *measures), list(on), "left")
    return joined.fillna(0, subset=list(measures))


def match_rates(counts: DataFrame, keys: DataFrame, on: str, volume: str, stage: str) -> DataFrame:
    """Share of keys, and of their volume, that occur in another key set."""
    known = keys.select(F.col(on)).distinct().withColumn("_hit", F.lit(1))
    flagged = counts.join(known, [on], "left").select(
        F.coalesce(F.col("_hit"), F.lit(0)).alias("hit"), F.col(volume).alias("v")
    )
    return flagged.agg(
        F.round(F.avg("hit"), 4).alias("key_rate"),
        F.round(F.try_divide(F.sum(F.col("hit") * F.col("v")), F.sum("v")), 4).alias("volume_rate"),
    ).select(F.lit(stage).alias("stage"), "key_rate", "volume_rate")


def missing_in_source(current: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys we hold that the source no longer lists."""
    return current.select(key).join(source.select(key), [key], "left_anti")


def completeness(source: DataFrame, got: DataFrame, month: str) -> DataFrame:
    """Rows per month on both sides and their ratio, months of either side kept."""
    expected = source.groupBy(month).agg(F.count(F.lit(1)).alias("expected"))
    loaded = got.groupBy(month).agg(F.count(F.lit(1)).alias("got"))
    both = expected.join(loaded, [month], "full").fillna(0, subset=["expected", "got"])
    return both.withColumn("ratio", F.round(F.try_divide("got", "expected"), 4))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; columns a part lacks become NULL."""
    whole, *rest = frames
    for df in rest:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole
