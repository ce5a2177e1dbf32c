"""Mergeable summaries for counts of distinct values and for quantiles; an opt-in beside the exact operators.

A summary per day and region is computed once and merged into any span of days, where the
exact operators need all rows again. The bounds are those of the sketches: a count is within
``distinct_error`` of the exact one at three deviations, a quantile's rank within
``rank_error`` of the wanted one in 99 of 100 cases.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 16,384 registers
K = 800


def distinct_error(lg_k: int = LG_K) -> float:
    """Three relative standard deviations of a merged HyperLogLog sketch."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch at 99 % confidence."""
    return 2.296 / k**0.9021


def distinct_sketches(df: DataFrame, keys: Sequence[Column | str], value: str, out: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One sketch of the distinct values that are not null per group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias(out))


def merge_distinct(sketches: DataFrame, keys: Sequence[Column | str], out: str, sketch: str = "sketch") -> DataFrame:
    """Estimated distinct values of coarser groups."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(out))


def quantile_sketches(df: DataFrame, keys: Sequence[Column | str], value: str, out: str = "sketch", k: int = K) -> DataFrame:
    """One sketch of the values that are not null per group; null for a group without any."""
    number = F.col(value).cast("double")
    made = df.groupBy(*keys).agg(F.kll_sketch_agg_double(number, k).alias(out), F.count(number).alias("_n"))
    return made.withColumn(out, F.when(F.col("_n") > 0, F.col(out))).drop("_n")


def merge_quantiles(
    sketches: DataFrame, keys: Sequence[Column | str], q: float, out: str, sketch: str = "sketch", k: int = K
) -> DataFrame:
    """Estimated quantile of coarser groups; groups without values drop out."""
    known = sketches.filter(F.col(sketch).isNotNull())
    merged = known.groupBy(*keys).agg(F.kll_merge_agg_double(sketch, k).alias(sketch))
    return merged.withColumn(out, F.kll_sketch_get_quantile_double(sketch, F.lit(q))).drop(sketch)
