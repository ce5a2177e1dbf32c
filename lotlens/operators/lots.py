"""Owner-to-lot operators: explode key lists, split a measure, weighted means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import SEPARATORS, key_pieces, lot_keys


def explode_split(df: DataFrame, raw: str, out: str = "piece", separators: str = SEPARATORS) -> DataFrame:
    """One row per trimmed piece of a separated text field."""
    return df.withColumn(out, F.explode(key_pieces(raw, separators)))


def explode_keys(df: DataFrame, raw: str, out: str = "bbl", count: str | None = None) -> DataFrame:
    """One row per distinct valid lot key of a field; rows without one drop out.

    The distinct count is taken on the array, before the explode, so neither
    the distinct nor the count needs a shuffle.
    """
    listed = df.withColumn("_keys", lot_keys(raw))
    if count:
        listed = listed.withColumn(count, F.size("_keys").cast("long"))
    # the outer form: a plain explode makes Catalyst evaluate the array a second time as a filter
    exploded = listed.withColumn(out, F.explode_outer("_keys")).drop("_keys")
    return exploded.filter(F.col(out).isNotNull())


def even_split(
    df: DataFrame,
    owner: Sequence[str],
    measure: str,
    count: str = "n_lots",
    share: str = "gfa_share_sqft",
) -> DataFrame:
    """Split an owner's measure evenly over its already exploded rows.

    Counted with map-side aggregation and joined back, so an owner with very
    many rows is not gathered into one task as a window would do.
    """
    counts = df.groupBy(*owner).agg(F.count(F.lit(1)).alias(count))
    joined = df.join(counts, list(owner))
    return joined.withColumn(share, F.col(measure) / F.col(count))


def scored_weight(value: str, weight: str):
    return F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))


def weighted_score(value: str, weight: str, scale: int = 4):
    """Weighted mean over rows that have a value; NULL when their weight is 0.

    Rounded: a single value weighted by itself must come out unchanged.
    """
    total = F.sum(F.col(value) * F.col(weight))
    return F.round(F.try_divide(total, scored_weight(value, weight)), scale)


def weighted_mean(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, scale: int = 4
) -> DataFrame:
    return df.groupBy(*keys).agg(weighted_score(value, weight, scale).alias(value))
