"""Key and category profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.casts import as_col
from ..session import materialize
from .joins import one_row


def _formats(key: Column | str) -> dict[str, Column]:
    # NULL is read as text here, so that it counts as an unknown format
    text = F.coalesce(as_col(key), F.lit("nan"))
    return {
        "clean_10": text.rlike(r"^[0-9]{10}\z"),
        "dashed": text.contains("-"),
        "comma": text.contains(","),
        "zero_led": text.startswith("0"),
    }


def format_census(df: DataFrame, key: str) -> DataFrame:
    """Rows per key format, in one pass."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in _formats(key).items()])


def unknown_formats(df: DataFrame, key: str) -> DataFrame:
    """Values that fit none of the known formats, with their counts."""
    known = F.lit(False)
    for cond in _formats(key).values():
        known = known | cond
    return counts_by(df.filter(~known), [key]).orderBy(F.desc("n"), F.asc_nulls_last(key))


def counts_by(df: DataFrame, keys: Sequence[Column | str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return counts_by(df, keys).filter(F.col("n") > 1)


def duplicated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the duplicated keys, the first copy included.

    The keys are counted map-side and written. Their size is known then: a small list
    is broadcast, and the rows are filtered where they are; beside a large one AQE splits
    the rows of hot keys.
    """
    known = materialize(duplicated(df, keys).drop("n"), "duplicated-keys")
    return df.join(known, list(keys), "left_semi")


def fill_rate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of non-NULL values per column."""
    return df.agg(*[F.round(F.avg(F.col(k).isNotNull().cast("int")), 4).alias(f"{k}_rate") for k in keys])


def category_counts(df: DataFrame, c: str) -> DataFrame:
    """Rows and share per category, NULL counted as its own category."""
    counts = counts_by(df, [c])
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    shared = one_row(counts, total).withColumn("share", F.round(F.col("n") / F.col("_total"), 4))
    return shared.drop("_total").orderBy(F.desc("n"), F.asc_nulls_last(c))


def newest(df: DataFrame, ts: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc()).limit(n)


def sample_rows(df: DataFrame, n: int, seed: int, key: str, per: Sequence[str] = ()) -> DataFrame:
    """``n`` rows of each ``per`` group (all of a smaller group), the same on every run.

    The rows with the smallest hashes of seed and key are taken. They are found without
    sorting a group: rows are counted by the first digits of the hash, the counts tell
    up to which digits rows are wanted, and only those rows are ranked.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_digits", F.substring("_hash", 1, 3))
    counted = counts_by(hashed, [*per, "_digits"], "_count")
    before = Window.partitionBy(*per).orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    wanted = counted.withColumn("_before", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    wanted = wanted.filter(F.col("_before") < n).drop("_count")  # at most 4,096 rows a group
    place = F.row_number().over(Window.partitionBy(*per, "_digits").orderBy("_hash", key))
    chosen = hashed.join(wanted, [*per, "_digits"]).withColumn("_place", place + F.col("_before"))
    return chosen.filter(F.col("_place") <= n).select(*df.columns)
