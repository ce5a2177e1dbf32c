"""Keep one version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def first_per(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    Catalyst puts a group limit below the shuffle, so a key with very many
    versions sends at most ``n`` rows per map task to its reducer.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") <= n).drop("_rn")


def top_n(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], n: int, spread_by: str, ways: int = 32
) -> DataFrame:
    """The first ``n`` rows per key where a key may hold any share of the rows.

    Each key is dealt by a hash of ``spread_by`` into ``ways`` parts that are cut to
    ``n`` rows first, so the last task of a key gets at most ``ways * n`` rows, however
    many map tasks there are and however large ``n`` is.
    """
    dealt = df.withColumn("_way", F.pmod(F.xxhash64(spread_by), F.lit(ways)))
    parts = first_per(dealt, [*keys, "_way"], order, n).drop("_way")
    return first_per(parts, keys, order, n)


def latest_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Newest row per key; ``newest`` are sorted descending with NULLs last."""
    return first_per(df, keys, [F.col(c).desc_nulls_last() for c in newest])


def top_per(df: DataFrame, keys: Sequence[str], measure: str, tie: str) -> DataFrame:
    """Row with the largest measure per key, ties by the smaller ``tie``."""
    return first_per(df, keys, [F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_last()])


def latest_load(df: DataFrame, file: str = "source_file", loaded: str = "loaded_at") -> DataFrame:
    """Rows of the newest load of each file, ties kept; of equal load times the later ``batch`` counts.

    The list of files and their newest loads is written at once. Its size is known then: a
    small one is broadcast and the rows are filtered where they are, since a shuffle by file would
    gather each file's rows in one task; beside a large one AQE splits the rows of large files.
    """
    stamp = [loaded, "batch"] if "batch" in df.columns else [loaded]
    # distinct first: it collapses rows by hashing, while the maximum of a struct sorts its input
    loads = df.select(F.col(file).alias("_file"), *stamp).distinct()
    newest = materialize(loads.groupBy("_file").agg(F.max(F.struct(*stamp)).alias("_newest")), "newest-loads")
    same = (F.col(file) == F.col("_file")) & (F.struct(*stamp) == F.col("_newest"))
    return df.join(newest, same, "left_semi")
