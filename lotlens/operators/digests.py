"""Compare two sets of keys by digests of buckets, so that only differing buckets move.

Both sides are summed up to one row per bucket: rows, and two independent order-free digests
of their keys. A bucket whose digests agree holds the same keys on both sides, but for a
chance of about 2**-100. Rows of the other buckets are compared key by key.

The digests are partial sums of each task, and the keys of equal buckets never leave
theirs. That pays if fewer keys differ than there are buckets; repeated keys on one side make
a bucket differ, which costs its rows a move and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BUCKETS = 1 << 16


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def bucket_digests(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows (_bucket, _n, _sum, _xor) of the keys that are not null."""
    keyed = df.filter(F.col(key).isNotNull()).select(key, _bucket(key, buckets).alias("_bucket"))
    other = F.xxhash64(F.lit("digest"), key)  # independent of the bucket
    return keyed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_n"),
        # one half each, so that no sum leaves a long
        F.sum(F.shiftright(other, 32)).alias("_sum"),
        F.bit_xor(other).alias("_xor"),
    )


def differing_buckets(a: DataFrame, b: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Buckets (_bucket) whose keys differ, those that one side lacks included."""
    sides = [bucket_digests(df, key, buckets) for df in (a, b)]
    digest = F.struct("_n", "_sum", "_xor")
    left, right = (s.select("_bucket", digest.alias(name)) for s, name in zip(sides, ("_left", "_right")))
    return left.join(right, "_bucket", "full").filter(~F.col("_left").eqNullSafe(F.col("_right"))).select("_bucket")


def missing_by_digest(current: DataFrame, source: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys we hold that the source no longer lists, null keys included, as ``joins.missing_in_source`` gives them.

    Both sides are read twice.
    """
    differing = materialize(differing_buckets(current, source, key, buckets), "differing-buckets")
    bucket = _bucket(key, buckets)
    held = current.select(key).filter(F.col(key).isNotNull())
    ours = held.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi").select(key)
    theirs = source.select(key).withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi").select(key)
    missing = ours.join(theirs, [key], "left_anti")
    return missing.unionByName(current.select(key).filter(F.col(key).isNull()))
