"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Of texts that Python works on one by one. Ten thousand, as Spark deals them, are 34 MB here, held by both sides at once.
ROWS_AT_ONCE = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = ROWS_AT_ONCE) -> Iterator[None]:
    """Tables written inside hand at most ``rows`` rows to Python at a time; a smaller setting stays."""
    before = spark.conf.get(_ARROW_ROWS)
    if not 0 < int(before) <= rows:
        spark.conf.set(_ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have."""
    while wanted in df.columns:
        wanted += "_"
    return wanted


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """Only A-Z become small. ``lower`` does the same, faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of ``separators`` (the inside of a regex class); null: no words."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{separators}]+")
    return F.filter(parts, lambda w: w != "")


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of literal rows, for lists whose size is part of the code or checked by the caller."""
    return spark.createDataFrame(list(rows), schema)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in a column ``name``.

    A group is dealt by a hash of ``order`` over several buckets, the buckets are
    counted, and a row's number is its place in the bucket after all earlier
    buckets, so that no group meets in one task. ``df`` is read twice and must
    give the same rows both times. Rows equal in ``order`` are numbered in any
    order; numbers follow the buckets, not ``order`` as a whole.
    """
    spread = partitions(df.sparkSession)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(spread)))
    earlier = (
        Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = (
        dealt.groupBy(*by, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    return (
        dealt.withColumn("_place", place - 1)
        .join(before, [*by, "_bucket"])
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_bucket", "_before", "_place")
    )
