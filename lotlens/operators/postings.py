"""A posting table of short character runs, so that a text search reads a few rows of a large table.

Every run of two and three characters of a row's text, and every prefix of its key, names
the keys that have it. A search looks up how many keys each run of the wanted text
has, reads the list of the rarest one, and then only those parts of the rows that hold its
keys. What it returns can match; the caller applies the search's own condition.

The tables are folders by a hash of run or key, sorted within, so that a lookup opens one
folder and skips most of its row groups. A search for something that most rows
have (a street's suffix) reads most rows, as it must to rank them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, release
from ..sources.state import read_or_empty

SIZES = (2, 3)
PARTS = 64
PREFIX = "^"  # in front of a run that is the beginning of the key


def runs_of(text: str) -> set[str]:
    """The longest runs that every text containing ``text`` has."""
    size = min(len(text), SIZES[-1])
    return {text[i : i + size] for i in range(len(text) - size + 1)} if size in SIZES else set()


def _of_size(text: Column, size: int) -> Column:
    last = F.char_length(text) - (size - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.substring(text, at, F.lit(size)))


def _runs(text: Column, key: Column) -> Column:
    ends = F.sequence(F.lit(1), F.greatest(F.char_length(key), F.lit(1)))
    prefixes = F.transform(ends, lambda n: F.concat(F.lit(PREFIX), F.substring(key, F.lit(1), n)))
    return F.array_distinct(F.concat(*[_of_size(text, size) for size in SIZES], prefixes))


class PostingIndex:
    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path, parts

    def _part(self, of: Column) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(self.parts)).cast("int")

    def build(self, rows: DataFrame, key: str, text: Column) -> None:
        """Write the rows and their postings. Rows without a key or text are never found."""
        held = rows.withColumn("_part", self._part(F.col(key)))
        held.hint("rebalance", "_part").sortWithinPartitions("_part", key).write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/rows")
        texts = rows.select(F.col(key).alias("_key"), text.alias("_text")).filter("_key is not null and _text is not null")
        named = texts.distinct().select("_key", F.explode(_runs(F.col("_text"), F.col("_key"))).alias("_run"))
        named = materialize(named.distinct(), "postings")
        for name, table in (("lists", named), ("counts", named.groupBy("_run").agg(F.count(F.lit(1)).alias("_keys")))):
            dealt = table.withColumn("_part", self._part(F.col("_run"))).hint("rebalance", "_part")
            dealt.sortWithinPartitions("_part", "_run").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/{name}")
        release(named)

    def _of_runs(self, name: str, schema: str, runs: set[str]) -> DataFrame:
        # a literal filter on the folder: the hash is taken by Spark, once for a few runs
        wanted = self.spark.createDataFrame([(r,) for r in sorted(runs)], "_run string")
        parts = [r[0] for r in wanted.select(self._part(F.col("_run"))).distinct().collect()]
        table = read_or_empty(self.spark, f"{self.path}/{name}", f"_run string, {schema}, _part int")
        return table.filter(F.col("_part").isin(*parts) & F.col("_run").isin(*runs))

    def candidates(self, schema: DataFrame, key: str, runs: set[str]) -> DataFrame:
        """The rows of keys that have the rarest of ``runs``; ``schema`` is a frame with the indexed columns."""
        if not runs:
            raise ValueError("a search has at least two characters")
        columns = schema.columns
        counts = {r[0]: r[1] for r in self._of_runs("counts", "_keys bigint", runs).collect()}  # a row per run
        if len(counts) < len(runs):
            return schema.limit(0)
        rarest = min(counts, key=lambda r: (counts[r], r))
        keys = self._of_runs("lists", "_key string", {rarest}).select(F.col("_key").alias(key))
        parts = [r[0] for r in keys.select(self._part(F.col(key))).distinct().collect()]  # at most self.parts
        rows = self.spark.read.parquet(f"{self.path}/rows").filter(F.col("_part").isin(*parts))
        return rows.join(keys, key, "left_semi").select(*columns)
