"""Append-only state: a run's bookmark, written only after its data is safe."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_SCHEMA = "batch long, value string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or an empty frame as long as nothing was written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Bookmark:
    """A single value with its history; the newest batch counts.

    One small file per commit is appended. A file is visible either whole or
    not at all, so a crash leaves the old value in place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _last(self):
        commits = read_or_empty(self.spark, self.path, COMMIT_SCHEMA)
        return commits.orderBy(F.desc("batch")).first()

    def get(self, default: str | None = None) -> str | None:
        last = self._last()
        return last["value"] if last else default

    def next_batch(self) -> int:
        last = self._last()
        return last["batch"] + 1 if last else 0

    def set(self, value: str) -> None:
        row = [(self.next_batch(), value)]
        self.spark.createDataFrame(row, COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
