"""Complaints per lot and season, kept up to date from what a load changed.

A complaint counts once, under the season and lot of its newest version. A load rewrites some
buckets of the complaint state; the counts change by the rows of these buckets after it, less
their rows before it. Rows that stayed the same cancel out, moved and corrected ones
leave their old place, and no other bucket is read. Counts are sums and days, never
least or largest values, so that anything can be taken away again: a season's first and last
day come from the complaints of each day.

Both tables of counts are newest-version states themselves. They follow the complaint
state commit by commit; after a crash between the two, the next refresh takes the same
difference again, and if the state has moved on too far, they are counted anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release
from ..streaming.upsert import LatestState
from . import models

LOT = ["heat_season", "heating_year_start", "bbl"]
DAY = ["heat_season", "heating_year_start", "created_date"]
SUMS = ["no_heat_complaints", "all_heat_complaints"]


def counted(complaints: DataFrame, keys: list[str], less: DataFrame | None = None) -> DataFrame:
    """Heat complaints in a season, per ``keys``; those of ``less`` are taken away, in the same aggregate."""

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        heat = models.heat_complaints(rows).filter(F.col("heat_season").isNotNull())
        return heat.select(*keys, F.when(F.col("is_no_heat"), sign).otherwise(0).alias("_no_heat"), F.lit(sign).alias("_all"))

    rows = signed(complaints, 1)
    if less is not None:
        rows = rows.unionByName(signed(less, -1))
    return rows.groupBy(*keys).agg(F.sum("_no_heat").alias(SUMS[0]), F.sum("_all").alias(SUMS[1]))


def added(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    both = reduce(DataFrame.unionByName, [p.select(*keys, *SUMS) for p in parts])
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])


class SeasonCounts:
    """Counts per lot and per day of the seasons, following a state of complaints."""

    def __init__(self, spark: SparkSession, path: str, complaints: LatestState, buckets: int = 64):
        self.complaints = complaints

        def state(name: str, keys: list[str], kinds: str, parts: int) -> LatestState:
            sums = ", ".join(f"{c} bigint" for c in SUMS)
            schema = T.StructType.fromDDL(f"{kinds}, {sums}, as_of bigint")
            return LatestState(spark, f"{path}/{name}", schema, keys, ["as_of"], parts)

        self._lots = state("lots", LOT, "heat_season string, heating_year_start int, bbl string", buckets)
        self._days = state("days", DAY, "heat_season string, heating_year_start int, created_date date", 1)

    def refresh(self) -> None:
        """Bring both tables up to the newest commit of the complaints."""
        self._follow(self._lots, LOT)
        self._follow(self._days, DAY)

    def _follow(self, kept: LatestState, keys: list[str]) -> None:
        done, last = kept.last_batch(), self.complaints.last_batch()
        if done == last:
            return
        changed = self.complaints.changed(done)
        if changed is None:  # the commit counted last is gone: all counts anew, vanished ones 0
            none = [F.lit(0).cast("bigint").alias(c) for c in SUMS]
            now = added([counted(self.complaints.current(), keys), kept.current().select(*keys, *none)], keys)
        else:
            before, after = changed
            change = counted(after, keys, before).filter(" or ".join(f"{c} <> 0" for c in SUMS))
            change = materialize(change, "change")  # read several times below, the state only once
            stored = kept.beside(change).join(
                change.select(*[F.col(k).alias(f"_{k}") for k in keys]),
                reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]),
                "left_semi",
            )
            now = added([change, stored], keys)
        try:
            kept.upsert(now.withColumn("as_of", F.lit(last).cast("bigint")), last)
        finally:
            if changed is not None:
                release(change)

    def lots(self) -> DataFrame:
        """Complaints per season and lot (NULL lot included)."""
        return self._lots.current().filter(F.col(SUMS[1]) > 0).drop("as_of")

    def days(self) -> DataFrame:
        return self._days.current().filter(F.col(SUMS[1]) > 0).drop("as_of")

    def mart(self, properties: DataFrame, dim: DataFrame) -> DataFrame:
        """The analysis table from the kept counts; the fact is not read."""
        days = models.with_report_year(self.days(), properties)
        seasons = models.season_coverage(
            days.withColumns({"first_date": F.col("created_date"), "last_date": F.col("created_date")})
        )
        return models.mart_of_counts(self.lots().drop("heating_year_start"), seasons, dim)
