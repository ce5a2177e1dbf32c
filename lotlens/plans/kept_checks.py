"""Checks of the complaint state that read only what a load rewrote.

Keys are hashed to buckets, so a key's copies share a bucket, and what one bucket fails does
not depend on another. For each bucket its results are kept: keys held twice, rows without
a key, rows that belong to another bucket (they could hide a copy, so uniqueness fails by
them too), and per season the complaints that the analysis table may count at most. A refresh
reads the buckets rewritten since the commit it followed last; the results of all others
stand. A failing bucket keeps failing until a load rewrites it.

Files that were changed behind the state's back are seen only by a ``refresh`` of
everything. That also happens by itself when the last followed commit is no longer kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality
from ..streaming.upsert import LatestState
from . import models

SCHEMA = (
    "bucket int, not_unique bigint, without_key bigint, misplaced bigint,"
    " seasons array<struct<heat_season: string, total: bigint>>, as_of bigint, pass bigint"
)


def by_bucket(rows: DataFrame, state: LatestState) -> DataFrame:
    """Results per bucket, of ``rows`` read straight from the files of ``state``."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"state_bucket=(\d+)", 1).cast("int")
    placed = rows.withColumn("bucket", folder)
    has_key = [F.col(k).isNotNull() for k in state.keys]
    known = has_key[0]
    for one in has_key[1:]:
        known = known & one
    per_key = placed.groupBy("bucket", *state.keys).agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.groupBy("bucket").agg(
        F.count_if(known & (F.col("n") > 1)).alias("not_unique"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("without_key"),
        F.sum(F.when(state._bucket() == F.col("bucket"), 0).otherwise(F.col("n"))).alias("misplaced"),
    )
    heat = models.heat_complaints(placed, ["bucket"]).filter("heat_season is not null and bbl is not null")
    per_season = heat.groupBy("bucket", "heat_season").agg(F.count_if("is_no_heat").alias("total"))
    seasons = per_season.groupBy("bucket").agg(  # bounded by the calendar
        F.array_sort(F.collect_list(F.struct("heat_season", "total"))).alias("seasons")
    )
    return keys.join(seasons, "bucket", "left")


class KeptChecks:
    """Results per bucket of a state, following its commits."""

    def __init__(self, spark: SparkSession, path: str, state: LatestState):
        self.state = state
        # one small row a bucket; a later pass over the same commit replaces an earlier one
        self._kept = LatestState(spark, path, T.StructType.fromDDL(SCHEMA), ["bucket"], ["as_of", "pass"], 1)

    def _followed(self) -> int:
        newest = self._kept.current().agg(F.max("as_of")).first()[0]
        return -1 if newest is None else newest

    def refresh(self, everything: bool = False) -> None:
        """Check the buckets rewritten since the commit followed last, or all of them."""
        done, last = self._followed(), self.state.last_batch()
        if last == -1 or (done == last and not everything):
            return
        changed = None if everything else self.state.changed(done)
        rows = self.state.changed(-1)[1] if changed is None else changed[1]
        if not rows.inputFiles():
            return
        number = self._kept.last_batch() + 1
        found = by_bucket(rows, self.state).withColumns(
            {"as_of": F.lit(last).cast("bigint"), "pass": F.lit(number).cast("bigint")}
        )
        self._kept.upsert(found, number)

    def results(self) -> DataFrame:
        """One row per bucket."""
        return self._kept.current()

    def season_totals(self) -> DataFrame:
        """Complaints per season that the analysis table may count at most."""
        each = self.results().select(F.inline("seasons"))
        return each.groupBy("heat_season").agg(F.sum("total").alias("fact_total"))

    def checks(self, mart: DataFrame) -> list[quality.Check]:
        """The checks of the state's table, and that ``mart`` counts no complaint that is not there."""
        kept = self.results()
        failing = lambda column: F.coalesce(F.sum(column), F.lit(0).cast("bigint"))
        return [
            quality.Failing("stg_complaints.complaint_id unique", kept, failing(F.col("not_unique") + F.col("misplaced"))),
            quality.Failing("stg_complaints.complaint_id not null", kept, failing("without_key")),
            quality.Offending("lot_season_mart invents nothing", quality.beyond(mart, self.season_totals())),
        ]
