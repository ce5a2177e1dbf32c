"""The daily run: load raw files, build the models, check them, publish, export.

Newly loaded complaints are merged into the kept newest version of each; a run reads
that state, not the whole raw history. The counts behind the mart follow each merge by its
difference, and the checks of the state look at what it rewrote. A build goes to its own folder. It becomes the
published one only when every check passed, by moving a bookmark; otherwise readers
keep the previous build. Builds before the published one are removed, but for a few.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ..functions import labels as lb
from ..operators import quality
from ..sources import export
from ..sources.files import delete, folders
from ..sources.raw import RawTable
from ..sources.state import Bookmark
from ..streaming.upsert import LatestState
from . import models, reports
from .deltas import SeasonCounts
from .kept_checks import KeptChecks

TABLES = ("stg_complaints", "stg_properties", "property_lots", "lot_dimension", "complaint_fact", "lot_season_mart")


class Run(NamedTuple):
    build: int
    published: bool
    checks: DataFrame


class DailyRun:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 256, builds_kept: int = 2):
        """``buckets``: parts of the complaint state, fixed once chosen; about one per GB of it."""
        self.spark, self.root = spark, root
        self.complaints = RawTable(spark, f"{root}/raw/complaints")
        self.properties = RawTable(spark, f"{root}/raw/properties")
        typed = models.type_complaints(self.complaints.rows())
        self.state = LatestState(
            spark, f"{root}/state/complaints", typed.schema, ["complaint_id"], models.COMPLAINT_ORDER, buckets
        )
        self.counts = SeasonCounts(spark, f"{root}/state/season_counts", self.state, max(1, buckets // 4))
        self.kept = KeptChecks(spark, f"{root}/state/checks", self.state)
        self.builds_kept = builds_kept
        self.pointer = Bookmark(spark, f"{root}/published")
        self.attempts = Bookmark(spark, f"{root}/attempts")

    def load(self, complaint_stage: str, property_stage: str, loaded_at: str | None = None) -> dict[str, int]:
        """Load new files of both stages; safe to run any number of times."""
        loaded = {
            "complaints": self.complaints.load(complaint_stage, loaded_at),
            "properties": self.properties.load(property_stage, loaded_at),
        }
        self._merge()
        return loaded

    def _merge(self) -> None:
        """Bring the complaint state up to the last loaded batch, all batches at once."""
        self._follow()  # a crash may have left them one commit behind
        done, last = self.state.last_batch(), self.complaints.last_batch()
        if last > max(done, 0):
            self.state.upsert(models.type_complaints(self.complaints.rows(after=done)), last)
            self._follow()

    def _follow(self) -> None:
        self.counts.refresh()
        self.kept.refresh()

    def _path(self, build: int, name: str) -> str:
        return f"{self.root}/builds/{build}/{name}"

    def _write(self, build: int, name: str, df: DataFrame) -> DataFrame:
        path = self._path(build, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def build(self, build: int) -> dict[str, DataFrame]:
        """Write every model once; later models read the written earlier ones."""
        done: dict[str, DataFrame] = {}

        def keep(name: str, df: DataFrame) -> None:
            done[name] = self._write(build, name, df)

        keep("stg_properties", models.build_stg_properties(self.properties.rows()))
        keep("property_lots", models.build_property_lots(done["stg_properties"], ["address"]))
        keep("lot_dimension", models.build_lot_dimension(done["property_lots"]))
        keep("stg_complaints", self.state.current())
        fact = models.build_complaint_fact(
            done["stg_complaints"], done["stg_properties"], ["latitude", "longitude"]
        )
        keep("complaint_fact", fact)
        keep("lot_season_mart", self.counts.mart(done["stg_properties"], done["lot_dimension"]))
        return done

    def run(self, publish_anyway: bool = False) -> Run:
        """Build, check, and move the pointer only if the checks pass."""
        self._follow()
        build = self.attempts.next_batch()
        self.attempts.set(str(build))
        tables = self.build(build)
        checks = self._write(build, "checks", quality.run_checks(model_checks(tables, self.kept)))
        published = publish_anyway or quality.may_publish(checks)
        if published:
            self.pointer.set(str(build))
        self._drop_old_builds(build)
        return Run(build, published, checks)

    def _drop_old_builds(self, newest: int) -> None:
        """Keep the published build and the newest ``builds_kept``."""
        published = self.pointer.get()
        for name in folders(self.spark, f"{self.root}/builds"):
            if int(name) <= newest - self.builds_kept and name != published:
                delete(self.spark, f"{self.root}/builds/{name}")

    def published(self) -> dict[str, DataFrame]:
        """Tables of the published build; empty before the first."""
        build = self.pointer.get()
        if build is None:
            return {}
        names = (*TABLES, "checks")
        return {n: self.spark.read.parquet(self._path(int(build), n)) for n in names}

    def export(self, out: str, built_at: str) -> None:
        """Publish the dashboard's files from the published build."""
        tables = self.published()
        fact, mart = tables["complaint_fact"], tables["lot_season_mart"]
        export.write_columnar(reports.daily_counts(fact), ["d", "boro"], f"{out}/daily")
        export.write_columnar(
            reports.season_region_rollup(fact), ["season", "boro"], f"{out}/season_region"
        )
        reports.grid_counts(fact).write.mode("overwrite").partitionBy("season").json(f"{out}/map")
        labels = reports.lot_labels(tables["property_lots"])
        export.write_per_season(reports.export_lots(mart, labels), f"{out}/lots")
        reports.export_meta(fact, mart).write.mode("overwrite").json(f"{out}/meta")
        summary = quality.run_summary(tables["checks"], len(TABLES), built_at)
        summary.write.mode("overwrite").json(f"{out}/run")


def model_checks(tables: dict[str, DataFrame], kept: KeptChecks | None = None) -> list[quality.Check]:
    """The checks every build must pass.

    With ``kept`` results, those of the complaints read only the buckets that loads rewrote,
    and the fact is not read for the totals of the seasons.
    """
    stg, props = tables["stg_complaints"], tables["stg_properties"]
    lots, dim = tables["property_lots"], tables["lot_dimension"]
    fact, mart = tables["complaint_fact"], tables["lot_season_mart"]
    keys = {
        "stg_properties": (props, "property_year_id"),
        "lot_dimension": (dim, "lot_year_id"),
        "complaint_fact": (fact, "complaint_id"),
        "lot_season_mart": (mart, "lot_season_id"),
    }
    if kept is None:
        keys = {"stg_complaints": (stg, "complaint_id"), **keys}
        checks = [quality.Offending("lot_season_mart invents nothing", quality.check_no_fan_out(mart, fact))]
    else:
        checks = kept.checks(mart)
    for name, (df, key) in keys.items():
        checks.append(quality.Offending(f"{name}.{key} unique", quality.check_unique(df, key)))
        checks.append(quality.Failing(f"{name}.{key} not null", df, quality.nulls(key)))
    return checks + [
        quality.Failing("stg_properties.report_year not null", props, quality.nulls("report_year")),
        quality.Failing("property_lots.bbl not null", lots, quality.nulls("bbl")),
        quality.Failing("lot_dimension.band accepted", dim, quality.odd_values("energy_star_band", lb.SCORE_BANDS)),
        quality.Failing("lot_dimension.era accepted", dim, quality.odd_values("era", lb.ERAS)),
        quality.Failing("lot_dimension.score in range", dim, quality.outside("energy_star_score", 1, 100)),
    ]
