"""The registered queries: every operator and model bound to the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import keys
from ..functions import labels as lb
from ..functions.casts import (
    in_or_false,
    null_if_any,
    try_int_rounded,
    try_num,
    try_ts,
    try_whole,
    utc_wall_clock,
)
from ..operators import digests, joins, latest, lots, postings, profile, quality, ranks, sketches, stats
from ..session import materialize, materialize_all, work_dir
from ..sources import export, extract, raw
from ..sources.files import folders, replace, versions
from ..sources.state import Bookmark
from ..streaming.upsert import LatestState
from . import bindings, models, reports
from .daily import TABLES, model_checks
from .deltas import SeasonCounts
from .kept_checks import KeptChecks

Query = Callable[[SparkSession, str], DataFrame]

BACKFILL_START, BACKFILL_END = "1996-01-01", "1996-02-01"
MONTHS_FROM, MONTHS_BEFORE, TODAY = "1994-10", "2001-09-01", "2001-08-04"
WINDOW = ("1996-01-01", "1996-01-31", 1994)
POINTS = 20_000  # points drawn per season
EVENTS_NOW = "2024-02-04 12:00:00"


class Landing(dict):
    """Raw tables of VARIANT records by name, each stored when it is first asked for."""

    def __init__(self, **raw: Callable[[], DataFrame]):
        super().__init__()
        self._raw = raw

    def __missing__(self, name: str) -> DataFrame:
        self.store(name)
        return self[name]

    def store(self, *names: str) -> None:
        """Store those of ``names`` that are not yet there, at the same time."""
        new = {name: bindings.as_variant(self._raw[name]()) for name in names if name not in self}
        if new:
            self.update(materialize_all(**new))


class Tables:
    """Lazy models of one data folder, and the stored tables that reports read.

    Raw records are landed once per folder. Model queries build from them every
    time. Reports share the stored fact, lots, dimension and mart, as dashboards
    share a warehouse's.
    """

    _known: dict[tuple[str, str], tuple[list, Tables]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Tables:
        at = (spark.sparkContext.applicationId, sf_dir)
        now = versions(spark, sf_dir)  # changed files make the stored tables stale
        if at not in cls._known or cls._known[at][0] != now:
            cls._known[at] = (now, cls(spark, sf_dir))
        return cls._known[at][1]

    def read(self, table: str) -> DataFrame:
        return bindings.read(self.spark, self.sf_dir, table)

    @property
    def rc(self) -> DataFrame:
        return bindings.raw_complaints(self.spark, self.sf_dir)

    @property
    def rp(self) -> DataFrame:
        return bindings.raw_properties(self.spark, self.sf_dir).withColumnsRenamed(
            {"nyc_borough_block_and_lot": "bbl_raw"}
        )

    @cached_property
    def landed(self) -> Landing:
        """The two raw tables of VARIANT records, stored as the loader leaves them."""
        return Landing(
            complaints=lambda: self.rc, properties=lambda: bindings.raw_properties(self.spark, self.sf_dir)
        )

    @property
    def stg(self) -> DataFrame:
        return models.build_stg_complaints(self.landed["complaints"])

    @cached_property
    def typed_properties(self) -> DataFrame:
        return models.type_properties(self.landed["properties"])

    @property
    def props(self) -> DataFrame:
        return models.newest_per_property(self.typed_properties)

    def build_lots(self) -> DataFrame:
        return models.build_property_lots(self.props, ["address"])

    def build_fact(self) -> DataFrame:
        self.landed.store("complaints", "properties")
        return models.build_complaint_fact(
            self.stg, self.typed_properties, ["latitude", "longitude"]
        )

    def build_dim(self) -> DataFrame:
        return models.build_lot_dimension(self.build_lots())

    @cached_property
    def _stored(self) -> dict[str, DataFrame]:
        return materialize_all(fact=self.build_fact(), lots=self.build_lots())

    @property
    def fact(self) -> DataFrame:
        return self._stored["fact"]

    @property
    def lots(self) -> DataFrame:
        return self._stored["lots"]

    @cached_property
    def dim(self) -> DataFrame:
        return materialize(models.build_lot_dimension(self.lots), "dim")

    @cached_property
    def mart(self) -> DataFrame:
        mart = models.build_lot_season_mart(self.fact, self.dim, dim_is_stored=True)
        return materialize(mart, "mart")

    @cached_property
    def daily(self) -> DataFrame:
        return materialize(reports.daily_counts(self.fact), "daily")

    @property
    def seasons(self) -> DataFrame:
        return self.fact.filter(F.col("heat_season").isNotNull())

    @property
    def scored(self) -> DataFrame:
        return reports.scored_lots(self.mart)


REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables.of(spark, sf_dir))

    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def rounded(df: DataFrame, *columns: str, scale: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c in columns})


# ---------------------------------------------------------------- models


@query
def stg_complaints(t: Tables) -> DataFrame:
    return t.stg.select(
        "complaint_id",
        "created_at",
        "closed_at",
        "status",
        "complaint_type",
        "descriptor_detail",
        "borough",
        "bbl",
        *[F.round(c, 4).alias(c) for c in ("latitude", "longitude")],
        utc_wall_clock("source_updated_at").alias("source_updated_at"),
        "last_seen_in",
        "loaded_at",
    )


@query
def stg_properties(t: Tables) -> DataFrame:
    staged = models.build_stg_properties(t.landed["properties"])
    return staged.select(
        "property_year_id",
        "report_year",
        "property_id",
        "property_name",
        "bbl_raw",
        "primary_property_type",
        "year_built",
        "energy_star_score",
        "gfa_sqft",
        "address",
        "report_generated_at",
        "source_file",
        "loaded_at",
    )


@query
def property_lots(t: Tables) -> DataFrame:
    return rounded(models.build_property_lots(t.props), "gfa_share_sqft")


@query
def lot_dimension(t: Tables) -> DataFrame:
    return rounded(t.build_dim(), "total_gfa_sqft", "scored_gfa_sqft")


@query
def complaint_fact(t: Tables) -> DataFrame:
    return models.build_complaint_fact(t.stg, t.typed_properties).drop("zip_code")


@query
def lot_season_mart(t: Tables) -> DataFrame:
    fact = models.build_complaint_fact(t.stg, t.typed_properties)
    mart = models.build_lot_season_mart(fact, t.build_dim())
    return rounded(mart, "total_gfa_sqft", "no_heat_per_100k_sqft")


@query
def lots_export(t: Tables) -> DataFrame:
    return reports.export_lots(t.mart, reports.lot_labels(t.lots))


@query
def lots_files(t: Tables) -> DataFrame:
    """The published row files of every season, read back."""
    lots = reports.export_lots(t.mart, reports.lot_labels(t.lots))
    target = f"{work_dir(t.spark)}/lots-{uuid.uuid4().hex}"
    export.write_per_season(lots, target)
    return t.spark.read.schema(lots.schema).json(target).select(lots.columns)


# ---------------------------------------------------------------- extraction and loading


@query
def incremental_extract(t: Tables) -> DataFrame:
    source = t.rc.withColumn("updated_at", utc_wall_clock(try_ts("`:updated_at`", zoned=True)))
    found = extract.extract_since(
        source, "updated_at", bindings.FIRST_LOAD, F.col("complaint_type") == lb.HEAT_TYPE
    )
    return found.rows.select("unique_key", "updated_at")


@query
def reconcile_counts(t: Tables) -> DataFrame:
    heat = t.rc.filter(F.col("complaint_type") == lb.HEAT_TYPE)
    return extract.reconcile_report(t.rc, heat, "source_file")


@query
def backfill_window(t: Tables) -> DataFrame:
    start, end = (F.lit(d).cast("timestamp_ntz") for d in (BACKFILL_START, BACKFILL_END))
    window = extract.between_half_open(t.stg, "created_at", start, end)
    return window.select(F.col("complaint_id").alias("unique_key"), "created_at")


@query
def month_windows(t: Tables) -> DataFrame:
    return extract.month_windows_of(t.read("orders"), "o_orderdate")


@query
def backfill_month_counts(t: Tables) -> DataFrame:
    target = f"{work_dir(t.spark)}/backfill-{uuid.uuid4().hex}"
    return raw.backfill(t.stg, "created_at", target, f"{MONTHS_FROM}-01", MONTHS_BEFORE)


@query
def load_year_counts(t: Tables) -> DataFrame:
    target = f"{work_dir(t.spark)}/property-years-{uuid.uuid4().hex}"
    return raw.load_years(latest.latest_load(t.rp), target)


@query
def available_years(t: Tables) -> DataFrame:
    return extract.distinct_values(t.rp, "report_year")


@query
def nested_to_json(t: Tables) -> DataFrame:
    parsed = F.from_json("props", "k int").alias("props_json")
    return raw.nested_to_json(t.read("events").select("event_id", parsed))


@query
def scan_with_lineage(t: Tables) -> DataFrame:
    scanned = raw.scan_with_lineage(t.spark, f"{t.sf_dir}/orders.parquet")
    return scanned.select("o_orderkey", raw.base_name(F.col("source_file")).alias("source_file"))


@query
def rows_per_file(t: Tables) -> DataFrame:
    return raw.rows_per_file(t.rp)


@query
def columnar_export(t: Tables) -> DataFrame:
    return export.to_columnar(t.daily, ["d", "boro"])


@query
def columnar_import(t: Tables) -> DataFrame:
    return export.from_columnar(export.to_columnar(t.daily, ["d", "boro"]))


@query
def export_meta(t: Tables) -> DataFrame:
    return reports.export_meta(t.fact, t.mart)


@query
def incremental_ingest(t: Tables) -> DataFrame:
    """Two runs against a source that was republished in between; rows landed per run."""
    source = t.rc.withColumn("updated_at", utc_wall_clock(try_ts("`:updated_at`", zoned=True)))
    source = source.drop(":updated_at")
    folder = f"{work_dir(t.spark)}/ingest-{uuid.uuid4().hex}"
    mark = Bookmark(t.spark, f"{folder}/bookmark")
    first = source.filter(F.col("updated_at") <= F.lit(bindings.FIRST_LOAD).cast("timestamp_ntz"))
    for day, published in ((bindings.FIRST_LOAD, first), (bindings.SECOND_LOAD, source)):
        raw.ingest(published, "updated_at", f"{folder}/raw", mark, run_date=day)
    landed = t.spark.read.parquet(f"{folder}/raw")
    return profile.counts_by(landed, [F.col("dt").cast("string").alias("dt")])


@query
def ledger_load(t: Tables) -> DataFrame:
    """Property files loaded through the ledger, twice: the second load finds nothing new."""
    folder = f"{work_dir(t.spark)}/ledger-{uuid.uuid4().hex}"
    stage = f"{folder}/stage"
    files = t.rp.drop("source_file", "loaded_at").withColumn("year", F.col("report_year"))
    files.write.partitionBy("year").parquet(stage)
    table = raw.RawTable(t.spark, f"{folder}/table")
    table.load(stage, bindings.SECOND_LOAD)
    table.load(stage, bindings.SECOND_LOAD)
    year = models.field(table.rows(), "report_year").alias("report_year")
    return raw.rows_per_file(table.rows().select(year, "loaded_at"), "report_year")


@query
def ledger_reload(t: Tables) -> DataFrame:
    """Files whose types disagree, of which the last year's are overwritten in place with other
    scores and loaded again under the same time stamp: rows, scores and their sum of each year.
    """
    folder = f"{work_dir(t.spark)}/reload-{uuid.uuid4().hex}"
    rows = t.rp.drop("source_file", "loaded_at")
    score = F.col("energy_star_score")
    kinds = {"1993": score.try_cast("int"), "1994": F.lit(None).cast("int")}  # numbers; no value at all
    for year, as_typed in kinds.items():
        typed = rows.filter(F.col("report_year") == year).withColumn("energy_star_score", as_typed)
        typed.write.parquet(f"{folder}/stage/{year}")
    text = rows.filter(~F.col("report_year").isin(*kinds)).withColumn("year", F.col("report_year"))
    text.write.partitionBy("year").parquet(f"{folder}/stage/text")
    table = raw.RawTable(t.spark, f"{folder}/table")
    table.load(f"{folder}/stage", bindings.SECOND_LOAD)
    # files keep their names, as a publisher's do: each one's rows are those of its former version
    last = f"{folder}/stage/text/year={bindings.LAST_YEAR}"
    old = t.spark.read.parquet(last).withColumn("_name", raw.base_name(F.col("_metadata.file_path")))
    changed = old.withColumn("energy_star_score", (score.try_cast("int") + 1).cast("string"))
    changed.repartition("_name").write.partitionBy("_name").parquet(f"{folder}/changed")
    for name in folders(t.spark, f"{folder}/changed"):
        (new,) = [p for p, *_ in versions(t.spark, f"{folder}/changed/{name}") if p.endswith(".parquet")]
        replace(t.spark, new, f"{last}/{name.removeprefix('_name=')}")
    table.load(f"{folder}/stage", bindings.SECOND_LOAD)
    newest = latest.latest_load(table.rows())
    from_path = F.regexp_extract("source_file", r"(?:/|year=)(\d{4})/[^/]*$", 1)
    found = models.field(newest, "energy_star_score")
    return newest.groupBy(from_path.alias("report_year")).agg(
        F.count(F.lit(1)).alias("n"), F.count(found).alias("scores"), F.sum(found.try_cast("int")).alias("score_sum")
    )


@query
def upsert_latest(t: Tables) -> DataFrame:
    """The current state kept by a file stream that delivers the monthly, then the daily files."""
    folder = f"{work_dir(t.spark)}/upsert-{uuid.uuid4().hex}"
    versions = t.rc.select(
        "unique_key",
        "status",
        try_ts("`:updated_at`", zoned=True).alias("updated"),
        "source_file",
    )
    state = LatestState(
        t.spark, f"{folder}/state", versions.schema, ["unique_key"], ["updated", "source_file"], 16
    )
    daily = F.col("source_file") == bindings.DAILY_FILE
    for part in (versions.filter(~daily), versions.filter(daily)):
        part.write.mode("append").parquet(f"{folder}/stage")
        stream = t.spark.readStream.schema(versions.schema).parquet(f"{folder}/stage")
        state.follow(stream, f"{folder}/checkpoint").awaitTermination()
    return state.current().select("unique_key", "status", "source_file")


def loaded_twice(t: Tables, name: str, follow: Callable[[str, LatestState], Any]) -> Any:
    """What follows a complaint state, after two loads: the monthly files, then the daily one."""
    folder = f"{work_dir(t.spark)}/{name}-{uuid.uuid4().hex}"
    typed = models.type_complaints(t.landed["complaints"])
    state = LatestState(
        t.spark, f"{folder}/state", typed.schema, ["complaint_id"], models.COMPLAINT_ORDER, 16
    )
    following = follow(f"{folder}/{name}", state)
    daily = F.col("last_seen_in") == bindings.DAILY_FILE
    for batch, part in enumerate((typed.filter(~daily), typed.filter(daily))):
        state.upsert(part, batch)
        following.refresh()
    return following


def followed_counts(t: Tables) -> SeasonCounts:
    """Counts kept by the differences of two loads."""
    return loaded_twice(t, "counts", lambda path, state: SeasonCounts(t.spark, path, state, 4))


@query
def incremental_season_counts(t: Tables) -> DataFrame:
    """Complaints per season and lot by differences, with the days of each season."""
    counts = followed_counts(t)
    days = counts.days().groupBy("heat_season").agg(F.count(F.lit(1)).alias("days"))
    return counts.lots().drop("heating_year_start").join(days, "heat_season")


@query
def incremental_mart(t: Tables) -> DataFrame:
    """The analysis table from counts kept by differences."""
    t.landed.store("complaints", "properties")
    mart = followed_counts(t).mart(t.typed_properties, t.dim)
    return rounded(mart, "total_gfa_sqft", "no_heat_per_100k_sqft")


@query
def union_by_name(t: Tables) -> DataFrame:
    daily = F.col("source_file") == bindings.DAILY_FILE
    monthly = t.rc.filter(~daily).select("unique_key", "source_file")
    return joins.union_all(
        monthly, t.rc.filter(daily).select("unique_key", "status", "source_file")
    ).select("unique_key", "status", "source_file")


@query
def deleted_keys(t: Tables) -> DataFrame:
    listed = t.rc.filter(F.col("source_file") == bindings.DAILY_FILE)
    return joins.missing_in_source(
        t.stg, listed.withColumnRenamed("unique_key", "complaint_id"), "complaint_id"
    )


@query
def deleted_keys_by_digest(t: Tables) -> DataFrame:
    """The keys of ``deleted_keys``, of which only differing buckets were moved."""
    listed = t.rc.filter(F.col("source_file") == bindings.DAILY_FILE)
    return digests.missing_by_digest(
        t.stg.select("complaint_id"), listed.withColumnRenamed("unique_key", "complaint_id"), "complaint_id"
    )


@query
def sketched_lots(t: Tables) -> DataFrame:
    """Distinct lots per season and region, and whether merged daily sketches come within their bound."""
    placed = t.seasons.filter(F.col("bbl").isNotNull())
    days = sketches.distinct_sketches(placed, ["heat_season", "borough", "created_date"], "bbl")
    keys = ["heat_season", "borough"]
    exact = placed.groupBy(*keys).agg(F.count_distinct("bbl").alias("lots"))
    close = F.abs(F.col("estimate") - F.col("lots")) <= F.col("lots") * sketches.distinct_error()
    both = exact.join(sketches.merge_distinct(days, keys, "estimate"), keys)
    return both.select(*keys, "lots", close.alias("within_bound"))


@query
def sketched_closing_times(t: Tables) -> DataFrame:
    """Closed complaints per season, and whether the merged daily sketches' median has a rank within its bound."""
    hours = F.timestamp_diff("MINUTE", F.col("created_at"), F.col("closed_at")) / 60
    closed = t.seasons.withColumn("hours", hours).filter(F.col("hours").isNotNull())
    days = sketches.quantile_sketches(closed, ["heat_season", "created_date"], "hours")
    middle = sketches.merge_quantiles(days, ["heat_season"], 0.5, "median")
    ranked = closed.join(middle, "heat_season").groupBy("heat_season").agg(
        F.count(F.lit(1)).alias("closed"),
        F.count_if(F.col("hours") < F.col("median")).alias("below"),
        F.count_if(F.col("hours") <= F.col("median")).alias("upto"),
    )
    slack = F.col("closed") * sketches.rank_error() + 1
    half = F.col("closed") / 2
    near = (F.col("below") <= half + slack) & (F.col("upto") >= half - slack)
    return ranked.select("heat_season", "closed", near.alias("within_bound"))


@query
def completeness_by_month(t: Tables) -> DataFrame:
    month = cal.month_label(try_ts("created_date")).alias("month")
    got = t.rc.filter(F.col("source_file") == bindings.DAILY_FILE)
    first = t.rc.filter(F.col("source_file") != bindings.DAILY_FILE)
    return joins.completeness(first.select(month), got.select(month), "month")


# ---------------------------------------------------------------- columns


@query
def variant_projection(t: Tables) -> DataFrame:
    record = F.parse_json("props").alias("record")
    events = t.read("events").select("event_id", record)
    return events.select("event_id", try_num(models.field(events, "k"), "long").alias("k"))


@query
def tolerant_cast(t: Tables) -> DataFrame:
    return t.rp.select(
        "property_id",
        try_whole("report_year").alias("report_year"),
        try_int_rounded("energy_star_score").alias("score"),
        try_int_rounded("year_built").alias("year_built"),
        try_num("property_gfa_self_reported").alias("gfa"),
    )


@query
def tolerant_timestamps(t: Tables) -> DataFrame:
    return t.rc.select(
        "unique_key",
        try_ts("created_date").alias("created_at"),
        try_ts("closed_date").alias("closed_at"),
        utc_wall_clock(try_ts("`:updated_at`", zoned=True)).alias("updated_at"),
        try_ts("status").alias("junk"),
    )


@query
def sentinel_nulls(t: Tables) -> DataFrame:
    return t.rp.select(
        "property_id",
        "report_year",
        null_if_any("energy_star_score", lb.MISSING).alias("score_text"),
        null_if_any("year_built", lb.MISSING, "0").alias("year_text"),
    )


@query
def explode_lot_keys(t: Tables) -> DataFrame:
    return lots.explode_split(t.rp, "bbl_raw").select("report_year", "property_id", "piece")


@query
def normalize_lot_keys(t: Tables) -> DataFrame:
    return lots.explode_keys(t.props, "bbl_raw").select("report_year", "property_id", "bbl")


@query
def valid_lot_key(t: Tables) -> DataFrame:
    return t.rc.select("unique_key", keys.key_or_null("bbl").alias("bbl"))


@query
def no_heat_flag(t: Tables) -> DataFrame:
    heat = t.rc.filter(F.col("complaint_type") == lb.HEAT_TYPE)
    flag = in_or_false("descriptor_2", lb.NO_HEAT)
    return heat.select("unique_key", flag.alias("is_no_heat"))


@query
def heat_season_calendar(t: Tables) -> DataFrame:
    return t.stg.select(
        "complaint_id",
        cal.season_start_year("created_at").alias("heating_year_start"),
        cal.season_label("created_at").alias("heat_season"),
    )


@query
def season_bounds(t: Tables) -> DataFrame:
    start, end = cal.season_bounds("heat_season")
    return t.seasons.select("heat_season").distinct().select(
        "heat_season",
        start.alias("season_start"),
        end.alias("season_end"),
        cal.prev_season("heat_season").alias("prev_season"),
    )


@query
def asof_report_year(t: Tables) -> DataFrame:
    fact = models.build_complaint_fact(t.stg, t.typed_properties)
    return fact.select("complaint_id", "ll84_report_year")


@query
def score_bands(t: Tables) -> DataFrame:
    return t.dim.select("lot_year_id", lb.score_band("energy_star_score").alias("band"))


@query
def score_bands_cut(t: Tables) -> DataFrame:
    # scaled up, so that some scores leave the closed range
    return t.dim.select("lot_year_id", lb.score_band_cut(F.col("energy_star_score") * 1.25).alias("band"))


@query
def era_bands(t: Tables) -> DataFrame:
    return t.dim.select(
        "lot_year_id",
        lb.era("year_built").alias("era"),
        lb.era_cut(F.col("year_built") + 20).alias("era_cut"),
        lb.ordinal(lb.era("year_built"), lb.ERAS).alias("era_order"),
    )


@query
def region_name(t: Tables) -> DataFrame:
    return t.stg.select("complaint_id", lb.region_name(keys.key_or_null("bbl"), "borough").alias("boro"))


@query
def title_case(t: Tables) -> DataFrame:
    text = F.concat_ws(" ", "p_name", F.concat("p_type", F.lit("/east-o'neil")))
    return t.read("part").select("p_partkey", lb.title_case(text).alias("title"))


@query
def close_hours(t: Tables) -> DataFrame:
    minutes = cal.close_minutes("created_at", "closed_at")
    return t.stg.select("complaint_id", F.round(minutes / 60, 4).alias("hours"))


@query
def rate_per_100k(t: Tables) -> DataFrame:
    rate = lb.rate("no_heat_complaints", "total_gfa_sqft")
    return t.mart.select("lot_season_id", F.round(rate, 4).alias("rate"))


# ---------------------------------------------------------------- deduplication and lots


@query
def dedup_latest(t: Tables) -> DataFrame:
    versions = t.rc.withColumn("updated", try_ts("`:updated_at`", zoned=True))
    return latest.latest_by(versions, ["unique_key"], ["updated", "source_file"]).select(
        "unique_key", "status", "source_file"
    )


@query
def latest_load(t: Tables) -> DataFrame:
    return latest.latest_load(t.rp).select("property_id", "report_year", "loaded_at")


@query
def dedup_property_year(t: Tables) -> DataFrame:
    return t.props.select("property_year_id", "energy_star_score")


@query
def even_split(t: Tables) -> DataFrame:
    exploded = t.lots.drop("n_lots", "gfa_share_sqft")
    split = lots.even_split(exploded, ["report_year", "property_id"], "gfa_sqft")
    return rounded(
        split.select("report_year", "property_id", "bbl", "n_lots", "gfa_share_sqft"), "gfa_share_sqft"
    )


@query
def weighted_score(t: Tables) -> DataFrame:
    return lots.weighted_mean(t.lots, ["report_year", "bbl"], "energy_star_score", "gfa_share_sqft")


@query
def biggest_per_lot(t: Tables) -> DataFrame:
    top = latest.top_per(t.lots, ["report_year", "bbl"], "gfa_share_sqft", "property_id")
    return top.select("report_year", "bbl", "property_id", "year_built")


@query
def lot_address(t: Tables) -> DataFrame:
    return reports.lot_labels(t.lots)


# ---------------------------------------------------------------- profiling


@query
def key_format_census(t: Tables) -> DataFrame:
    return profile.format_census(t.rp, "bbl_raw")


@query
def key_format_unknown(t: Tables) -> DataFrame:
    return profile.unknown_formats(t.rp, "bbl_raw")


@query
def key_fill_rate(t: Tables) -> DataFrame:
    return profile.fill_rate(t.stg, ["bbl", "descriptor_detail", "closed_at"])


@query
def category_counts(t: Tables) -> DataFrame:
    return profile.category_counts(t.stg, "descriptor_detail")


@query
def duplicated_keys(t: Tables) -> DataFrame:
    return profile.duplicated(t.rp, ["report_year", "bbl_raw"])


@query
def duplicated_rows(t: Tables) -> DataFrame:
    rows = profile.duplicated_rows(t.rp, ["report_year", "bbl_raw"])
    return rows.select("report_year", "bbl_raw", "property_id")


@query
def newest_rows(t: Tables) -> DataFrame:
    return profile.newest(t.read("events"), "ts", 5, "event_id").select("event_id", "ts")


@query
def random_points(t: Tables) -> DataFrame:
    points = profile.sample_rows(reports.season_points(t.fact), POINTS, 7, "complaint_id", ["season"])
    return rounded(points, "lat", "lon")


@query
def fact_coordinates(t: Tables) -> DataFrame:
    placed = reports.with_coordinates(t.fact.drop("latitude", "longitude"), t.stg)
    return rounded(placed.select("complaint_id", "latitude", "longitude"), "latitude", "longitude")


def lot_counts(t: Tables) -> DataFrame:
    cold = t.fact.filter("is_no_heat")
    return profile.counts_by(cold, ["bbl"], "complaints")


@query
def no_heat_by_lot(t: Tables) -> DataFrame:
    first, last, _ = WINDOW
    day = F.col("created_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return profile.counts_by(t.fact.filter(F.col("is_no_heat") & day), ["bbl"], "complaints")


@query
def match_rates(t: Tables) -> DataFrame:
    return joins.match_rates(lot_counts(t), t.lots, "bbl", "complaints", "normalized")


@query
def match_rates_before_after(t: Tables) -> DataFrame:
    unnormalized = t.props.select(F.col("bbl_raw").alias("bbl"))
    return joins.match_rates(lot_counts(t), unnormalized, "bbl", "complaints", "raw").unionAll(
        joins.match_rates(lot_counts(t), t.lots, "bbl", "complaints", "normalized")
    )


# ---------------------------------------------------------------- ranks


@query
def size_quartile(t: Tables) -> DataFrame:
    scored = t.dim.filter("has_energy_star_score")
    ranked = ranks.ntile_by(scored, ["report_year"], "total_gfa_sqft", "bbl", 4, "size_quartile")
    return ranked.select("lot_year_id", "size_quartile")


@query
def size_qcut(t: Tables) -> DataFrame:
    scored = t.dim.filter("has_energy_star_score")
    binned = ranks.qcut(scored, ["report_year"], "total_gfa_sqft", lb.QCUT_LABELS, "size_band")
    return binned.select("lot_year_id", "size_band")


@query
def peer_comparison(t: Tables) -> DataFrame:
    return reports.peer_comparison(reports.report_lots(t.mart))


@query
def grid_hotspots(t: Tables) -> DataFrame:
    return reports.grid_counts(t.fact)


@query
def hotspot_classes(t: Tables) -> DataFrame:
    return reports.hotspot_classes(materialize(reports.grid_counts(t.fact), "cells"))


# ---------------------------------------------------------------- counts and rates


@query
def daily_region_counts(t: Tables) -> DataFrame:
    return reports.daily_counts(t.fact)


@query
def monthly_counts(t: Tables) -> DataFrame:
    return reports.monthly_counts(t.fact)


@query
def counts_by_lot_season(t: Tables) -> DataFrame:
    return models.lot_season_counts(t.fact)


@query
def season_completeness(t: Tables) -> DataFrame:
    coverage = models.season_coverage(materialize(models.season_facts(t.fact), "season-facts"))
    return coverage.select("heat_season", "is_season_complete")


@query
def season_lots(t: Tables) -> DataFrame:
    seasons = t.seasons.select(*models.SEASON).distinct()
    joined = models.season_lots(seasons, t.dim)
    return joined.select("heat_season", F.col("ll84_report_year").alias("report_year"), "bbl")


@query
def season_region_rollup(t: Tables) -> DataFrame:
    return reports.season_region_rollup(t.fact)


@query
def season_summary(t: Tables) -> DataFrame:
    return reports.season_summary(t.mart)


@query
def season_kpis(t: Tables) -> DataFrame:
    return reports.season_kpis(t.fact, t.mart)


@query
def latest_complete_season(t: Tables) -> DataFrame:
    return reports.pick_season(t.mart)


@query
def rates_by_band(t: Tables) -> DataFrame:
    return reports.rates_by_band(t.scored)


@query
def rates_by_size(t: Tables) -> DataFrame:
    return reports.split_rates(t.scored, "size", list(lb.SIZE_LABELS.values()))


@query
def rates_by_era(t: Tables) -> DataFrame:
    return reports.split_rates(t.scored, "era", lb.ERAS)


@query
def rate_matrix(t: Tables) -> DataFrame:
    pooled = reports.pooled_rate(t.scored, ["heat_season", "size", "band"])
    return reports.rate_matrix(pooled, ["heat_season", "size"], "per_100k")


@query
def lots_matrix(t: Tables) -> DataFrame:
    dated = t.scored.filter(F.col("era").isNotNull())
    pooled = reports.pooled_rate(dated, ["heat_season", "era", "band"])
    return reports.rate_matrix(pooled, ["heat_season", "era"], "lots")


@query
def size_summary(t: Tables) -> DataFrame:
    return reports.size_summary(t.scored)


@query
def weekly_trend(t: Tables) -> DataFrame:
    return reports.weekly_trend(t.daily, t.seasons)


@query
def season_to_date(t: Tables) -> DataFrame:
    return reports.season_to_date(t.daily, t.seasons)


@query
def benchmarked_share(t: Tables) -> DataFrame:
    return reports.benchmarked_share(t.fact, reports.report_lots(t.mart))


@query
def band_effect(t: Tables) -> DataFrame:
    return reports.band_effect(reports.report_lots(t.mart), ["heat_season", "size_q"])


@query
def band_effect_verdict(t: Tables) -> DataFrame:
    dated = reports.report_lots(t.mart).filter(F.col("era").isNotNull())
    effects = reports.band_effect(dated, ["heat_season", "era"])
    return reports.effect_verdict(effects, ["heat_season"])


@query
def window_band_check(t: Tables) -> DataFrame:
    return reports.band_check(t.fact, t.dim, *WINDOW)


@query
def top_lots(t: Tables) -> DataFrame:
    return reports.top_lots(t.mart)


@query
def leaderboard(t: Tables) -> DataFrame:
    board = reports.leaderboard(reports.report_lots(t.mart), "no_heat", min_n=2, n=25)
    return rounded(board.select("heat_season", "bbl", "boro", "no_heat", "score", "rate"), "rate")


@query
def entity_search(t: Tables) -> DataFrame:
    exported = reports.export_lots(t.mart, reports.lot_labels(t.lots))
    by_text = reports.search(exported, " Widget ").withColumn("searched", F.lit("text"))
    by_key = reports.search(exported, "30").withColumn("searched", F.lit("key"))
    return by_text.unionAll(by_key).select("searched", "heat_season", "bbl", "no_heat")


@query
def entity_search_index(t: Tables) -> DataFrame:
    """The searches of ``entity_search`` by a posting table."""
    exported = reports.export_lots(t.mart, reports.lot_labels(t.lots))
    index = postings.PostingIndex(t.spark, f"{work_dir(t.spark)}/search-{uuid.uuid4().hex}")
    reports.index_lots(index, exported)
    by_text = reports.search_index(index, exported, " Widget ").withColumn("searched", F.lit("text"))
    by_key = reports.search_index(index, exported, "30").withColumn("searched", F.lit("key"))
    return by_text.unionAll(by_key).select("searched", "heat_season", "bbl", "no_heat")


def rate_model(t: Tables) -> tuple:
    scored = t.mart.filter("has_energy_star_score").select(
        "no_heat_complaints",
        (F.col("energy_star_score") / 10).alias("score_10"),
        F.log("total_gfa_sqft").alias("log_gfa"),
        "era",
    )
    return scored, "no_heat_complaints", ["score_10", "log_gfa"], "era", lb.ERAS, "log_gfa"


@query
def poisson_rate_model(t: Tables) -> DataFrame:
    return stats.poisson_rates(*rate_model(t))


@query
def poisson_score_equations(t: Tables) -> DataFrame:
    """Fitted totals of every term of the model, which must equal the observed ones."""
    return rounded(stats.poisson_totals(*rate_model(t)), "total", scale=1)


@query
def poisson_era_rate_ratio(t: Tables) -> DataFrame:
    scored = t.mart.filter("has_energy_star_score")
    return stats.category_rate_ratios(
        scored, "no_heat_complaints", "era", lb.ERAS[0], "total_gfa_sqft"
    )


# ---------------------------------------------------------------- quality


@query
def freshness(t: Tables) -> DataFrame:
    return quality.freshness(t.read("events"), "ts", EVENTS_NOW, zone="America/Los_Angeles")


@query
def data_health(t: Tables) -> DataFrame:
    return reports.data_health(t.fact, t.mart, TODAY)


@query
def dq_unique(t: Tables) -> DataFrame:
    return quality.check_unique(t.rc, "unique_key")


@query
def dq_not_null(t: Tables) -> DataFrame:
    return quality.check_not_null(t.stg, "descriptor_detail", "complaint_id")


@query
def dq_accepted(t: Tables) -> DataFrame:
    return quality.check_accepted(t.stg, "descriptor_detail", list(lb.NO_HEAT))


@query
def dq_range(t: Tables) -> DataFrame:
    return quality.check_range(t.dim, "lot_year_id", "energy_star_score", 10, 90)


@query
def dq_no_invented(t: Tables) -> DataFrame:
    # a join that fans out threefold, which the check must notice
    return quality.check_no_fan_out(joins.union_all(t.mart, t.mart, t.mart), t.fact)


def checked_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "stg_complaints": t.stg,
        "stg_properties": t.props,
        "property_lots": t.lots,
        "lot_dimension": t.dim,
        "complaint_fact": t.fact,
        "lot_season_mart": t.mart,
    }


@query
def dq_summary(t: Tables) -> DataFrame:
    return quality.run_checks(model_checks(checked_tables(t)))


@query
def incremental_checks(t: Tables) -> DataFrame:
    """Results of the checks kept per bucket: failing keys of the state, and what each season may count."""
    kept = loaded_twice(t, "checks", lambda path, state: KeptChecks(t.spark, path, state))
    failing = kept.results().agg(F.sum(F.col("not_unique") + F.col("without_key") + F.col("misplaced")).alias("failing_keys"))
    return joins.one_row(kept.season_totals(), failing)


@query
def dq_run_summary(t: Tables) -> DataFrame:
    results = quality.run_checks(model_checks(checked_tables(t)))
    return quality.run_summary(results, models_built=len(TABLES), built_at=TODAY)
