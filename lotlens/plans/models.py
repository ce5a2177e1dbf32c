"""The six models: two staging tables, lots, lot dimension, complaint fact, season mart.

Each takes DataFrames and returns a lazy DataFrame. Only the mart runs jobs while it is
built: it writes one row per season and lot of the fact, the dimension unless that is
stored already, and the ranges in which the size quartiles are searched. Stored tables
and lazy frames work alike as inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import labels as lb
from ..functions.casts import (
    in_or_false,
    null_if_any,
    null_safe_least,
    try_int_rounded,
    try_num,
    try_ts,
    try_whole,
)
from ..functions.keys import key_or_null, surrogate_key
from ..operators.joins import keep_zeros, one_row
from ..operators.latest import latest_by, latest_load
from ..operators.lots import explode_keys, scored_weight, weighted_score
from ..operators.ranks import ntile_by
from ..session import materialize_all

UPDATED = ":updated_at"

# Source field per typed column.
COMPLAINT_TEXT = {
    "status": "status",
    "complaint_type": "complaint_type",
    "descriptor": "descriptor",
    "descriptor_detail": "descriptor_2",
    "location_type": "location_type",
    "borough": "borough",
    "zip_code": "incident_zip",
    "address": "incident_address",
    "bbl": "bbl",
    "community_board": "community_board",
    "council_district": "council_district",
    "channel": "open_data_channel_type",
    "resolution_description": "resolution_description",
}
COMPLAINT_TIMES = {
    "created_at": "created_date",
    "closed_at": "closed_date",
    "resolution_updated_at": "resolution_action_updated_date",
}
PROPERTY_TEXT = {
    "property_name": "property_name",
    "primary_property_type": "primary_property_type",
    "largest_property_use_type": "largest_property_use_type",
    "address": "address_1",
    "zip_code": "postal_code",
    "borough": "borough",
}
HOUSING = "Multifamily Housing"


def field(raw: DataFrame, name: str) -> Column:
    """Text of one source field, from a VARIANT ``record`` or a plain column; NULL if absent."""
    if "record" in raw.columns:
        return F.try_variant_get(F.col("record"), f'$["{name}"]', "string")
    if name in raw.columns:
        return F.col(f"`{name}`").cast("string")
    return F.lit(None).cast("string")


def type_complaints(raw: DataFrame) -> DataFrame:
    """Typed columns of every raw version."""
    return raw.select(
        field(raw, "unique_key").alias("complaint_id"),
        *[try_ts(field(raw, src)).alias(out) for out, src in COMPLAINT_TIMES.items()],
        *[field(raw, src).alias(out) for out, src in COMPLAINT_TEXT.items()],
        *[try_num(field(raw, c)).alias(c) for c in ("latitude", "longitude")],
        try_ts(field(raw, UPDATED), zoned=True).alias("source_updated_at"),
        F.col("source_file").alias("last_seen_in"),
        "loaded_at",
    )


#: Newest version of a complaint: by change time, then file, then load.
COMPLAINT_ORDER = ["source_updated_at", "last_seen_in", "loaded_at"]


def build_stg_complaints(raw: DataFrame) -> DataFrame:
    """One row per complaint: its newest version over all files.

    Types are extracted before the shuffle, so only needed columns travel.
    """
    return latest_by(type_complaints(raw), ["complaint_id"], COMPLAINT_ORDER)


def type_properties(raw: DataFrame) -> DataFrame:
    """Typed columns of the newest load of every property file.

    Typed right above the scan, where Spark reads only the extracted fields of
    a stored record; the older loads are filtered out afterwards.
    """
    typed = raw.select(
        try_whole(field(raw, "report_year")).alias("report_year"),
        field(raw, "property_id").alias("property_id"),
        *[null_if_any(field(raw, src), lb.MISSING).alias(out) for out, src in PROPERTY_TEXT.items()],
        field(raw, "nyc_borough_block_and_lot").alias("bbl_raw"),
        try_int_rounded(field(raw, "year_built")).alias("year_built"),
        try_int_rounded(field(raw, "energy_star_score")).alias("energy_star_score"),
        try_num(field(raw, "site_eui_kbtu_ft")).alias("site_eui_kbtu_ft"),
        try_num(field(raw, "property_gfa_self_reported")).alias("gfa_sqft"),
        try_ts(field(raw, "report_generation_date")).alias("report_generated_at"),
        try_ts(field(raw, UPDATED), zoned=True).alias("source_updated_at"),
        "source_file",
        "loaded_at",
        *(["batch"] if "batch" in raw.columns else []),
    )
    return latest_load(typed).drop("batch")


def newest_per_property(typed: DataFrame) -> DataFrame:
    keyed = typed.withColumn("property_year_id", surrogate_key("report_year", "property_id"))
    return latest_by(
        keyed,
        ["report_year", "property_id"],
        ["report_generated_at", "source_updated_at", "gfa_sqft"],
    )


def build_stg_properties(raw: DataFrame) -> DataFrame:
    """One row per property and report year."""
    return newest_per_property(type_properties(raw))


def build_property_lots(properties: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per property and lot; the floor area is split evenly over the lots.

    Needs one row per (report_year, property_id). ``keep`` carries further
    property columns along, which saves a later join back to the properties.
    """
    columns = [
        "report_year",
        "property_id",
        "property_year_id",
        "bbl_raw",
        "primary_property_type",
        "energy_star_score",
        "gfa_sqft",
        "year_built",
        *keep,
    ]
    lots = explode_keys(properties.select(*columns), "bbl_raw", "bbl", count="n_lots")
    return lots.withColumn("gfa_share_sqft", F.col("gfa_sqft") / F.col("n_lots")).drop("bbl_raw")


def build_lot_dimension(lots: DataFrame) -> DataFrame:
    """One row per residential lot and report year."""
    housing = lots.filter(F.col("primary_property_type") == HOUSING)
    biggest = F.struct("gfa_share_sqft", "property_id")
    per_lot = housing.groupBy("report_year", "bbl").agg(
        F.count("property_id").alias("n_properties"),  # a property has a lot once
        F.sum("gfa_share_sqft").alias("total_gfa_sqft"),
        scored_weight("energy_star_score", "gfa_share_sqft").alias("scored_gfa_sqft"),
        weighted_score("energy_star_score", "gfa_share_sqft").alias("energy_star_score"),
        F.max_by("year_built", biggest).alias("year_built"),
    )
    return per_lot.filter(F.col("total_gfa_sqft") > 0).select(
        surrogate_key("report_year", "bbl").alias("lot_year_id"),
        "*",
        F.col("energy_star_score").isNotNull().alias("has_energy_star_score"),
        lb.score_band("energy_star_score").alias("energy_star_band"),
        lb.era("year_built").alias("era"),
    )


def newest_report_year(properties: DataFrame) -> DataFrame:
    """One row. Typed rows will do: deduplicating them first would not change the maximum."""
    return properties.agg(F.max("report_year").alias("_max_report_year"))


def build_complaint_fact(
    complaints: DataFrame, properties: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per heat complaint with season, no-heat flag and comparable report year.

    ``keep`` carries further staging columns (coordinates) along, which saves
    joining the fact back to staging.
    """
    return with_report_year(heat_complaints(complaints, keep), properties)


def heat_complaints(complaints: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fact but for its report year; every column depends on its own complaint only."""
    start = cal.season_start_year("created_at")
    return complaints.filter(F.col("complaint_type") == lb.HEAT_TYPE).select(
        "complaint_id",
        key_or_null("bbl").alias("bbl"),
        "created_at",
        F.to_date("created_at").alias("created_date"),
        "closed_at",
        "status",
        "descriptor_detail",
        in_or_false("descriptor_detail", lb.NO_HEAT).alias("is_no_heat"),
        "borough",
        "zip_code",
        start.alias("heating_year_start"),
        cal.season_label("created_at").alias("heat_season"),
        *keep,
    )


def with_report_year(df: DataFrame, properties: DataFrame) -> DataFrame:
    """The newest report year that a season may be compared with."""
    as_of = null_safe_least(F.col("heating_year_start") - 1, F.col("_max_report_year"))
    return (
        one_row(df, newest_report_year(properties))
        .withColumn("ll84_report_year", as_of)
        .drop("_max_report_year")
    )


def lot_season_counts(fact: DataFrame) -> DataFrame:
    """Complaints per lot and season."""
    placed = fact.filter(F.col("heat_season").isNotNull() & F.col("bbl").isNotNull())
    return placed.groupBy("heat_season", "bbl").agg(
        F.count_if("is_no_heat").alias("no_heat_complaints"),
        F.count(F.lit(1)).alias("all_heat_complaints"),
    )


SEASON = ["heat_season", "heating_year_start", "ll84_report_year"]


def season_facts(fact: DataFrame) -> DataFrame:
    """All the mart needs of the fact, one row per season and lot (NULL lot included).

    The seasons, their date range and the lot counts all come from it, so the
    fact is read and aggregated only once.
    """
    return (
        fact.filter(F.col("heat_season").isNotNull())
        .groupBy(*SEASON, "bbl")
        .agg(
            F.count_if("is_no_heat").alias("no_heat_complaints"),
            F.count(F.lit(1)).alias("all_heat_complaints"),
            F.min("created_date").alias("first_date"),
            F.max("created_date").alias("last_date"),
        )
    )


def season_coverage(per_lot: DataFrame) -> DataFrame:
    """One row per season: its dimension year, and whether the data spans all of it.

    The span is that of in-season complaints only.
    """
    seasons = per_lot.groupBy(*SEASON).agg(
        F.min("first_date").alias("_first"), F.max("last_date").alias("_last")
    )
    span = per_lot.agg(F.min("first_date").alias("_start"), F.max("last_date").alias("_end"))
    year = F.col("heating_year_start")
    complete = (cal.first_day(year) >= F.col("_start")) & (cal.last_day(year) <= F.col("_end"))
    return one_row(seasons, span).select(*SEASON, complete.alias("is_season_complete"))


def season_lots(seasons: DataFrame, dim: DataFrame) -> DataFrame:
    """Every season joined to the dimension snapshot that existed during it.

    There is at most one season per calendar year, so the season side is tiny
    by construction. Seasons without a snapshot drop out.
    """
    return dim.join(seasons, F.col("report_year") == F.col("ll84_report_year")).drop("report_year")


def build_lot_season_mart(fact: DataFrame, dim: DataFrame, dim_is_stored: bool = False) -> DataFrame:
    """One row per residential lot and season, lots without complaints kept with 0.

    The dimension is read several times: one that is not a table is written first.
    """
    frames = {"season_facts": season_facts(fact)}
    if not dim_is_stored:
        frames["lot_dimension"] = dim
    stored = materialize_all(**frames)
    per_lot, dim = stored["season_facts"], stored.get("lot_dimension", dim)
    return mart_of_counts(per_lot, season_coverage(per_lot), dim)


def mart_of_counts(per_lot: DataFrame, seasons: DataFrame, dim: DataFrame) -> DataFrame:
    """The mart from complaints per season and lot (NULL lots are ignored), the seasons and a stored dimension.

    Size quartiles are a property of the dimension snapshot (a season has
    exactly one), so they are ranked once per snapshot, not once per season.
    """
    scored = ntile_by(
        dim.filter("has_energy_star_score"), ["report_year"], "total_gfa_sqft", "bbl", 4, "size_quartile"
    )
    unscored = dim.filter(~F.col("has_energy_star_score")).withColumn(
        "size_quartile", F.lit(None).cast("int")
    )
    population = season_lots(seasons, scored.unionByName(unscored))
    counts = per_lot.filter(F.col("bbl").isNotNull())
    counted = keep_zeros(
        population, counts, ["heat_season", "bbl"], ["no_heat_complaints", "all_heat_complaints"]
    )
    return counted.select(
        surrogate_key("heat_season", "bbl").alias("lot_season_id"),
        "heat_season",
        "ll84_report_year",
        "bbl",
        "n_properties",
        "total_gfa_sqft",
        "energy_star_score",
        "has_energy_star_score",
        "energy_star_band",
        "year_built",
        "era",
        "size_quartile",
        "no_heat_complaints",
        "all_heat_complaints",
        lb.rate("no_heat_complaints", "total_gfa_sqft").alias("no_heat_per_100k_sqft"),
        "is_season_complete",
    )
