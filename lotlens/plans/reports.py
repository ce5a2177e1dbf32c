"""Report frames over the fact and the mart. All cover every season at once unless filtered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import labels as lb
from ..functions.casts import as_col
from ..operators.joins import keep_zeros, one_row
from ..operators.latest import top_n
from ..operators.postings import PREFIX, PostingIndex, runs_of
from ..operators.ranks import (
    cumulative,
    cut_at,
    exact_median,
    nearest_rank,
    order_statistics,
    qcut,
    upper_median,
    weigh,
)
from ..session import materialize
from .models import HOUSING

# Fixed values of the reports.
GRID_CELL = 0.004
LAT_RANGE = (40.4, 41.0)
LON_RANGE = (-74.3, -73.6)
HOTSPOT_CUTS = (0.5, 0.8, 0.95)
MIN_RANKED = 3
MIN_AREA = 50_000
MIN_LOTS = 20
SEARCH_HITS = 8
ALL_REGIONS = "All"


def rows():
    return F.count(F.lit(1))


def with_region(fact: DataFrame) -> DataFrame:
    return fact.withColumn("boro", lb.region_name("bbl", "borough"))


# ---------------------------------------------------------------- counts over time


def daily_counts(fact: DataFrame) -> DataFrame:
    dated = with_region(fact.filter(F.col("created_date").isNotNull()))
    return dated.groupBy(F.col("created_date").alias("d"), "boro").agg(
        F.count_if("is_no_heat").alias("no_heat"), rows().alias("all_heat")
    )


def monthly_counts(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.trunc("created_date", "month").alias("month")).agg(
        F.count_if("is_no_heat").alias("no_heat"),
        F.count_if(~F.col("is_no_heat")).alias("other_heat_hot_water"),
    )


def in_region(df: DataFrame, region: str | None) -> DataFrame:
    return df.filter(F.col("boro") == region) if region else df


def _by_season_day(daily: DataFrame, region: str | None) -> DataFrame:
    """No-heat complaints per heating year and day of it; a few hundred days per year."""
    year = cal.season_start_year("d")
    days = in_region(daily, region).groupBy("d").agg(F.sum("no_heat").alias("n"))
    return days.select(
        year.alias("start_year"), F.datediff("d", cal.first_day(year)).alias("day"), "d", "n"
    )


def _season_spans(daily: DataFrame, seasons: DataFrame) -> DataFrame:
    """Per season: first day and last day with data so far, as day numbers of the season."""
    reach = daily.agg(F.min("d").alias("data_start"), F.max("d").alias("through"))
    year = cal.start_year_of("season")
    start, end = cal.season_bounds("season")
    spans = one_row(seasons.select(F.col("heat_season").alias("season")).distinct(), reach)
    return spans.select(
        "season",
        year.alias("start_year"),
        start.alias("season_start"),
        "data_start",
        F.datediff(F.least(end, F.col("through")), start).alias("last_day"),
        F.datediff(end, start).alias("full_day"),
    )


def weekly_trend(
    daily: DataFrame, seasons: DataFrame, region: str | None = None, keep_partial: bool = True
) -> DataFrame:
    """No-heat complaints per 7-day bin from October 1; weeks without any are 0.

    A last bin cut short by the season's end or by the data is flagged, or dropped.
    """
    spans = _season_spans(daily, seasons).filter(F.col("last_day") >= 0)
    weeks = spans.withColumn(
        "week", F.explode(F.sequence(F.lit(0), F.floor(F.col("last_day") / 7).cast("int")))
    )
    day = F.col("day")
    counted = (
        _by_season_day(daily, region)
        .join(spans.select("start_year", "last_day"), "start_year")
        .filter(day <= F.col("last_day"))
        .groupBy("start_year", F.floor(day / 7).cast("int").alias("week"))
        .agg(F.sum("n").alias("n"))
    )
    trend = keep_zeros(weeks, counted, ["start_year", "week"], ["n"]).select(
        "season",
        "week",
        F.date_add("season_start", F.col("week") * 7).alias("week_start"),
        "n",
        (F.col("week") * 7 + 6 > F.col("last_day")).alias("is_partial"),
    )
    return trend if keep_partial else trend.filter(~F.col("is_partial"))


def season_to_date(daily: DataFrame, seasons: DataFrame, region: str | None = None) -> DataFrame:
    """Season total so far, and its change from the same number of days a season earlier.

    No comparison when the data does not reach back to the earlier start or
    the earlier total is 0.
    """
    spans = _season_spans(daily, seasons)
    days = _by_season_day(daily, region)
    bounded = spans.select("season", "start_year", "last_day")

    def total(shift: int, out: str) -> DataFrame:
        shifted = days.withColumn("start_year", F.col("start_year") + shift)
        within = shifted.join(bounded, "start_year").filter(
            F.col("day") <= F.col("last_day")
        )
        return within.groupBy("season").agg(F.sum("n").alias(out))

    both = keep_zeros(spans, total(0, "cur"), ["season"], ["cur"])
    both = both.join(total(1, "prev"), ["season"], "left")
    reached = cal.first_day(F.col("start_year") - 1) >= F.col("data_start")
    prev = F.when(reached, F.coalesce(F.col("prev"), F.lit(0)))
    change = F.when(prev > 0, F.round((F.col("cur") - prev) / prev * 100, 4))
    return both.select("season", "cur", prev.alias("prev"), change.alias("pct_change"))


# ---------------------------------------------------------------- season summaries


def season_region_rollup(fact: DataFrame) -> DataFrame:
    """Per season and region, and per season over all regions: lots with no-heat
    complaints, the exact median hours to close, and the number of closed ones.

    Lots are made distinct, and close times collapsed to counted minutes, before
    the grouping sets expand them. Both shrink map-side, so the stored fact is
    rather scanned twice than shuffled as it is.
    """
    base = with_region(fact.filter(F.col("heat_season").isNotNull())).select(
        F.col("heat_season").alias("season"),
        "boro",
        F.when(F.col("is_no_heat"), F.col("bbl")).alias("lot"),
        F.when(F.col("is_no_heat"), cal.close_minutes("created_at", "closed_at")).alias("minutes"),
    )
    season, boro, minute = F.col("season"), F.col("boro"), F.col("minutes")
    region = F.when(F.grouping("boro") == 1, ALL_REGIONS).otherwise(F.col("boro"))
    lots = (
        base.select("season", "boro", "lot")
        .distinct()
        .groupingSets([[season, boro], [season]], season, boro)
        .agg(region.alias("label"), F.count("lot").alias("buildings"))
    )
    minutes = (
        base.filter(F.col("minutes").isNotNull())
        .groupBy("season", "boro", "minutes")
        .agg(rows().alias("w"))
        .groupingSets([[season, minute, boro], [season, minute]], season, minute, boro)
        .agg(region.alias("label"), F.sum("w").alias("weight"))
        .select("season", "label", "minutes", "weight")
    )
    medians = exact_median(minutes, ["season", "label"], "minutes", "median_minutes")
    keys = ["season", "label"]
    joined = lots.select(*keys, "buildings").join(medians, keys, "left")
    return joined.select(
        "season",
        F.col("label").alias("boro"),
        "buildings",
        F.round(F.col("median_minutes") / 60, 4).alias("median_close_hours"),
        F.coalesce("group_rows", F.lit(0)).alias("closed"),
    )


def season_summary(mart: DataFrame) -> DataFrame:
    return mart.groupBy("heat_season").agg(
        F.max("ll84_report_year").alias("ll84_year"),
        F.bool_and("is_season_complete").alias("complete"),
        rows().alias("lots"),
    )


def fact_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.max("created_date").alias("data_through"),
        rows().alias("complaints_total"),
        F.count_if("is_no_heat").alias("no_heat_total"),
    )


def export_meta(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """Seasons with their dimension year, completeness and size, plus the overall totals."""
    return one_row(season_summary(mart).withColumnRenamed("heat_season", "season"), fact_totals(fact))


def season_kpis(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """Headline numbers of each season in the mart."""
    citywide = (
        fact.filter(F.col("heat_season").isNotNull())
        .groupBy("heat_season")
        .agg(F.count_if("is_no_heat").alias("no_heat"))
    )
    lots = mart.groupBy("heat_season").agg(
        rows().alias("lots"),
        F.count_if("has_energy_star_score").alias("scored_lots"),
        F.sum("no_heat_complaints").alias("matched"),
    )
    through = fact.agg(F.max("created_date").alias("data_through"))
    return one_row(keep_zeros(lots, citywide, ["heat_season"], ["no_heat"]), through)


def pick_season(mart: DataFrame) -> DataFrame:
    """Newest complete season, else the newest."""
    per = mart.groupBy("heat_season").agg(F.bool_and("is_season_complete").alias("complete"))
    best = per.orderBy(F.col("complete").desc(), F.col("heat_season").desc()).limit(1)
    return best.select("heat_season")


def data_health(fact: DataFrame, mart: DataFrame, today: str, max_age_days: int = 4) -> DataFrame:
    """Age of the data on a given day, totals, and the number of complete seasons."""
    complete = pick_complete(mart).agg(rows().alias("complete_seasons"))
    age = F.datediff(F.lit(today).cast("date"), "data_through")
    return one_row(fact_totals(fact), complete).select(
        age.alias("age_days"),
        (age <= max_age_days).alias("fresh"),
        "complaints_total",
        "no_heat_total",
        "complete_seasons",
    )


def pick_complete(mart: DataFrame) -> DataFrame:
    return season_summary(mart).filter("complete").select("heat_season")


# ---------------------------------------------------------------- pooled rates


def report_lots(mart: DataFrame, *keep: str) -> DataFrame:
    """Lots as the dashboard sees them: floor area in whole square feet, rate per that area."""
    gfa = F.round("total_gfa_sqft")
    return mart.select(
        "heat_season",
        "bbl",
        lb.region_name("bbl").alias("boro"),
        F.round("energy_star_score", 1).alias("score"),
        F.col("energy_star_band").alias("band"),
        "era",
        F.col("year_built").alias("built"),
        gfa.alias("gfa"),
        F.col("size_quartile").alias("size_q"),
        F.col("no_heat_complaints").alias("no_heat"),
        F.col("all_heat_complaints").alias("all_heat"),
        lb.rate("no_heat_complaints", gfa).alias("rate"),
        *keep,
    )


def scored_lots(mart: DataFrame) -> DataFrame:
    """Scored lots with the column names the pooled rates group by."""
    return mart.filter("has_energy_star_score").select(
        "heat_season",
        "bbl",
        F.col("energy_star_band").alias("band"),
        lb.label_of("size_quartile", lb.SIZE_LABELS).alias("size"),
        "era",
        "energy_star_score",
        F.col("no_heat_complaints").alias("no_heat"),
        F.col("total_gfa_sqft").alias("gfa"),
    )


def pooled_rate(lots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Total complaints over total floor area per group, never a mean of rates."""
    pooled = lots.groupBy(*by).agg(
        rows().alias("lots"),
        F.sum("no_heat").alias("complaints"),
        F.sum("gfa").alias("gfa"),
    )
    return pooled.withColumn("per_100k", F.round(lb.rate("complaints", "gfa"), 4))


def rates_by_band(lots: DataFrame, by: Sequence[str] = ("heat_season",)) -> DataFrame:
    """Pooled rate of all four bands in every group; a band without lots has 0 lots and no rate."""
    bands = F.explode(F.array(*[F.lit(b) for b in lb.SCORE_BANDS])).alias("band")
    spine = lots.select(*by).distinct().select(*by, bands)
    pooled = pooled_rate(lots.filter(F.col("band").isNotNull()), [*by, "band"])
    filled = spine.join(pooled, [*by, "band"], "left")
    return filled.fillna(0, subset=["lots", "complaints", "gfa"])


def split_rates(lots: DataFrame, group: str, labels: Sequence[str]) -> DataFrame:
    """Pooled rates of every season in all cells of ``labels`` x bands; empty cells have 0 lots and no rate."""
    grouped = lots.filter(F.col(group).isin(*labels) & F.col("band").isNotNull())
    cells = grouped.select("heat_season").distinct()
    for name, values in ((group, labels), ("band", lb.SCORE_BANDS)):
        cells = cells.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    by = ["heat_season", group, "band"]
    return cells.join(pooled_rate(grouped, by), by, "left").fillna(0, subset=["lots", "complaints", "gfa"])


def rate_matrix(pooled: DataFrame, rows_by: Sequence[str], measure: str) -> DataFrame:
    """Pooled rates as a matrix: one column per band."""
    wide = pooled.groupBy(*rows_by).pivot("band", list(lb.SCORE_BANDS)).agg(F.first(measure))
    return wide.select(
        *rows_by, *[F.col(f"`{b}`").alias("b" + b.replace("-", "_")) for b in lb.SCORE_BANDS]
    )


def size_summary(lots: DataFrame) -> DataFrame:
    """Equal-frequency size groups of scored lots, with their mean score and pooled rate."""
    sized = qcut(lots, ["heat_season"], "gfa", lb.QCUT_LABELS, "size_band")
    by = ["heat_season", "size_band"]
    summary = sized.groupBy(*by).agg(
        rows().alias("lots"),
        F.sum("no_heat").alias("complaints"),
        F.sum("gfa").alias("gfa"),
        F.round(F.avg("energy_star_score"), 4).alias("avg_score"),
    )
    return summary.withColumn("per_100k", F.round(lb.rate("complaints", "gfa"), 4))


def band_effect(lots: DataFrame, by: Sequence[str], min_lots: int = MIN_LOTS) -> DataFrame:
    """Percent by which the best band's rate differs from the worst band's, per group.

    Groups with too few lots in either band, or no complaints in the worst, drop out.
    """

    def of(band: str, value, out: str):
        return F.sum(F.when(F.col("band") == band, value)).alias(out)

    worst, best = lb.SCORE_BANDS[0], lb.SCORE_BANDS[-1]
    usable = lots.filter(F.col("band").isin(worst, best) & (F.col("gfa") > 0))
    sums = usable.groupBy(*by).agg(
        of(worst, F.lit(1), "lo_lots"),
        of(best, F.lit(1), "hi_lots"),
        of(worst, F.col("no_heat"), "lo_n"),
        of(best, F.col("no_heat"), "hi_n"),
        of(worst, F.col("gfa"), "lo_gfa"),
        of(best, F.col("gfa"), "hi_gfa"),
    )
    lo, hi = lb.rate("lo_n", "lo_gfa"), lb.rate("hi_n", "hi_gfa")
    enough = (F.col("lo_lots") >= min_lots) & (F.col("hi_lots") >= min_lots) & (F.col("lo_n") > 0)
    return sums.filter(enough).select(
        *by,
        F.round(lo, 4).alias("lo_rate"),
        F.round(hi, 4).alias("hi_rate"),
        F.round((hi - lo) / lo * 100, 4).alias("effect_pct"),
    )


def effect_verdict(effects: DataFrame, by: Sequence[str]) -> DataFrame:
    """In how many of the comparable groups the best band has the lower rate."""
    return effects.groupBy(*by).agg(
        rows().alias("groups"), F.count_if(F.col("effect_pct") < 0).alias("better")
    )


def band_check(
    fact: DataFrame, dim: DataFrame, first: str, last: str, report_year: int
) -> DataFrame:
    """Band table of one inclusive date window against one dimension year, zeros kept."""
    window = fact.filter(
        F.col("is_no_heat")
        & F.col("created_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        & F.col("bbl").isNotNull()
    )
    counts = window.groupBy("bbl").agg(rows().alias("complaints"))
    lots = dim.filter((F.col("report_year") == report_year) & F.col("has_energy_star_score"))
    joined = keep_zeros(lots, counts, ["bbl"], ["complaints"])
    return joined.groupBy(F.col("energy_star_band").alias("band")).agg(
        rows().alias("lots"),
        F.round(lb.fraction_of(F.col("complaints") > 0), 3).alias("pct_with_complaint"),
        F.sum("complaints").alias("complaints"),
        F.round(lb.rate(F.sum("complaints"), F.sum("total_gfa_sqft")), 3).alias("per_100k_sqft"),
    )


# ---------------------------------------------------------------- places


def grid_counts(located: DataFrame, cell: float = GRID_CELL) -> DataFrame:
    """No-heat complaints per season, grid cell and region, inside the bounding box.

    ``located`` is the fact with its coordinates.
    """
    inside = located.filter(
        F.col("is_no_heat")
        & F.col("heat_season").isNotNull()
        & F.col("latitude").between(*LAT_RANGE)
        & F.col("longitude").between(*LON_RANGE)
    )
    return (
        with_region(inside)
        .groupBy(
            F.col("heat_season").alias("season"),
            lb.snap("latitude", cell).alias("lat"),
            lb.snap("longitude", cell).alias("lon"),
            "boro",
        )
        .agg(rows().alias("n"))
    )


def with_coordinates(fact: DataFrame, complaints: DataFrame) -> DataFrame:
    """Attach staging coordinates to a stored fact, one to one by complaint."""
    return fact.join(complaints.select("complaint_id", "latitude", "longitude"), "complaint_id")


def season_points(fact: DataFrame) -> DataFrame:
    """Places of no-heat complaints, from the coordinates that the stored fact carries."""
    cold = fact.filter(F.col("is_no_heat") & F.col("heat_season").isNotNull())
    known = cold.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return known.select(
        F.col("heat_season").alias("season"),
        "complaint_id",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
    )


def hotspot_classes(cells: DataFrame) -> DataFrame:
    """Class 0 to 3 of each cell within its season, and the radius of its marker."""
    spots = {f"c{i}": nearest_rank(p) for i, p in enumerate(HOTSPOT_CUTS)}
    cuts = order_statistics(cells, ["season"], "n", {**spots, "top": lambda n: n - 1})
    joined = cells.join(cuts.drop("group_rows"), ["season"])
    step = cut_at(F.col("n"), [F.col(c) for c in spots], [0, 1, 2, 3])
    radius = F.round(F.sqrt(F.col("n") / F.col("top")) * 11 + 2, 4)
    return joined.select(
        "season", "lat", "lon", "boro", "n", step.alias("class"), radius.alias("radius")
    )


# ---------------------------------------------------------------- single lots


def peer_comparison(lots: DataFrame) -> DataFrame:
    """Each lot against the lots of its size group in the same season.

    Size groups are cut at nearest ranks of the floor area. The peer median is
    the upper one; ``pct_below`` is the share of peers with a strictly lower rate.
    """
    spots = {f"c{i}": nearest_rank(p) for i, p in enumerate((0.25, 0.5, 0.75))}
    sized = lots.filter(F.col("gfa") > 0).select("heat_season", "bbl", "gfa", "rate")
    cuts = order_statistics(sized, ["heat_season"], "gfa", spots).drop("group_rows")
    group = cut_at(F.col("gfa"), [F.col(c) for c in spots], [1, 2, 3, 4])
    sized = sized.join(cuts, ["heat_season"]).select(
        "heat_season", "bbl", "rate", group.alias("size_group")
    )
    by = ["heat_season", "size_group"]
    ranked = materialize(cumulative(weigh(sized, by, ["rate"]), by, ["rate"]), "peer-ranks")
    middle = upper_median(F.col("group_rows"))
    medians = ranked.filter(
        (F.col("below") <= middle) & (middle < F.col("below") + F.col("weight"))
    ).select(*by, F.col("rate").alias("peer_median"), "group_rows")
    # rate 0, which most lots have, is the lowest: those lots need no look at the ranks
    zero = sized.filter("rate = 0").withColumn("below", F.lit(0).cast("long"))
    above = sized.filter("rate <> 0").join(ranked.select(*by, "rate", "below"), [*by, "rate"])
    compared = zero.unionByName(above.select(*zero.columns)).join(medians, by)
    return compared.select(
        "heat_season",
        "bbl",
        "size_group",
        F.col("group_rows").alias("peers"),
        F.round("peer_median", 4).alias("peer_median"),
        F.round(F.col("below") / F.col("group_rows") * 100).cast("long").alias("pct_below"),
    )


def top_lots(mart: DataFrame, min_area: float = MIN_AREA, n: int = 25) -> DataFrame:
    """Lots with the highest rates of each season, among those of a minimum area."""
    large = mart.filter(F.col("total_gfa_sqft") >= min_area)
    order = [F.col("no_heat_per_100k_sqft").desc_nulls_last(), F.asc("bbl")]
    top = top_n(large, ["heat_season"], order, n, "bbl")
    return top.select(
        "heat_season",
        "bbl",
        F.round("energy_star_score").alias("energy_star"),
        "energy_star_band",
        "era",
        "year_built",
        F.round("total_gfa_sqft").alias("floor_area_sqft"),
        "no_heat_complaints",
        F.round("no_heat_per_100k_sqft", 1).alias("per_100k_sqft"),
    )


def leaderboard(
    lots: DataFrame,
    sort: str = "rate",
    region: str | None = None,
    min_area: float = MIN_AREA,
    min_n: int = MIN_RANKED,
    n: int = 10,
) -> DataFrame:
    """Top lots of each season by a chosen metric, NULL ranked as -1."""
    eligible = in_region(lots, region).filter(
        (F.col("gfa") >= min_area) & (F.col("no_heat") >= min_n)
    )
    order = [F.coalesce(F.col(sort), F.lit(-1)).desc(), F.asc("bbl")]
    return top_n(eligible, ["heat_season"], order, n, "bbl")


def searched_text() -> Column:
    """What a search for a part of a lot's address or key looks at."""
    return F.concat_ws(" ", F.lower(F.coalesce("address", F.lit(""))), F.col("bbl"))


def _is_key(wanted: str) -> bool:
    return wanted.isascii() and wanted.isdigit()


def search(lots: DataFrame, text: str, region: str | None = None, n: int = SEARCH_HITS) -> DataFrame:
    """Lots of each season by key prefix (digits only) or by part of address and key."""
    wanted = text.strip().lower()
    if len(wanted) < 2:
        return lots.limit(0)
    hit = F.col("bbl").startswith(wanted) if _is_key(wanted) else searched_text().contains(wanted)
    found = in_region(lots, region).filter(hit)
    return top_n(found, ["heat_season"], [F.desc("no_heat"), F.asc("bbl")], n, "bbl")


def index_lots(index: PostingIndex, lots: DataFrame) -> None:
    index.build(lots, "bbl", searched_text())


def search_index(index: PostingIndex, lots: DataFrame, text: str, region: str | None = None, n: int = SEARCH_HITS) -> DataFrame:
    """``search`` by an index of ``lots``, of which only the columns are taken here."""
    wanted = text.strip().lower()
    if len(wanted) < 2:
        return lots.limit(0)
    runs = {PREFIX + wanted} if _is_key(wanted) else runs_of(wanted)
    return search(index.candidates(lots, "bbl", runs), text, region, n)


def benchmarked_share(fact: DataFrame, lots: DataFrame) -> DataFrame:
    """Per season: lots with complaints, complaints on dimension lots, and their share of all."""
    on_lots = lots.groupBy("heat_season").agg(
        F.count_if(F.col("no_heat") > 0).alias("flagged_lots"), F.sum("no_heat").alias("on_lots")
    )
    total = (
        fact.filter(F.col("heat_season").isNotNull())
        .groupBy("heat_season")
        .agg(F.count_if("is_no_heat").alias("total"))
    )
    joined = keep_zeros(on_lots, total, ["heat_season"], ["total"])
    return joined.withColumn("share", F.round(F.try_divide("on_lots", "total"), 4))


# ---------------------------------------------------------------- lot export


def lot_labels(labelled_lots: DataFrame) -> DataFrame:
    """Address of the biggest residential property per lot.

    ``labelled_lots`` are property lots that carried the address along.
    """
    housing = labelled_lots.filter(F.col("primary_property_type") == HOUSING)
    biggest = F.struct("gfa_share_sqft", "property_id")
    return housing.groupBy("report_year", "bbl").agg(
        F.max_by(as_col("address"), biggest).alias("address")
    )


def export_lots(mart: DataFrame, labels: DataFrame) -> DataFrame:
    """Lot rows of every season with their address, as published."""
    lots = report_lots(mart, "ll84_report_year").drop("rate")
    keyed = lots.withColumnRenamed("ll84_report_year", "report_year")
    return (
        keyed.join(labels, ["report_year", "bbl"], "left")
        .withColumn("address", lb.title_case("address"))
        .drop("report_year")
    )
