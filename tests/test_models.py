"""Models end to end on small raw inputs, and the daily run with its gate."""

import json
import os
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lotlens.operators import quality
from lotlens.operators.postings import PostingIndex
from lotlens.plans import bindings, catalog, deltas, models, reports
from lotlens.plans.daily import DailyRun
from lotlens.plans.kept_checks import KeptChecks, by_bucket
from lotlens.streaming.upsert import LatestState
from tests.conftest import values
from tests.test_sources import write_file

SF = "/root/testdata/sf0.001"
C_FIELDS = ["unique_key", "created_date", "closed_date", "complaint_type", "descriptor_2", "borough", "bbl", ":updated_at"]
P_FIELDS = [
    "report_year", "property_id", "nyc_borough_block_and_lot", "primary_property_type", "year_built",
    "energy_star_score", "property_gfa_self_reported", "address_1", "report_generation_date",
]
HEAT, HOUSING = "HEAT/HOT WATER", "Multifamily Housing"


def test_points_of_a_season_are_as_many_as_the_dashboard_draws(spark, monkeypatch):
    season = F.when(F.col("id") < 600, "2023-24").otherwise("2024-25")
    fact = spark.range(21_000).select(
        F.col("id").cast("string").alias("complaint_id"), season.alias("heat_season"), F.lit(True).alias("is_no_heat"),
        F.lit(40.7).alias("latitude"), F.lit(-73.9).alias("longitude"),
    )
    monkeypatch.setattr(catalog.Tables, "of", classmethod(lambda cls, *_: SimpleNamespace(fact=fact)))
    got = catalog.REGISTRY["random_points"](spark, "").groupBy("season").count()
    assert values(got) == [("2023-24", 600), ("2024-25", 20_000)]


def complaint(key, created, detail="NO HEAT", bbl="1000000001", kind=HEAT, updated="2026-01-01T00:00:00Z", closed=None):
    return (key, created, closed, kind, detail, "BRONX", bbl, updated)


def prop(year, pid, bbl="1000000001", score="50", gfa="1000", built="1925", kind=HOUSING, report="2026-01-01T00:00:00"):
    return (year, pid, bbl, kind, built, score, gfa, f"{pid} main st", report)


def complaints_of(spark, rows, file="f1", loaded="2026-01-01"):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in C_FIELDS))
    return df.withColumns({"source_file": F.lit(file), "loaded_at": F.lit(loaded).cast("timestamp_ntz")})


def properties_of(spark, rows, file="p1", loaded="2026-01-01"):
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in P_FIELDS))
    return df.withColumns({"source_file": F.lit(file), "loaded_at": F.lit(loaded).cast("timestamp_ntz")})


def mart_of(spark, complaints, properties):
    stg = models.build_stg_complaints(complaints)
    props = models.build_stg_properties(properties)
    dim = models.build_lot_dimension(models.build_property_lots(props))
    fact = models.build_complaint_fact(stg, props)
    return fact, dim, models.build_lot_season_mart(fact, dim)


def test_mart_keeps_zeros_and_drops_seasons_without_a_snapshot(spark):
    complaints = complaints_of(
        spark,
        [
            complaint("1", "2024-10-01T00:00:00"),
            complaint("2", "2025-05-31T10:00:00", "NO HOT WATER"),
            complaint("3", "2025-07-01T10:00:00"),
            complaint("4", "2022-11-01T00:00:00"),
            complaint("5", "2025-01-01T00:00:00", bbl="Unspecified"),
            complaint("6", "2025-01-01T00:00:00", kind="NOISE"),
        ],
    )
    properties = properties_of(
        spark,
        [
            prop("2023", "a"),
            prop("2023", "b", bbl="2000000001", score="Not Available", gfa="500"),
            prop("2023", "c", bbl="3000000001", gfa="0"),
            prop("2023", "d", bbl="4000000001", kind="Office"),
            prop("2024", "a"),
        ],
    )
    fact, _, mart = mart_of(spark, complaints, properties)
    years = {r["complaint_id"]: (r["heat_season"], r["ll84_report_year"]) for r in fact.collect()}
    # season 2022-23 compares with 2021, which was never loaded; June to September keep a report year
    assert years == {"1": ("2024-25", 2023), "2": ("2024-25", 2023), "3": (None, 2023), "4": ("2022-23", 2021), "5": ("2024-25", 2023)}
    got = mart.select("lot_season_id", "no_heat_complaints", "all_heat_complaints", "no_heat_per_100k_sqft", "size_quartile", "is_season_complete")
    assert values(got) == [("2024-25-1000000001", 1, 2, 100.0, 1, True), ("2024-25-2000000001", 0, 0, 0.0, None, True)]


def test_report_year_is_capped_at_the_newest_loaded(spark):
    fact, _, _ = mart_of(
        spark, complaints_of(spark, [complaint("1", "2030-12-01T00:00:00"), complaint("2", None)]),
        properties_of(spark, [prop("2023", "a"), prop("2024", "a")]),
    )
    assert values(fact.select("complaint_id", "ll84_report_year", "heat_season")) == [("1", 2024, "2030-31"), ("2", None, None)]


def test_newest_version_and_newest_load_win(spark):
    old = complaints_of(spark, [complaint("1", "2025-01-01T00:00:00", "NO HOT WATER")], "f1")
    new = complaints_of(spark, [complaint("1", "2025-01-01T00:00:00", "NO HEAT", updated="2026-01-02T00:00:00Z")], "f0")
    resent = complaints_of(spark, [complaint("1", "2025-01-01T00:00:00", "NO HEAT", updated="2026-01-02T00:00:00Z")], "f2")
    for raw in (old.union(new), new.union(old), old.union(new).union(new)):
        assert values(models.build_stg_complaints(raw).select("descriptor_detail", "last_seen_in")) == [("NO HEAT", "f0")]
    both = models.build_stg_complaints(old.union(new).union(resent))
    assert values(both.select("last_seen_in")) == [("f2",)]

    stale = properties_of(spark, [prop("2024", "a", score="1", report="2027-01-01T00:00:00"), prop("2024", "gone")], loaded="2025-01-01")
    current = properties_of(spark, [prop("2024", "a", score="60.4"), prop("2024", "a", score="9", report="Not Available")])
    staged = models.build_stg_properties(stale.union(current))
    assert values(staged.select("property_year_id", "energy_star_score")) == [("2024-a", 60)]


def test_lot_dimension(spark):
    props = models.build_stg_properties(
        properties_of(
            spark,
            [
                prop("2024", "a", "1000000001", "100", "33.3", "1990"),
                prop("2024", "b", "2000000001;2000000002", "40", "100", "1900"),
                prop("2024", "c", "2000000001", "70", "150", "Not Available"),
                prop("2024", "d", "2000000002", "Not Available", "10", "2001"),
            ],
        )
    )
    dim = models.build_lot_dimension(models.build_property_lots(props))
    got = dim.select("bbl", "n_properties", "total_gfa_sqft", "scored_gfa_sqft", "energy_star_score", "year_built", "energy_star_band", "era")
    assert values(got) == [
        ("1000000001", 1, 33.3, 33.3, 100.0, 1990, "76-100", "1990+"),
        # the biggest property has no year: the lot has none
        ("2000000001", 2, 200.0, 200.0, 62.5, None, "51-75", None),
        ("2000000002", 2, 60.0, 50.0, 40.0, 1900, "26-50", "pre-1930"),
    ]


def test_variant_and_plain_raw_stage_alike(spark):
    raw = bindings.raw_complaints(spark, SF)
    plain = models.build_stg_complaints(raw)
    landed = models.build_stg_complaints(bindings.as_variant(raw))
    assert plain.exceptAll(landed).count() == 0 and plain.count() == landed.count()


def test_mart_never_exceeds_the_fact_and_republication_changes_nothing(spark):
    raw, props = bindings.raw_complaints(spark, SF), bindings.raw_properties(spark, SF)
    fact, _, mart = mart_of(spark, raw, props)
    assert quality.check_no_fan_out(mart, fact).count() == 0
    resent = raw.union(raw.withColumn("source_file", F.lit("a-resend")))
    _, _, again = mart_of(spark, resent, props)
    assert mart.exceptAll(again).count() == 0 and mart.count() == again.count() > 0


def test_weekly_and_season_to_date(spark):
    daily = spark.createDataFrame(
        [("2024-09-30", "A", 100), ("2024-10-01", "A", 1), ("2024-10-07", "B", 2), ("2024-10-08", "A", 4),
         ("2025-09-15", "A", 50), ("2025-10-01", "A", 3), ("2025-10-10", "B", 9)],
        "d string, boro string, no_heat int",
    ).withColumn("d", F.col("d").cast("date"))
    seasons = spark.createDataFrame([("2024-25",), ("2025-26",)], "heat_season string")
    trend = reports.weekly_trend(daily, seasons)
    got = [tuple(r) for r in trend.orderBy("season", "week").collect()]
    assert len([g for g in got if g[0] == "2024-25"]) == 35
    assert [g[3] for g in got if g[0] == "2024-25"][:3] == [3, 4, 0]
    last = [(g[1], g[3], g[4]) for g in got if g[0] == "2025-26"]
    assert last == [(0, 3, False), (1, 9, True)]
    assert reports.weekly_trend(daily, seasons, "B", keep_partial=False).filter("season = '2025-26'").count() == 1
    sums = values(reports.season_to_date(daily, seasons))
    # 2024-25 has no earlier season in the data; 2025-26 compares the first ten days
    assert sums == [("2024-25", 7, None, None), ("2025-26", 12, 7, 71.4286)]


def test_rollup_against_builtin_median(spark):
    fact = spark.createDataFrame(
        [("2024-25", "1000000001", True, 10, None), ("2024-25", "1000000001", True, 30, None), ("2024-25", "2000000001", True, 50, None),
         ("2024-25", None, True, None, "QUEENS"), ("2024-25", "1000000002", False, 5, None), ("2025-26", "3000000001", False, 1, None), (None, "1000000009", True, 1, None)],
        "heat_season string, bbl string, is_no_heat boolean, m int, borough string",
    ).withColumns({
        "created_at": F.lit("2025-01-01").cast("timestamp_ntz"),
        "closed_at": F.lit("2025-01-01").cast("timestamp_ntz") + F.col("m") * F.expr("interval '1' minute"),
    })
    got = values(reports.season_region_rollup(fact).withColumn("median_close_hours", F.round(F.col("median_close_hours") * 60)))
    assert got == [
        ("2024-25", "All", 2, 30.0, 3),
        ("2024-25", "Bronx", 1, 50.0, 1),
        ("2024-25", "Manhattan", 1, 20.0, 2),
        ("2024-25", "Queens", 0, None, 0),
        ("2025-26", "All", 0, None, 0),
        ("2025-26", "Brooklyn", 0, None, 0),
    ]


def test_peers(spark):
    rows = [("s", f"{i:03}", float(100 + i), 0.0 if i % 3 else float(i)) for i in range(40)] + [("s", "none", 0.0, None)]
    lots = spark.createDataFrame(rows, "heat_season string, bbl string, gfa double, rate double")
    areas = sorted(r[2] for r in rows if r[2] > 0)
    cuts = [areas[int(p * (len(areas) - 1))] for p in (0.25, 0.5, 0.75)]
    group = lambda a: next((i for i, c in enumerate(cuts, 1) if a <= c), 4)
    got = {r["bbl"]: tuple(r)[2:] for r in reports.peer_comparison(lots).collect()}
    assert len(got) == 40
    for _, bbl, area, rate in rows[:40]:
        peers = sorted(r[3] for r in rows if r[2] > 0 and group(r[2]) == group(area))
        below = sum(x < rate for x in peers)
        assert got[bbl] == (group(area), len(peers), peers[len(peers) // 2], int(below / len(peers) * 100 + 0.5))


def test_effect_needs_enough_lots(spark):
    rows = [("s", "few", b, 1, 100.0) for b in ("1-25", "76-100")]
    rows += [("s", "many", "1-25", 2, 100.0)] * 20 + [("s", "many", "76-100", 1, 100.0)] * 20
    rows += [("s", "quiet", "1-25", 0, 100.0)] * 20 + [("s", "quiet", "76-100", 1, 100.0)] * 20
    lots = spark.createDataFrame(rows, "heat_season string, era string, band string, no_heat int, gfa double")
    effects = reports.band_effect(lots, ["heat_season", "era"])
    assert values(effects) == [("s", "many", 2000.0, 1000.0, -50.0)]
    assert values(reports.effect_verdict(effects, ["heat_season"])) == [("s", 1, 1)]


def test_empty_bands_are_listed(spark):
    lots = spark.createDataFrame([("s", "1-25", 1, 1000.0)], "heat_season string, band string, no_heat int, gfa double")
    got = values(reports.rates_by_band(lots))
    assert [g[1:4] for g in got] == [("1-25", 1, 1), ("26-50", 0, 0), ("51-75", 0, 0), ("76-100", 0, 0)]
    assert got[1][5] is None


def test_search_rules(spark):
    rows = [("s", f"10000000{i:02}", f"{i} Oak St" if i % 2 else None, i, "Bronx") for i in range(30)]
    lots = spark.createDataFrame(rows, "heat_season string, bbl string, address string, no_heat int, boro string")
    assert reports.search(lots, " x ").count() == 0
    assert [r["no_heat"] for r in reports.search(lots, " OAK").orderBy(F.desc("no_heat")).collect()] == list(range(29, 13, -2))
    assert values(reports.search(lots, "1000000003").select("bbl")) == [("1000000003",)]
    assert values(reports.search(lots, "t 1000000003").select("bbl")) == [("1000000003",)]
    assert reports.search(lots, "oak", region="Queens").count() == 0


def test_search_by_postings_equals_the_scan(spark, tmp_path):
    words = ["Oak", "Main", "Élan", "O'Hara  ", "x-y"]
    rows = [
        (f"s{i % 3}", f"{1 + i % 5}0{i // 3:08}", None if i % 11 == 0 else f"{i} {words[i % 5]} St", i * 7 % 50, "Bronx" if i % 2 else "Queens")
        for i in range(300)
    ]
    lots = spark.createDataFrame(rows, "heat_season string, bbl string, address string, no_heat int, boro string").repartition(5).cache()
    index = PostingIndex(spark, str(tmp_path / "index"), 16)
    reports.index_lots(index, lots)
    for text in ("oak", "OA", " élan st ", "o'hara  st", "7 main", "10", "1000000000", "20000000011", "st 30", "zzz", "x", "a st 1000", "99"):
        for region in (None, "Queens"):
            got = reports.search_index(index, lots, text, region)
            assert values(got) == values(reports.search(lots, text, region)), text
    got = index.candidates(lots, "bbl", {"^1000000000"})
    plan = got._jdf.queryExecution().toString()
    assert 0 < got.count() <= 3 and re.search(r"PartitionFilters: [^\n]*_part#\d+ = ", plan)  # one folder of 16
    reports.index_lots(index, lots.filter("heat_season = 's9'"))
    assert reports.search_index(index, lots, "oak").count() == 0


def test_daily_run_publishes_only_good_builds(spark, tmp_path):
    root, stage = str(tmp_path / "lake"), tmp_path / "stage"
    pipe = DailyRun(spark, root)
    cols = lambda fields: ", ".join(f"{c} string" for c in fields)
    write_file(
        spark, f"{stage}/c/dt=1/a.parquet",
        [complaint("1", "2024-10-01T00:00:00", closed="2024-10-01T03:00:00"), complaint("2", "2025-05-31T10:00:00")], cols(C_FIELDS),
    )
    write_file(spark, f"{stage}/p/y.parquet", [prop("2023", "a"), prop("2024", "b", "2000000001")], cols(P_FIELDS))
    assert pipe.published() == {}
    assert pipe.load(f"{stage}/c", f"{stage}/p", "2026-01-01") == {"complaints": 1, "properties": 1}
    first = pipe.run()
    assert first.published and values(first.checks.filter("not passed")) == []
    mart = pipe.published()["lot_season_mart"]
    assert values(mart.select("lot_season_id", "no_heat_complaints")) == [("2024-25-1000000001", 2)]

    # a score out of range fails its check: the old build stays published
    write_file(spark, f"{stage}/p/y.parquet", [prop("2023", "a", score="250")], cols(P_FIELDS))
    assert pipe.load(f"{stage}/c", f"{stage}/p", "2026-01-02") == {"complaints": 0, "properties": 1}
    bad = pipe.run()
    assert not bad.published and values(bad.checks.filter("not passed").select("check")) == [("lot_dimension.score in range",)]
    assert pipe.pointer.get() == str(first.build)

    write_file(spark, f"{stage}/p/y.parquet", [prop("2023", "a", score="25")], cols(P_FIELDS))
    pipe.load(f"{stage}/c", f"{stage}/p", "2026-01-03")
    assert pipe.run().published
    assert values(pipe.published()["lot_season_mart"].select("energy_star_band")) == [("1-25",)]

    # the kept state equals one deduplication of the whole history, in any number of loads
    whole = models.build_stg_complaints(pipe.complaints.rows())
    assert values(pipe.state.current()) == values(whole.select(*pipe.state.schema.fieldNames()))
    write_file(spark, f"{stage}/c/dt=2/b.parquet", [complaint("2", "2025-05-31T10:00:00", updated="2025-01-01T00:00:00Z")], cols(C_FIELDS))
    write_file(spark, f"{stage}/c/dt=1/a.parquet", [complaint("1", "2024-10-01T00:00:00", closed="2024-10-01T03:00:00", updated="2026-02-01T00:00:00Z")], cols(C_FIELDS))
    assert pipe.load(f"{stage}/c", f"{stage}/p")["complaints"] == 2
    whole = models.build_stg_complaints(pipe.complaints.rows())
    assert values(pipe.state.current()) == values(whole.select(*pipe.state.schema.fieldNames()))
    # the kept counts and the mart from them equal those of a whole build
    pipe.run()
    assert_counts(pipe.counts, pipe.published()["complaint_fact"])
    built = pipe.published()
    again = models.build_lot_season_mart(built["complaint_fact"], built["lot_dimension"], dim_is_stored=True)
    assert values(built["lot_season_mart"]) == values(again) != []
    # one build is published, and no more than two others are kept
    assert len(os.listdir(f"{root}/builds")) <= 3

    out = tmp_path / "site"
    pipe.export(str(out), "2026-01-03")
    daily = json.loads("".join(p.read_text() for p in (out / "daily").glob("*.txt")))
    assert daily == {"d": ["2024-10-01", "2025-05-31"], "boro": ["Manhattan"] * 2, "no_heat": [1, 1], "all_heat": [1, 1]}
    lots = spark.read.json(str(out / "lots")).first()
    assert (lots["address"], lots["boro"], lots["no_heat"]) == ("A Main St", "Manhattan", 2)
    assert spark.read.json(str(out / "run")).first()["tests_passed"] == 16


def assert_counts(counts, fact):
    """Kept counts against the fact."""
    lots = models.season_facts(fact).select("heat_season", "heating_year_start", "bbl", "no_heat_complaints", "all_heat_complaints")
    assert values(counts.lots().select(*lots.columns)) == values(lots)
    days = fact.filter("heat_season is not null").groupBy("heat_season", "heating_year_start", "created_date")
    days = days.agg(F.count_if("is_no_heat").alias("a"), F.count(F.lit(1)).alias("b"))
    assert values(counts.days().drop("as_of")) == values(days)


def test_counts_follow_the_state_by_differences(spark, tmp_path):
    """Corrected, moved and vanished heat complaints, a crash in between, and a state that moved on too far."""
    def version(key, n, created, kind=HEAT, bbl="1000000001"):
        return complaint(str(key), created, bbl=bbl, kind=kind, updated=f"2026-01-{n:02}T00:00:00Z")

    typed = lambda rows: models.type_complaints(complaints_of(spark, rows))
    state = LatestState(spark, str(tmp_path / "s"), typed([]).schema, ["complaint_id"], models.COMPLAINT_ORDER, 32)
    counts = deltas.SeasonCounts(spark, str(tmp_path / "c"), state, 4)
    counts.refresh()
    assert counts.lots().count() == 0
    fact = lambda: models.heat_complaints(state.current()).withColumn("ll84_report_year", F.lit(1))

    first = [version(i, 1, f"2024-{1 + i % 12:02}-05T00:00:00", bbl=f"10000000{i % 7:02}" if i % 5 else None) for i in range(60)]
    state.upsert(typed(first), 0)
    counts.refresh()
    assert_counts(counts, fact())
    # another day, another season, no heat complaint any more, another lot, unchanged
    second = [version(1, 2, "2024-02-06T00:00:00"), version(2, 2, "2025-11-06T00:00:00"), version(3, 2, "2024-04-05T00:00:00", "Noise"),
              version(4, 2, "2024-05-05T00:00:00", bbl="1000000099"), first[5], version(6, 0, "1999-11-06T00:00:00")]
    state.upsert(typed(second), 1)
    before, after = state.changed(0)
    buckets = {p.split("state_bucket=")[1].split("/")[0] for p in after.inputFiles()}
    assert len(buckets) <= len(second) and {p.split("state_bucket=")[1].split("/")[0] for p in before.inputFiles()} == buckets
    counts.refresh()
    assert_counts(counts, fact())
    counts.refresh()  # nothing new
    # the lots were counted, the days not, when the process died
    state.upsert(typed([version(7, 3, "2024-01-09T00:00:00")]), 2)
    counts._follow(counts._lots, deltas.LOT)
    deltas.SeasonCounts(spark, str(tmp_path / "c"), state, 4).refresh()
    assert_counts(counts, fact())
    # three commits later the last counted one is gone
    for n in (3, 4, 5):
        state.upsert(typed([version(n + 5, 4, "2024-12-24T00:00:00"), version(2, n + 1, "2024-10-01T00:00:00")]), n)
    assert state.changed(2) is None
    counts.refresh()
    assert_counts(counts, fact())


def test_differences_are_counted_once_and_then_read_from_their_table(spark, tmp_path, monkeypatch):
    rows = lambda n: models.type_complaints(
        complaints_of(spark, [complaint(str(i), f"2024-{n:02}-05T00:00:00", updated=f"2026-01-{n:02}T00:00:00Z") for i in range(9)])
    )
    state = LatestState(spark, str(tmp_path / "s"), rows(1).schema, ["complaint_id"], models.COMPLAINT_ORDER, 4)
    counts = deltas.SeasonCounts(spark, str(tmp_path / "c"), state, 4)
    beside, read = LatestState.beside, []
    monkeypatch.setattr(LatestState, "beside", lambda self, change: (read.append(change.inputFiles()), beside(self, change))[1])
    for batch, month in enumerate((1, 2)):
        state.upsert(rows(month), batch)
        counts.refresh()
        assert_counts(counts, models.heat_complaints(state.current()).withColumn("ll84_report_year", F.lit(1)))
    assert len(read) == 4 and all(files and not any(str(tmp_path / "s") in f for f in files) for files in read)


def test_raw_tables_are_landed_when_they_are_asked_for(spark):
    asked = []

    def raw(name):
        return lambda: (asked.append(name), spark.sql(f"select '{name}' as x, 'f' as source_file, 'l' as loaded_at"))[1]

    landing = catalog.Landing(complaints=raw("complaints"), properties=raw("properties"))
    assert landing["complaints"].count() == landing["complaints"].count() == 1 and asked == ["complaints"]
    landing.store("complaints", "properties")
    assert asked == ["complaints", "properties"] and landing["properties"].first()["source_file"] == "f"


def test_kept_checks_agree_with_full_checks_and_read_what_changed(spark, tmp_path, monkeypatch):
    typed = lambda rows: models.type_complaints(complaints_of(spark, rows))
    version = lambda key, n, month=11, bbl="1000000001": complaint(
        str(key), f"2024-{month:02}-05T00:00:00", bbl=bbl, updated=f"2026-01-{n:02}T00:00:00Z"
    )
    state = LatestState(spark, str(tmp_path / "s"), typed([]).schema, ["complaint_id"], models.COMPLAINT_ORDER, 16)
    kept = KeptChecks(spark, str(tmp_path / "k"), state)
    kept.refresh()
    assert kept.results().count() == 0
    read = []
    folder = re.compile(r"state_bucket=(\d+)")

    def seen(rows, of):
        read.append({int(folder.search(f)[1]) for f in rows.inputFiles()})
        return by_bucket(rows, of)

    monkeypatch.setattr("lotlens.plans.kept_checks.by_bucket", seen)
    no_mart = spark.createDataFrame([], "heat_season string, no_heat_complaints bigint")

    def agree(failing):
        """The same verdicts as the full checks, which are those named."""
        stg = state.current()
        full = {"unique": quality.check_unique(stg, "complaint_id").count() > 0, "not null": stg.filter("complaint_id is null").count() > 0}
        rows = quality.run_checks(kept.checks(no_mart)).collect()
        got = {r["check"].split("complaint_id ")[1]: not r["passed"] for r in rows if "complaint_id" in r["check"]}
        assert got == full == {"unique": "unique" in failing, "not null": "not null" in failing}
        heat = models.heat_complaints(stg).filter("heat_season is not null and bbl is not null")
        assert values(kept.season_totals().filter("fact_total > 0")) == values(
            heat.groupBy("heat_season").agg(F.count_if("is_no_heat").alias("n")).filter("n > 0")
        )

    def seed(bucket, key=None):
        """A row of a bucket a second time, under its own key or another."""
        number = {r["state_bucket"]: r["state_version"] for r in state._manifest().collect()}[bucket]
        path = f"{state.table}/state_version={number}/state_bucket={bucket}"
        row = spark.read.schema(state.schema).parquet(path).limit(1)
        (row if key is None else row.withColumn("complaint_id", F.lit(key))).write.mode("append").parquet(path)

    bucket_of = lambda key: spark.range(1).select(F.lit(key).alias("complaint_id")).select(state._bucket()).first()[0]
    state.upsert(typed([version(i, 1, 1 + i % 12, "1000000001" if i % 3 else None) for i in range(80)]), 0)
    kept.refresh()
    agree([])
    # only the buckets of a load are read, and corrected complaints leave their season
    state.upsert(typed([version(1, 2, 1), version(2, 2, 7)]), 1)
    kept.refresh()
    assert read[-1] == {bucket_of("1"), bucket_of("2")}
    agree([])
    # a copy in a bucket that was rewritten
    state.upsert(typed([version(3, 2)]), 2)
    seed(bucket_of("3"))
    kept.refresh()
    assert read[-1] == {bucket_of("3")}
    agree(["unique"])
    # it stays failing while other buckets change, and until its own is rewritten
    other = next(k for k in range(4, 80) if bucket_of(str(k)) != bucket_of("3"))
    state.upsert(typed([version(other, 2)]), 3)
    kept.refresh()
    agree(["unique"])
    state.upsert(typed([version(3, 3)]), 4)
    kept.refresh()
    agree([])
    # a row in a foreign bucket hides a copy of a key that is untouched
    state.upsert(typed([version(other, 3)]), 5)
    seed(bucket_of(str(other)), "3")
    kept.refresh()
    agree(["unique"])
    # a file changed behind the state's back is seen when everything is read
    copies = lambda: kept.results().agg(F.sum("not_unique")).first()[0]
    seed(next(b for b in range(16) if b not in (bucket_of("3"), bucket_of(str(other)))))
    kept.refresh()
    assert copies() == 0
    kept.refresh(everything=True)
    assert copies() == 1 and read[-1] == {r["state_bucket"] for r in state._manifest().collect()}
    agree(["unique"])


def test_the_table_may_not_count_more_than_the_kept_totals(spark):
    real = spark.createDataFrame([("2024-25", 5), ("2025-26", 2)], "heat_season string, fact_total bigint")
    mart = spark.createDataFrame([("2024-25", 3), ("2024-25", 2), ("2025-26", 3)], "heat_season string, no_heat_complaints bigint")
    assert values(quality.beyond(mart, real)) == [("2025-26", 3, 2)]


@pytest.mark.parametrize("sort", ["rate", "no_heat", "score"])
def test_leaderboard_ranks_nulls_last(spark, sort):
    rows = [("s", "1", 60000.0, 5, 5.0, None), ("s", "2", 60000.0, 4, 7.0, 3.0), ("s", "3", 10.0, 99, 99.0, 9.0), ("s", "4", 60000.0, 2, 9.0, 9.0)]
    lots = spark.createDataFrame(rows, "heat_season string, bbl string, gfa double, no_heat int, rate double, score double")
    want = {"rate": ["2", "1"], "no_heat": ["1", "2"], "score": ["2", "1"]}[sort]
    board = reports.leaderboard(lots, sort).orderBy(F.coalesce(F.col(sort), F.lit(-1)).desc())
    assert [r["bbl"] for r in board.collect()] == want


def test_peers_are_compared_without_a_join_on_the_zero_rate(spark):
    rows = [("s", str(i), float(1 + i % 40), 0.0 if i % 5 else float(i % 7)) for i in range(200)]
    lots = spark.createDataFrame(rows, "heat_season string, bbl string, gfa double, rate double")
    got = {r["bbl"]: r for r in reports.peer_comparison(lots).collect()}
    assert len(got) == 200
    groups = {}
    for r in rows:
        groups.setdefault(got[r[1]]["size_group"], []).append(r)
    for peers in groups.values():
        rates = sorted(p[3] for p in peers)
        for p in peers:
            r = got[p[1]]
            assert r["peers"] == len(peers) and r["peer_median"] == rates[len(rates) // 2]
            assert abs(r["pct_below"] - 100 * sum(x < p[3] for x in rates) / len(rates)) <= 0.5
