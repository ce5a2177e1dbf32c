"""Column helpers: key formats, casts, calendar, bands and labels."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from lotlens.functions import calendar as cal
from lotlens.functions import casts, keys, labels
from lotlens.operators.lots import explode_keys, explode_split
from lotlens.plans.models import build_property_lots
from tests.conftest import values


def lots_of(spark, rows):
    props = spark.createDataFrame(
        [(2024, pid, f"2024-{pid}", raw, None, None, float(gfa), None) for pid, raw, gfa in rows],
        "report_year int, property_id string, property_year_id string, bbl_raw string, "
        "primary_property_type string, energy_star_score int, gfa_sqft double, year_built int",
    )
    return values(build_property_lots(props).select("property_id", "bbl", "n_lots", "gfa_share_sqft"))


def test_every_known_key_format(spark):
    rows = [
        ("clean", "1020690001", 1000),
        ("dashed", "1-00545-0026", 1000),
        ("demo", "0000000001, 0000000002", 1000),
        ("campus", "3043930001;3043710001", 1000),
        ("missing", "Not Available", 1000),
        ("short", "2-545-26", 100),
        ("odd", "1-2-3-4", 100),
    ]
    assert lots_of(spark, rows) == [
        ("campus", "3043710001", 2, 500.0),
        ("campus", "3043930001", 2, 500.0),
        ("clean", "1020690001", 1, 1000.0),
        ("dashed", "1005450026", 1, 1000.0),
        ("short", "2005450026", 1, 100.0),
    ]


def test_rejected_and_repeated_keys(spark):
    rows = [
        ("null", None, 1),
        ("empty", "", 1),
        ("twice", "1-545-26; 1005450026", 8),
        ("eleven", "10054500261", 1),
        ("newline", "1005450026\n", 1),
        ("long block", "1-123456-0026", 1),
        ("one dash", "1-2", 1),
        ("mixed", " 1005450026 , 9005450026;2-1-1", 8),
    ]
    assert lots_of(spark, rows) == [
        ("mixed", "1005450026", 2, 4.0),
        ("mixed", "2000010001", 2, 4.0),
        ("twice", "1005450026", 1, 8.0),
    ]


def test_keys_against_plain_python(spark):
    rng = random.Random(3)
    pick = ["1", "0", "5", "6", "-", ";", ",", " ", "1005450026", "2-545-26", "3043930001"]
    raws = ["".join(rng.choice(pick) for _ in range(rng.randint(0, 6))) for _ in range(400)]

    def expected(raw):
        out = set()
        for piece in (p.strip(" ") for p in re.split("[;,]", raw)):
            parts = piece.split("-")
            if len(parts) == 3:
                piece = parts[0] + parts[1].rjust(5, "0") + parts[2].rjust(4, "0")
            if len(parts) in (1, 3) and re.fullmatch("[1-5][0-9]{9}", piece):
                out.add(piece)
        return out

    df = spark.createDataFrame(list(enumerate(raws)), "id int, raw string")
    got = {}
    for row in explode_keys(df, "raw", "bbl").collect():
        got.setdefault(row["id"], []).append(row["bbl"])
    for i, raw in enumerate(raws):
        assert sorted(got.get(i, [])) == sorted(expected(raw)), raw


def test_explode_split_keeps_every_piece(spark):
    df = spark.createDataFrame([("a; b,c",), (None,)], "raw string")
    assert [r["piece"] for r in explode_split(df, "raw").collect()] == ["a", "b", "c", ""]


def test_tolerant_casts(spark):
    df = spark.createDataFrame([("25.7",), ("2.5",), ("x",), ("Not Available",), (None,), ("30",)], "v string")
    got = df.select(
        casts.try_num("v"), casts.try_int_rounded("v"), casts.try_whole("v"), casts.null_if_any("v", "x", "30")
    ).collect()
    assert [tuple(r) for r in got] == [
        (25.7, 26, 26, "25.7"),
        (2.5, 3, 3, "2.5"),
        (None, None, None, None),
        (None, None, None, "Not Available"),
        (None, None, None, None),
        (30.0, 30, 30, None),
    ]


def test_tolerant_timestamps_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("1995-04-02T02:30:00", "2001-09-03T00:00:00Z"), ("no", "no")], "a string, b string")
            got = df.select(
                casts.iso_text(casts.try_ts("a")),
                casts.utc_wall_clock(casts.try_ts("b", zoned=True)).cast("string"),
                cal.month_label(casts.try_ts("a")),
            ).collect()
            assert tuple(got[0]) == ("1995-04-02T02:30:00", "2001-09-03 00:00:00", "1995-04")
            assert tuple(got[1]) == (None, None, None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_least_is_null_if_any_argument_is(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (7, None), (9, 5)], "a int, b int")
    assert [r[0] for r in df.select(casts.null_safe_least("a", "b")).collect()] == [1, None, None, 5]


def test_season_calendar(spark):
    days = ["2025-09-30", "2025-10-01", "2025-12-31", "2026-01-01", "2026-05-31", "2026-06-01", None, "1999-10-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    got = df.select(cal.season_start_year("d"), cal.season_label("d")).collect()
    assert [tuple(r) for r in got] == [
        (2024, None),
        (2025, "2025-26"),
        (2025, "2025-26"),
        (2025, "2025-26"),
        (2025, "2025-26"),
        (2025, None),
        (None, None),
        (1999, "1999-00"),
    ]


def test_season_bounds_and_previous(spark):
    df = spark.createDataFrame([("2000-01",), ("1999-00",)], "s string")
    start, end = cal.season_bounds("s")
    assert [tuple(r) for r in df.select(start, end, cal.prev_season("s")).collect()] == [
        (dt.date(2000, 10, 1), dt.date(2001, 5, 31), "1999-00"),
        (dt.date(1999, 10, 1), dt.date(2000, 5, 31), "1998-99"),
    ]


def test_minutes_count_boundaries(spark):
    df = spark.sql(
        "select timestamp_ntz'2026-01-01 10:00:59' a, timestamp_ntz'2026-01-01 10:01:01' b "
        "union all select timestamp_ntz'2026-01-01 23:59:00', timestamp_ntz'2026-01-03 00:00:00' "
        "union all select timestamp_ntz'2026-01-02 00:00:00', timestamp_ntz'2026-01-01 00:00:00' "
        "union all select timestamp_ntz'2026-03-08 01:59:00', timestamp_ntz'2026-03-08 03:01:00'"
    )
    got = df.select(cal.boundary_minutes("a", "b"), cal.close_minutes("a", "b")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (1441, 1441), (-1440, None), (62, 62)]


def test_score_bands(spark):
    scores = [25.0, 25.0001, 50.0, 75.0, 75.0001, 100.0, 100.5, 0.0, -1.0, None]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [tuple(r) for r in df.select(labels.score_band("s"), labels.score_band_cut("s")).collect()]
    assert got == [
        ("1-25", "1-25"),
        ("26-50", "26-50"),
        ("26-50", "26-50"),
        ("51-75", "51-75"),
        ("76-100", "76-100"),
        ("76-100", "76-100"),
        ("76-100", None),
        ("1-25", "1-25"),
        ("1-25", None),
        (None, None),
    ]


def test_eras(spark):
    years = [0, -5, 1, 1929, 1930, 1959, 1960, 1989, 1990, 2030, 2031, None]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = df.select(labels.era("y"), labels.era_cut("y"), labels.ordinal(labels.era("y"), labels.ERAS)).collect()
    assert [r[0] for r in got] == [
        None, None, "pre-1930", "pre-1930", "1930-59", "1930-59", "1960-89", "1960-89", "1990+", "1990+", "1990+", None,
    ]
    assert [r[1] for r in got][-3:] == ["1990+", None, None]
    assert [r[2] for r in got][2:10] == [1, 1, 2, 2, 3, 3, 4, 4]


def test_region_and_title_case(spark):
    rows = [
        ("1000000001", None, "Manhattan"),
        ("5000000001", "x", "Staten Island"),
        (None, "STATEN ISLAND", "Staten Island"),
        (None, "Unspecified", "Unknown"),
        (None, "", "Unknown"),
        (None, None, "Unknown"),
        ("9", "the bronx", "The Bronx"),
    ]
    df = spark.createDataFrame(rows, "k string, f string, want string")
    assert df.filter(~labels.region_name("k", "f").eqNullSafe(F.col("want"))).count() == 0
    texts = [
        ("123-45 O'BRIEN st/east", "123-45 O'brien St/East"),
        ("a.b (c)", "A.B (C)"),
        ("", ""),
        (None, None),
        ("12th\tave", "12th\tAve"),
    ]
    df = spark.createDataFrame(texts, "t string, want string")
    bad = df.filter(~labels.title_case("t").eqNullSafe(F.col("want"))).collect()
    assert bad == []


def test_rate_and_flag(spark):
    df = spark.createDataFrame([(2, 100000.0, "NO HEAT"), (1, 0.0, None), (1, None, "x")], "n int, a double, d string")
    got = df.select(labels.rate("n", "a"), casts.in_or_false("d", labels.NO_HEAT)).collect()
    assert [tuple(r) for r in got] == [(2.0, True), (None, False), (None, False)]


def test_surrogate_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([(2024, "a"), (None, "a")], "y int, k string")
    assert [r[0] for r in df.select(keys.surrogate_key("y", "k")).collect()] == ["2024-a", None]
