"""Generic operators against brute force, with ties and hot keys."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotlens import session
from lotlens.operators import digests, joins, latest, lots, profile, quality, ranks, sketches, stats
from tests.conftest import values


@pytest.fixture(scope="module")
def measured(spark):
    """Three groups, one of them large, in which one value is held by a third of all rows."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        group = rng.choice(["a", "a", "a", "b", "c"])
        value = 5.0 if rng.random() < 0.4 else round(rng.uniform(0, 20), 1)
        rows.append((i, group, value))
    rows += [(9001, "d", 1.0), (9002, "d", 2.0), (9003, "e", 4.0)]
    df = spark.createDataFrame(rows, "id int, g string, v double").repartition(7).cache()
    return df, rows


def by_group(rows):
    out = defaultdict(list)
    for _, g, v in rows:
        out[g].append(v)
    return {g: sorted(vs) for g, vs in out.items()}


def test_ntile_equals_the_window_function(spark, measured):
    df, _ = measured
    for n in (2, 4, 7):
        ours = ranks.ntile_by(df, ["g"], "v", "id", n, "q")
        window = F.ntile(n).over(Window.partitionBy("g").orderBy("v", "id"))
        both = ours.withColumn("w", window)
        assert both.filter(F.col("q") != F.col("w")).count() == 0
        assert ours.count() == df.count()


def test_median_and_order_statistics(spark, measured):
    df, rows = measured
    got = ranks.exact_median(ranks.weigh(df, ["g"], ["v"]), ["g"], "v", "m")
    assert {r["g"]: r["m"] for r in got.collect()} == {
        g: float(np.median(vs)) for g, vs in by_group(rows).items()
    }
    spots = {"q80": ranks.nearest_rank(0.8), "up": ranks.upper_median, "top": lambda n: n - 1}
    for r in ranks.order_statistics(df, ["g"], "v", spots).collect():
        vs = by_group(rows)[r["g"]]
        n = len(vs)
        assert (r["group_rows"], r["q80"], r["up"], r["top"]) == (n, vs[int(0.8 * (n - 1))], vs[n // 2], vs[-1])


def test_order_statistics_without_groups(spark, measured):
    df, rows = measured
    whole = sorted(v for _, _, v in rows)
    got = ranks.order_statistics(df, [], "v", {"mid": ranks.upper_median}).first()
    assert got["mid"] == whole[len(whole) // 2]


def test_qcut_cuts_like_interpolated_quantiles(spark, measured):
    df, rows = measured
    labels = ["q1", "q2", "q3", "q4"]
    got = {r["id"]: r["bin"] for r in ranks.qcut(df, ["g"], "v", labels, "bin").collect()}
    groups = by_group(rows)
    for i, g, v in rows:
        cuts = np.quantile(groups[g], [0.25, 0.5, 0.75])
        assert got[i] == labels[int(np.searchsorted(cuts, v, side="left"))]


def test_cumulative_counts_strictly_smaller_rows(spark, measured):
    df, rows = measured
    groups = by_group(rows)
    got = ranks.cumulative(ranks.weigh(df, ["g"], ["v"]), ["g"], ["v"]).collect()
    assert len(got) == sum(len(set(vs)) for vs in groups.values())
    for r in got:
        vs = groups[r["g"]]
        assert r["below"] == sum(x < r["v"] for x in vs) and r["group_rows"] == len(vs)
        assert r["weight"] == vs.count(r["v"])


def test_latest_by_is_idempotent_and_order_free(spark):
    rows = [("k", 1, "f1", "old"), ("k", 2, "f1", "new"), ("k", 2, "f2", "newest"), ("x", None, "f9", "n"), ("x", 0, "f0", "y")]
    rows += [("hot", i, "f", str(i)) for i in range(2000)]
    schema = "key string, version int, file string, payload string"
    want = [("hot", 1999, "f", "1999"), ("k", 2, "f2", "newest"), ("x", 0, "f0", "y")]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, schema).repartition(5)
        once = latest.latest_by(df, ["key"], ["version", "file"])
        assert values(once) == want
        assert values(latest.latest_by(once.union(once), ["key"], ["version", "file"])) == want


def test_latest_by_limits_a_group_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest.latest_by(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and exchange < partial  # below the exchange in the tree


def test_top_n_in_two_steps(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4900, "hot").otherwise("cold").alias("g"), "id", (F.col("id") % 97).alias("v"))
    for n in (3, 200, 1500):
        got = values(latest.top_n(df, ["g"], [F.desc("v"), F.asc("id")], n, "id"))
        assert got == values(latest.first_per(df, ["g"], [F.desc("v"), F.asc("id")], n))


def test_latest_load_keeps_ties_of_the_newest_load(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")]
    df = spark.createDataFrame(rows, "source_file string, loaded_at int, p string")
    assert [r[2] for r in values(latest.latest_load(df))] == ["y", "z", "w"]


def test_latest_load_does_not_gather_the_rows_of_a_file(spark, capsys):
    rows = spark.range(5_000_000).selectExpr("cast(id % 2 as string) source_file", "id % 3 loaded_at", "id % 7 batch", "id")
    newest = latest.latest_load(rows)
    newest.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    newest = newest.agg(F.count("id"), F.min("loaded_at"), F.min("batch"))
    assert newest.first()[:] == (sum(i % 3 == 2 and i % 7 == 6 for i in range(5_000_000)), 2, 6)


def test_latest_load_of_null_stamps_and_files(spark):
    rows = [("a", None, 1), ("a", None, 2), ("b", None, 1), ("b", 5, 2), (None, 1, 3)]
    df = spark.createDataFrame(rows, "source_file string, loaded_at int, n int")
    assert values(latest.latest_load(df)) == [("a", None, 1), ("a", None, 2), ("b", 5, 2)]
    again = df.withColumn("batch", F.lit(1))
    assert values(latest.latest_load(again).drop("batch")) == [("a", None, 1), ("a", None, 2), ("b", 5, 2)]


def test_top_per_keeps_null_measures_last(spark):
    df = spark.createDataFrame([("a", None, "1"), ("a", 2.0, "3"), ("a", 2.0, "2"), ("b", None, "9")], "k string, m double, t string")
    assert values(latest.top_per(df, ["k"], "m", "t")) == [("a", 2.0, "2"), ("b", None, "9")]


def test_even_split_preserves_the_measure(spark):
    rows = [("hot", f"l{i}", 1000.0) for i in range(500)] + [("one", "l", 7.0)]
    df = spark.createDataFrame(rows, "owner string, lot string, area double")
    split = lots.even_split(df, ["owner"], "area")
    sums = {r["owner"]: r["s"] for r in split.groupBy("owner").agg(F.sum("gfa_share_sqft").alias("s")).collect()}
    assert sums["one"] == 7.0 and abs(sums["hot"] - 1000.0) < 1e-6


def test_weighted_mean(spark):
    rows = [("a", 100, 33.3), ("b", 50, 1.0), ("b", None, 99.0), ("b", 100, 3.0), ("c", None, 1.0), ("d", 10, 0.0)]
    df = spark.createDataFrame(rows, "k string, s int, w double")
    assert values(lots.weighted_mean(df, ["k"], "s", "w")) == [("a", 100.0), ("b", 87.5), ("c", None), ("d", None)]


def test_keep_zeros_and_match_rates(spark):
    people = spark.createDataFrame([("a",), ("b",)], "k string")
    counts = spark.createDataFrame([("a", 3), ("z", 1), (None, 4)], "k string, n int")
    assert values(joins.keep_zeros(people, counts, ["k"], ["n"])) == [("a", 3), ("b", 0)]
    assert values(joins.match_rates(counts, people.union(people), "k", "n", "s")) == [("s", 0.3333, 0.375)]


def test_completeness_keeps_months_of_both_sides(spark):
    source = spark.createDataFrame([("1",), ("1",), ("2",)], "m string")
    got = spark.createDataFrame([("1",), ("3",)], "m string")
    assert values(joins.completeness(source, got, "m")) == [("1", 2, 1, 0.5), ("2", 1, 0, 0.0), ("3", 0, 1, None)]


def test_union_and_missing_keys(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    assert values(joins.union_all(a, b)) == [(1, "x"), (2, None)]
    assert values(joins.missing_in_source(a.select("k"), b, "k")) == [(1,)]


def test_format_profile(spark):
    raws = ["1020690001", "1-2-3", "a,b", "0000000000", "weird", "weird", None]
    df = spark.createDataFrame([(r,) for r in raws], "k string")
    assert values(profile.format_census(df, "k")) == [(2, 1, 1, 1)]
    assert [tuple(r) for r in profile.unknown_formats(df, "k").collect()] == [("weird", 2), (None, 1)]


def test_duplicates_and_shares(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, i int")
    assert values(profile.duplicated(df, ["k"])) == [("a", 2)]
    assert values(profile.duplicated_rows(df, ["k"])) == [("a", 1), ("a", 2)]
    assert [tuple(r) for r in profile.category_counts(df, "k").collect()] == [("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25)]
    assert tuple(profile.fill_rate(df, ["k", "i"]).first()) == (0.75, 1.0)


def test_sample_has_exactly_n_distinct_rows_and_is_repeatable(spark):
    df = spark.range(20000)
    for n in (1, 50, 5000):
        got = [r["id"] for r in profile.sample_rows(df, n, n, "id").collect()]
        assert len(got) == n == len(set(got))
        assert sorted(got) == sorted(r["id"] for r in profile.sample_rows(df.repartition(3), n, n, "id").collect())
    assert profile.sample_rows(spark.range(7), 50, 1, "id").count() == 7
    spread = Counter(r["id"] // 5000 for r in profile.sample_rows(df, 4000, 5, "id").collect())
    assert all(850 < spread[q] < 1150 for q in range(4))
    per = df.withColumn("g", F.when(F.col("id") < 30, "a").otherwise("b"))
    assert Counter(r["g"] for r in profile.sample_rows(per, 100, 1, "id", ["g"]).collect()) == {"a": 30, "b": 100}


def test_checks_and_gate(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 101.0), (None, None)], "k string, v double")
    assert quality.check_not_null(df, "k").count() == quality.check_range(df, "k", "v", 1, 100).count() == 1
    assert quality.check_accepted(df, "k", ["a"]).count() == 0
    results = quality.run_checks(
        [
            quality.Offending("unique", quality.check_unique(df, "k")),
            quality.Failing("not null", df, quality.nulls("k")),
            quality.Failing("accepted", df, quality.odd_values("k", ["a"])),
            quality.Failing("range", df, quality.outside("v", 1, 100)),
            quality.Failing("empty", df.limit(0), quality.nulls("k")),
        ]
    )
    assert values(results) == [
        ("accepted", True, 0), ("empty", True, 0), ("not null", False, 1), ("range", False, 1), ("unique", False, 1),
    ]
    assert not quality.may_publish(results)
    assert quality.may_publish(results.filter("passed"))
    assert tuple(quality.run_summary(results, 6, "t").first()) == ("t", 5, 2, 6)


def test_checks_of_one_table_share_a_scan(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = quality.run_checks([quality.Failing(str(i), df, quality.nulls("id")) for i in range(6)])
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_freshness_levels(spark):
    df = spark.sql("select timestamp_ntz'2026-01-01 00:00:00' t")
    for now, want in (("2026-01-04 00:00:00", "pass"), ("2026-01-04 00:00:01", "warn"), ("2026-01-06 00:00:01", "error")):
        assert quality.freshness(df, "t", now).first()["status"] == want
    assert quality.freshness(df.limit(0), "t", "2026-01-04 00:00:00").first()["status"] == "error"
    pacific = quality.freshness(df, "t", "2026-01-04 07:00:00", zone="America/Los_Angeles").first()
    assert str(pacific["max_loaded"]) == "2026-01-01 08:00:00" and pacific["status"] == "pass"


def glm(y, x, offset):
    beta = np.zeros(x.shape[1])
    beta[0] = np.log(y.sum() / np.exp(offset).sum())
    for _ in range(60):
        mu = np.exp(x @ beta + offset)
        beta = beta + np.linalg.solve((x * mu[:, None]).T @ x, x.T @ (y - mu))
    mu = np.exp(x @ beta + offset)
    bread = np.linalg.inv((x * mu[:, None]).T @ x)
    return beta, np.sqrt(np.diag(bread @ ((x * ((y - mu) ** 2)[:, None]).T @ x) @ bread))


def test_poisson_model_matches_plain_newton(spark):
    rng = np.random.default_rng(5)
    n = 400
    score, area = rng.uniform(1, 10, n), rng.uniform(10, 12, n)
    era = rng.choice(["old", "mid", "new"], n)
    y = rng.poisson(np.exp(area - 11 - 0.05 * score + 0.3 * (era == "mid"))).astype(float)
    x = np.column_stack([np.ones(n), score, area, era == "mid", era == "new"]).astype(float)
    beta, se = glm(y, x, area)
    rows = [(float(a), float(b), float(c), str(d)) for a, b, c, d in zip(y, score, area, era, strict=True)]
    df = spark.createDataFrame(rows + [(None, 1.0, 1.0, "old"), (1.0, 1.0, 1.0, None)], "y double, s double, a double, era string")
    got = stats.poisson_rates(df, "y", ["s", "a"], "era", ["old", "mid", "new"], "a").collect()
    assert [r["term"] for r in got] == ["Intercept", "s", "a", "era[mid]", "era[new]"]
    for r, b, s in zip(got, beta, se, strict=True):
        assert r["rate_ratio"] == pytest.approx(np.exp(b), rel=1e-5)
        assert r["low_95"] == pytest.approx(np.exp(b - 1.959964 * s), rel=1e-4)
        assert r["high_95"] == pytest.approx(np.exp(b + 1.959964 * s), rel=1e-4)


def test_category_model_is_the_saturated_model(spark):
    rng = np.random.default_rng(6)
    n = 200
    area = rng.uniform(1, 5, n)
    era = rng.choice(["old", "new"], n)
    y = rng.poisson(area * np.where(era == "old", 2.0, 1.0)).astype(float)
    x = np.column_stack([np.ones(n), era == "new"]).astype(float)
    beta, se = glm(y, x, np.log(area))
    df = spark.createDataFrame([(float(a), str(b), float(c)) for a, b, c in zip(y, era, area, strict=True)], "y double, era string, area double")
    got = stats.category_rate_ratios(df, "y", "era", "old", "area").first()
    assert got["rate_ratio"] == pytest.approx(np.exp(beta[1]), abs=1e-4)
    assert got["se"] == pytest.approx(se[1], abs=1e-4)


def shuffled_rows(df):
    """Rows that the exchanges of a plan wrote, map-side sums apart."""
    df.collect()
    seen, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "ShuffleExchange" in node.getClass().getSimpleName():
            seen.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "AdaptiveSparkPlan" in node.getClass().getSimpleName():
            todo.append(node.executedPlan())
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return seen


@pytest.mark.parametrize("listed", [range(0), range(5000), [*range(1, 5000), 9999], [i for i in range(5000) if i % 3]])
def test_missing_keys_by_digest(spark, listed):
    ours = spark.createDataFrame([(str(i),) for i in range(5000)] + [("7",), (None,)], "k string")
    theirs = spark.createDataFrame([(str(i),) for i in listed] + [(None,)] * 2, "k string")
    got = digests.missing_by_digest(ours, theirs, "k", 512)
    assert values(got) == values(joins.missing_in_source(ours, theirs, "k"))


def test_only_differing_buckets_move(spark):
    ours = session.materialize(spark.range(20_000).select(F.col("id").cast("string").alias("k")), "ours")
    theirs = session.materialize(ours.filter("k <> '77'"), "theirs")
    assert digests.differing_buckets(ours, theirs, "k", 1000).count() == 1
    got = digests.missing_by_digest(ours, theirs, "k", 1000)
    assert values(got) == [("77",)] and sum(shuffled_rows(got)) < 200


def test_sketches_stay_within_their_bounds(spark):
    rows = spark.range(200_000).select(
        (F.col("id") % 50).alias("day"), (F.col("id") % 3).alias("region"), (F.hash("id") % 60_000).alias("lot"),
        (F.abs(F.hash("id", F.lit(1))) % 100_000).cast("double").alias("hours"),
    )
    rows = session.materialize(rows.unionByName(spark.createDataFrame([(99, 9, None, None)], rows.schema)), "rows")
    exact = {r["region"]: r["n"] for r in rows.groupBy("region").agg(F.count_distinct("lot").alias("n")).collect()}
    days = sketches.distinct_sketches(rows, ["day", "region"], "lot")
    merged = {r["region"]: r["n"] for r in sketches.merge_distinct(days, ["region"], "n").collect()}
    assert merged.keys() == exact.keys() and merged[9] == exact[9] == 0
    assert all(abs(merged[r] - n) <= sketches.distinct_error() * n for r, n in exact.items())
    hours = sketches.quantile_sketches(rows, ["day", "region"], "hours")
    for q in (0.1, 0.5, 0.99):
        for r in sketches.merge_quantiles(hours, ["region"], q, "v").collect():
            own = [x["hours"] for x in rows.filter(F.col("region") == r["region"]).select("hours").collect()]
            below, upto = sum(x < r["v"] for x in own) / len(own), sum(x <= r["v"] for x in own) / len(own)
            assert below - sketches.rank_error() <= q <= upto + sketches.rank_error()
    assert {r["region"] for r in sketches.merge_quantiles(hours, ["region"], 0.5, "v").collect()} == {0, 1, 2}
