"""Extraction, raw landing, the file ledger, exports: retries, crashes and overwrites."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotlens import session
from lotlens.operators import latest
from lotlens.plans import bindings
from lotlens.sources import export, extract, files, raw
from lotlens.session import work_dir
from lotlens.sources.state import Bookmark
from tests.conftest import values


def log(spark, rows):
    return spark.createDataFrame(rows, "k string, t string").select(
        "k", F.col("t").cast("timestamp_ntz").alias("ts")
    )


def test_extract_pins_the_upper_bound(spark):
    df = log(spark, [("a", "2026-01-01"), ("b", "2026-01-02 03:04:05.123456"), ("c", "2026-01-01 12:00:00")])
    got = extract.extract_since(df, "ts", "2026-01-01", F.col("k") != "z")
    assert (got.upper, got.expected) == ("2026-01-02 03:04:05.123456", 2)
    assert values(got.rows.select("k")) == [("b",), ("c",)]
    empty = extract.extract_since(df, "ts", "2026-02-01")
    assert (empty.upper, empty.expected, empty.rows.count()) == (None, 0, 0)


def test_extract_ignores_rows_that_arrive_meanwhile(spark, tmp_path):
    path = str(tmp_path / "src")
    log(spark, [("a", "2026-01-01")]).write.parquet(path)
    got = extract.extract_since(spark.read.parquet(path), "ts", "2025-01-01")
    log(spark, [("b", "2026-01-05")]).write.mode("append").parquet(path)
    again = spark.read.parquet(path).filter(F.col("ts") <= F.lit(got.upper).cast("timestamp_ntz"))
    assert again.count() == got.expected == 1


def test_a_partial_load_changes_nothing(spark, tmp_path):
    path, df = str(tmp_path / "landed"), spark.range(5).withColumn("p", F.col("id") % 2)
    extract.land(df, 5, path, "p")
    with pytest.raises(extract.ReconciliationError, match="announced 6 rows, 5 arrived"):
        extract.land(df.withColumn("id", F.col("id") + 10), 6, path, "p")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]
    assert sorted(os.listdir(path)) == ["p=0", "p=1"]
    extract.land(df.filter("p = 1").withColumn("id", F.col("id") + 10), 2, path, "p")
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 2, 4, 11, 13]
    other = str(tmp_path / "other")
    assert extract.checked_load(extract.Extract(df.limit(0), None, 0), other, "p") == 0 and not os.path.exists(other)
    assert extract.checked_load(extract.Extract(df, "x", 5), other, "p") == 5


def test_a_failed_move_brings_the_old_rows_back(spark, tmp_path):
    path, df = str(tmp_path / "landed"), spark.range(4).withColumn("p", F.lit(0))
    extract.land(df, 4, path, "p")
    with pytest.raises(Exception):  # noqa: B017  the store says it its own way
        files.replace(spark, f"{path}/nothing", f"{path}/p=0")
    assert spark.read.parquet(path).count() == 4 and os.listdir(path) == ["p=0"]
    os.rename(f"{path}/p=0", f"{path}/{files.ASIDE}p=0")  # as a crash between the two moves leaves it
    files.restore(spark, f"{path}/p=0")
    assert spark.read.parquet(path).count() == 4
    os.rename(f"{path}/p=0", f"{path}/{files.ASIDE}p=0")
    extract.land(df.limit(2), 2, path, "p")
    assert spark.read.parquet(path).count() == 2 and os.listdir(path) == ["p=0"]


def test_reconcile_report_lists_both_sides(spark):
    a = spark.createDataFrame([("f1",), ("f1",), ("f2",)], "f string")
    b = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "f string")
    assert values(extract.reconcile_report(a, b, "f")) == [("f1", 2, 1, False), ("f2", 1, 1, True), ("f3", 0, 1, False)]


def test_months(spark):
    got = [tuple(r) for r in extract.month_windows(spark, "2025-11", "2026-02-28").collect()]
    assert [g[0] for g in got] == ["2025-11", "2025-12", "2026-01", "2026-02"]
    assert got[1][1:] == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))
    assert extract.month_windows(spark, "2026-03", "2026-02-28").count() == 0
    df = log(spark, [("a", "2025-11-30 23:59:59"), ("b", "2026-01-01"), ("c", "2026-03-01"), ("d", "2025-10-31")])
    counts = extract.counts_by_month(df, "ts", "2025-11", "2026-02-01")
    assert values(counts) == [("2025-11", 1), ("2025-12", 0), ("2026-01", 1), ("2026-02", 0)]
    assert values(extract.month_windows_of(df, "ts").select("label"))[0] == ("2025-10",)


def test_nested_values_become_text(spark):
    df = spark.sql("select 1 a, named_struct('x', 1, 'y', array('p')) s, array(1, 2) l, map('k', 2) m, 'text' t")
    assert tuple(raw.nested_to_json(df).first()) == (1, '{"x":1,"y":["p"]}', "[1,2]", '{"k":2}', "text")


def test_raw_write_is_idempotent_per_window(spark, tmp_path):
    path = str(tmp_path / "raw")
    day = log(spark, [("a", "2026-01-01"), ("b", "2026-01-01")])
    raw.write_raw(day, path, "u1", 2, "2026-01-02")
    raw.write_raw(day, path, "u1", 2, "2026-01-02")
    assert spark.read.parquet(path).count() == 2
    raw.write_raw(log(spark, [("c", "2026-01-02")]), path, "u2", 1, "2026-01-02")
    assert spark.read.parquet(path).count() == 3
    assert raw.write_raw(day.limit(0), path, "u3", 0, "2026-01-02") is None


def test_ingest_moves_the_bookmark_last(spark, tmp_path, monkeypatch):
    path, mark = str(tmp_path / "raw"), Bookmark(spark, str(tmp_path / "mark"))
    source = log(spark, [("a", "2026-01-01"), ("b", "2026-01-03")])
    with monkeypatch.context() as crash:
        crash.setattr(Bookmark, "set", lambda self, value: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            raw.ingest(source, "ts", path, mark, run_date="2026-01-04")
    assert mark.get() is None
    first = raw.ingest(source, "ts", path, mark, run_date="2026-01-04")
    assert (first["rows"], first["old"], first["new"]) == (2, "1970-01-01", "2026-01-03 00:00:00")
    assert spark.read.parquet(path).count() == 2  # the repeated window replaced itself
    assert raw.ingest(source, "ts", path, mark)["rows"] == 0
    later = source.union(log(spark, [("a", "2026-01-05")]))
    assert raw.ingest(later, "ts", path, mark, run_date="2026-01-04")["rows"] == 1
    assert mark.get() == "2026-01-05 00:00:00" and spark.read.parquet(path).count() == 3


def test_backfill_and_year_loads_overwrite_their_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = log(spark, [("a", "2026-01-05"), ("b", "2026-03-05"), ("c", "2026-03-06"), ("d", "2026-05-01")])
    want = [("2026-01", 1), ("2026-02", 0), ("2026-03", 2), ("2026-04", 0)]
    for _ in range(2):
        assert values(raw.backfill(rows, "ts", path, "2026-01-01", "2026-05-01")) == want
    assert sorted(os.listdir(path))[-2:] == ["created_month=2026-01", "created_month=2026-03"]
    raw.backfill(rows.filter("k = 'b'"), "ts", path, "2026-03-01", "2026-04-01")
    assert values(spark.read.parquet(path).select("k")) == [("a",), ("b",)]

    years = str(tmp_path / "years")
    props = spark.createDataFrame([("2023", "p"), ("2024", "p"), ("2024", "q")], "report_year string, id string")
    assert values(raw.load_years(props, years)) == [("2023", 1), ("2024", 2)]
    assert values(raw.load_years(props, years, ["2024"])) == [("2024", 2)]
    assert spark.read.parquet(years).count() == 3
    assert "report_year" in spark.read.parquet(years).columns


def write_file(spark, path, rows, schema="k string, v string"):
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = [c.split()[0] for c in schema.split(", ")]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}), path)


def test_ledger_loads_each_file_version_once(spark, tmp_path):
    stage = str(tmp_path / "stage")
    table = raw.RawTable(spark, str(tmp_path / "table"))
    write_file(spark, f"{stage}/dt=1/a.parquet", [("x", "1"), ("y", "1")])
    assert table.load(stage, "2026-01-01") == 1
    assert table.load(stage, "2026-01-02") == 0
    # a new file with another column, and an overwritten one
    write_file(spark, f"{stage}/month=2/b.parquet", [("z", "1", "e")], "k string, v string, extra string")
    write_file(spark, f"{stage}/dt=1/a.parquet", [("x", "2"), ("y", "2"), ("w", "2")])
    assert table.load(stage, "2026-01-03") == 2
    rows = table.rows().select(
        F.try_variant_get("record", "$.k", "string"),
        F.try_variant_get("record", "$.v", "string"),
        F.try_variant_get("record", "$.extra", "string"),
        raw.base_name(F.col("source_file")),
        F.col("loaded_at").cast("string"),
    )
    day1, day3 = "2026-01-01 00:00:00", "2026-01-03 00:00:00"
    assert values(rows) == sorted(
        [("x", "1", None, "a.parquet", day1), ("y", "1", None, "a.parquet", day1)]
        + [(k, "2", None, "a.parquet", day3) for k in "wxy"]
        + [("z", "1", "e", "b.parquet", day3)],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )
    per_file = raw.rows_per_file(table.rows().withColumn("source_file", raw.base_name(F.col("source_file"))))
    assert [(r[0], r[1]) for r in values(per_file)] == [("a.parquet", 5), ("b.parquet", 1)]


def test_crash_between_rows_and_ledger_leaves_no_duplicates(spark, tmp_path, monkeypatch):
    stage, table = str(tmp_path / "stage"), raw.RawTable(spark, str(tmp_path / "table"))
    write_file(spark, f"{stage}/a.parquet", [("x", "1")])
    table.load(stage, "2026-01-01")
    write_file(spark, f"{stage}/b.parquet", [("y", "1")])
    good = table.ledger_path
    with monkeypatch.context() as crash:
        crash.setattr(table, "ledger_path", "/proc/nowhere")  # writing the ledger fails
        crash.setattr(raw.RawTable, "ledger", lambda self: raw.read_or_empty(spark, good, raw.LEDGER_SCHEMA))
        with pytest.raises(Exception, match="nowhere"):
            table.load(stage, "2026-01-02")
    assert table.rows().count() == 1  # uncommitted rows stay invisible
    assert table.load(stage, "2026-01-02") == 1
    assert table.rows().count() == 2


def test_a_batch_replaces_what_a_crash_left_in_its_folder(spark, tmp_path):
    stage, table = str(tmp_path / "stage"), raw.RawTable(spark, str(tmp_path / "table"))
    write_file(spark, f"{stage}/a.parquet", [("x", "1")])
    write_file(spark, f"{stage}/b.parquet", [("y", "1", "e")], "k string, v string, extra string")
    left = spark.sql("select parse_json('1') record, 'old' source_file, timestamp_ntz'2026-01-01' loaded_at")
    left.write.parquet(f"{table.rows_path}/batch=1")
    os.remove(f"{table.rows_path}/batch=1/_SUCCESS")
    assert table.load(stage, "2026-01-02") == 2
    assert table.rows().select("batch").distinct().first()[0] == 1 and table.rows().count() == 2
    # written as a folder of its own, not sorted by a partition column
    assert os.path.exists(f"{table.rows_path}/batch=1/_SUCCESS")


def test_many_files_are_loaded_in_bounded_batches(spark, tmp_path):
    stage, table = str(tmp_path / "stage"), raw.RawTable(spark, str(tmp_path / "table"))
    for i in range(5):
        write_file(spark, f"{stage}/{i}.parquet", [(str(i), "1")])
    assert table.load(stage, "2026-01-01", files_per_batch=2) == 5
    assert table.rows().count() == 5
    assert table.ledger().agg(F.max("batch")).first()[0] == 3
    assert table.load(stage, "2026-01-02", files_per_batch=2) == 0


def test_files_of_differing_types_are_loaded_as_they_are(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    stage, table = tmp_path / "stage", raw.RawTable(spark, str(tmp_path / "table"))
    stage.mkdir()
    pq.write_table(pa.table({"k": ["a"], "score": ["n/a"], "closed": ["x"]}), stage / "text.parquet")
    pq.write_table(pa.table({"k": ["b"], "score": [7], "closed": pa.nulls(1)}), stage / "number.parquet")
    pq.write_table(pa.table({"k": ["c"]}), stage / "few.parquet")
    assert table.load(str(stage)) == 3
    got = {}
    for r in table.rows().select(F.to_json("record").alias("r"), "loaded_at").collect():
        record = json.loads(r["r"])
        got[record["k"]] = record
        assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - r["loaded_at"]).total_seconds()) < 600
    # a record holds its own file's columns, whatever else was in the batch
    assert got == {"a": {"k": "a", "score": "n/a", "closed": "x"}, "b": {"k": "b", "score": 7, "closed": None}, "c": {"k": "c"}}


def jobs_of(spark, run):
    """Spark jobs that ``run`` starts."""
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_jobs_of_a_load_do_not_grow_with_its_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    counts = []
    for files in (4, 24):
        stage, table = tmp_path / f"stage{files}", raw.RawTable(spark, str(tmp_path / f"table{files}"))
        stage.mkdir()
        for i in range(files):
            kind = pa.table({"k": [i]}) if i % 2 else pa.table({"k": [str(i)], "other": [i]})
            pq.write_table(kind, stage / f"{i}.parquet")
        counts.append(jobs_of(spark, lambda: table.load(str(stage))))
        assert table.rows().count() == files
    assert counts[0] == counts[1] < 24


@pytest.mark.parametrize("small", [raw.SMALL_FILE, 0])
def test_schema_marks(spark, tmp_path, monkeypatch, small):
    """Marks are equal where Spark's schemas are, read by tasks or, for large files, from the file's end."""
    monkeypatch.setattr(raw, "SMALL_FILE", small)
    monkeypatch.setattr(raw, "TAIL", 64)  # less than a footer
    kinds = ["k string", "k string, v int", "k string, v bigint", "v int, k string", "k string, v struct<a:int,b:array<double>>",
             "k string, v timestamp", "k string, v timestamp_ntz", "k string, v decimal(9,2)", "k string, v decimal(9,3)"]
    files = []
    for i, kind in enumerate(kinds):
        row = [tuple(None for _ in T._parse_datatype_string(kind))]
        spark.createDataFrame(row * (i + 1), kind).repartition(2).write.parquet(f"{tmp_path}/{i}")
        parts = [f"{tmp_path}/{i}/{name}" for name in os.listdir(tmp_path / str(i)) if name.endswith(".parquet")]
        files += [(f"file:{part}", None, os.path.getsize(part)) for part in parts]
    marks = {}
    for path, mark in raw.RawTable(spark, str(tmp_path))._marks(files):
        marks.setdefault(path.split("/")[-2], set()).add(mark)
    assert len(marks) == len(kinds) and all(len(m) == 1 for m in marks.values())
    assert len(set.union(*marks.values())) == len(kinds)


def test_a_later_load_lists_only_recent_files(spark, tmp_path):
    stage = str(tmp_path / "stage")
    table = raw.RawTable(spark, str(tmp_path / "table"), full_every=4)
    day = lambda n: dt.datetime(2026, 1, n, tzinfo=dt.timezone.utc)

    def put(name, n, rows):
        write_file(spark, f"{stage}/{name}.parquet", rows)
        os.utime(f"{stage}/{name}.parquet", (day(n).timestamp(),) * 2)

    for n in range(1, 9):
        put(f"day{n}", n, [(str(n), "1")])
    assert table.load(stage) == 8 and table.listings(stage).get() == "2026-01-08T00:00:00"
    put("day9", 9, [("9", "1")])
    put("day7", 9, [("7", "2"), ("70", "2")])  # overwritten
    put("late", 3, [("3", "late")])  # moved here under an old time
    # the window lists what changed after the 6th
    recent = table.new_files(stage, dt.datetime(2026, 1, 6))
    assert sorted(os.path.basename(r["path"]) for r in recent.collect()) == ["day7.parquet", "day9.parquet"]
    assert table.load(stage) == 2 and table.listings(stage).get() == "2026-01-09T00:00:00"
    assert table.load(stage) == 0
    assert table.load(stage) == 0
    assert table.load(stage) == 1  # a full listing finds the late one; nothing is skipped for good
    assert table.load(stage, full=True) == 0
    assert table.rows().count() == 12
    other = str(tmp_path / "other")  # another stage starts with a full listing
    write_file(spark, f"{other}/a.parquet", [("a", "1")])
    os.utime(f"{other}/a.parquet", (day(1).timestamp(),) * 2)
    assert table.load(other) == 1


def test_reload_with_the_same_stamp_replaces_the_file(spark, tmp_path):
    stage, table = str(tmp_path / "stage"), raw.RawTable(spark, str(tmp_path / "table"))
    write_file(spark, f"{stage}/a.parquet", [("1", "x"), ("2", "x"), ("3", "x")])
    table.load(stage, "2026-10-05")
    write_file(spark, f"{stage}/a.parquet", [("1", "yy"), ("2", "yy")])
    table.load(stage, "2026-10-05")
    newest = latest.latest_load(table.rows()).select(F.try_variant_get("record", "$.k", "string"), F.try_variant_get("record", "$.v", "string"))
    assert values(newest) == [("1", "yy"), ("2", "yy")]


def test_released_tables_leave_the_work_folder(spark):
    one, two = session.materialize(spark.range(3), "one"), session.materialize(spark.range(4), "two")
    assert os.path.isdir(one.stored_at) and two.count() == 4
    session.release(one)
    assert not os.path.exists(one.stored_at) and two.count() == 4
    session.release(two.stored_at, two.stored_at)
    assert not os.path.exists(two.stored_at)


def test_work_folder_comes_from_the_session():
    class Fake:
        def __init__(self, master, folder):
            self.master, self.applicationId = master, "app"
            self.conf, self.sparkContext = {"spark.checkpoint.dir": folder}, self

        def getCheckpointDir(self):
            return None

    assert work_dir(Fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        work_dir(Fake("yarn", None))


def test_properties_of_one_file_are_built_by_many_tasks(spark, tmp_path):
    n = 3 * bindings.PARTS_PER_TASK
    parts = spark.range(n).selectExpr(
        "id p_partkey", "'widget' p_name", "'Brand#1' p_brand", "'ECONOMY' p_type", "1 p_size", "2.0D p_retailprice"
    )
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rows = bindings.raw_properties(spark, str(tmp_path))
    tasks = rows.groupBy(F.spark_partition_id()).agg(F.count_distinct("property_id").alias("parts")).collect()
    assert sum(r["parts"] for r in tasks) == n
    assert max(r["parts"] for r in tasks) <= bindings.PARTS_PER_TASK + 10


def test_lineage_scan(spark, tmp_path):
    write_file(spark, f"{tmp_path}/s/one.parquet", [("x", "1")])
    got = raw.scan_with_lineage(spark, f"{tmp_path}/s").first()
    assert got["k"] == "x" and got["source_file"].endswith("/s/one.parquet")


def test_columnar_round_trip(spark):
    df = spark.createDataFrame(
        [(dt.date(2026, 1, 2), "b", 2, None), (dt.date(2026, 1, 1), "a", None, 1.5), (dt.date(2026, 1, 2), "a", 3, 2.5)],
        "d date, boro string, n int, x double",
    )
    wide = export.to_columnar(df, ["d", "boro"])
    assert tuple(wide.first()) == (["2026-01-01", "2026-01-02", "2026-01-02"], ["a", "a", "b"], [None, 3, 2], [1.5, 2.5, None])
    assert values(export.from_columnar(wide)) == [
        ("2026-01-01", "a", None, 1.5), ("2026-01-02", "a", 3, 2.5), ("2026-01-02", "b", 2, None),
    ]
    per = export.to_columnar(df, ["d"], per=["boro"])
    assert per.count() == 2


def test_json_types(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", Decimal("3"), Decimal("2.50"), dt.datetime(2026, 1, 2, 3, 4, 5))],
        "k string, i decimal(10,0), f decimal(10,2), t timestamp_ntz",
    )
    export.write_columnar(df, ["k"], str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.txt"))
    assert text.strip() == '{"k":["a"],"i":[3],"f":[2.5],"t":["2026-01-02T03:04:05"]}'
    rows = [("a\"}", Decimal("5.00"), None), ("b", Decimal("5.25"), 1.5), ("c", None, 2.0), ("d", Decimal("-0.10"), 0.0), ("e", Decimal("1200.00"), 1.0)]
    text = export.columnar_json(spark.createDataFrame(rows, "k string, f decimal(10,2), x double"), ["k"]).first()[0]
    assert text == '{"k":["a\\"}","b","c","d","e"],"f":[5,5.25,null,-0.1,1200],"x":[null,1.5,2.0,0.0,1.0]}'


def test_lots_are_split_by_season(spark, tmp_path):
    df = spark.createDataFrame([("1999-00", "1"), ("2000-01", "1"), ("2000-01", "2")], "heat_season string, bbl string")
    export.write_per_season(df, str(tmp_path / "lots"))
    assert {p.name for p in (tmp_path / "lots").iterdir() if p.is_dir()} == {"heat_season=1999-00", "heat_season=2000-01"}
    assert values(spark.read.json(str(tmp_path / "lots")).select("heat_season", "bbl")) == values(df)
