"""Upsert by version from a file stream: late, corrected and re-delivered records."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotlens.streaming import upsert
from lotlens.streaming.upsert import LatestState
from tests.conftest import values

SCHEMA = (
    T.StructType()
    .add("key", "string")
    .add("version", T.IntegerType())
    .add("file", "string")
    .add("payload", "string")
)


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def state(spark, tmp_path, buckets=4):
    return LatestState(spark, str(tmp_path / "state"), SCHEMA, ["key"], ["version", "file"], buckets)


def follow(spark, tmp_path, current):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = current.follow(stream, str(tmp_path / "checkpoint"))
    query.awaitTermination()


def test_newest_version_wins_whatever_the_order(spark, tmp_path):
    current, source = state(spark, tmp_path), str(tmp_path / "in")
    put(spark, source, [("a", 1, "f1", "a1"), ("b", 5, "f1", "b5")])
    follow(spark, tmp_path, current)
    put(spark, source, [("a", 2, "f2", "a2"), ("b", 4, "f2", "late"), ("c", 1, "f2", "c1")])
    follow(spark, tmp_path, current)
    assert values(current.current().select("key", "payload")) == [("a", "a2"), ("b", "b5"), ("c", "c1")]
    follow(spark, tmp_path, current)  # nothing new
    put(spark, source, [("a", 2, "f3", "resent")])
    follow(spark, tmp_path, current)
    assert values(current.current().select("key", "payload")) == [("a", "resent"), ("b", "b5"), ("c", "c1")]


def test_matches_one_batch_deduplication(spark, tmp_path):
    rows = [(f"k{i % 37}", (i * 7919) % 101, f"f{i % 5}", str(i)) for i in range(1000)]
    current = state(spark, tmp_path)
    for n in range(4):
        current.upsert(spark.createDataFrame(rows[n::4], SCHEMA), n)
    best = {}
    for k, v, f, p in rows:
        best[k] = max(best.get(k, (-1, "", "")), (v, f, p))
    got = {r["key"]: (r["version"], r["file"]) for r in current.current().collect()}
    assert got == {k: b[:2] for k, b in best.items()}


def test_redelivered_and_crashed_batches(spark, tmp_path, monkeypatch):
    current = state(spark, tmp_path)
    first = spark.createDataFrame([("a", 1, "f", "1")], SCHEMA)
    second = spark.createDataFrame([("a", 2, "f", "2"), ("b", 1, "f", "1")], SCHEMA)
    current.upsert(first, 0)
    current.upsert(second.filter(F.col("key") == "zzz"), 0)  # already committed: skipped
    with monkeypatch.context() as crash:
        crash.setattr(LatestState, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            current.upsert(second, 1)
    assert values(current.current().select("key", "version")) == [("a", 1)]
    current.upsert(second, 1)
    assert values(current.current().select("key", "version")) == [("a", 2), ("b", 1)]


class Crash(Exception):
    pass


def crashing(monkeypatch, at, after):
    """Let the ``at``-th store step of a batch fail, before or after it is done; returns the steps seen."""
    seen = []

    def step(owner, name):
        real = getattr(owner, name)

        def run(*args, **named):
            seen.append(name)
            if len(seen) - 1 == at and not after:
                raise Crash(name)
            out = real(*args, **named)
            if len(seen) - 1 == at and after:
                raise Crash(name)
            return out

        monkeypatch.setattr(owner, name, run)

    for name in ("create", "delete"):
        step(upsert, name)
    step(DataFrameWriter, "parquet")
    return seen


@pytest.mark.parametrize("after", [False, True])
def test_a_crash_at_any_step_loses_no_key(spark, tmp_path, monkeypatch, after):
    batch = lambda n, keys: spark.createDataFrame([(f"k{i}", n, "f", "") for i in keys], SCHEMA)
    for at in range(20):
        current = state(spark, tmp_path / str(at), buckets=2)
        for n in range(2):
            current.upsert(batch(n, range(12)), n)
        with monkeypatch.context() as patch:
            seen = crashing(patch, at, after)
            try:
                current.upsert(batch(2, range(6, 14)), 2)
                break
            except Crash:
                pass
        versions = {r["key"]: r["version"] for r in current.current().collect()}
        done = current.last_batch() == 2
        assert versions == {f"k{i}": 2 if done and i >= 6 else 1 for i in range(14 if done else 12)}
        current.upsert(batch(2, range(6, 14)), 2)
        current.upsert(batch(3, [0]), 3)
        versions = {r["key"]: r["version"] for r in current.current().collect()}
        assert versions == {"k0": 3, **{f"k{i}": 2 if i >= 6 else 1 for i in range(1, 14)}}
    # the buckets, the manifest, the marker, and the removal of superseded buckets and of their manifest
    assert seen[:3] == ["parquet", "parquet", "create"] and seen.count("delete") >= 2 and at == len(seen)


@pytest.mark.parametrize("left", ["manifests/batch=2", "manifests/batch=2/_temporary/0", "table/state_version=2/state_bucket=0"])
def test_folders_of_a_crash_are_no_commit(spark, tmp_path, left):
    current = state(spark, tmp_path)
    keys = lambda n: spark.createDataFrame([(f"k{i}", n, "f", "") for i in range(100)], SCHEMA)
    current.upsert(keys(1), 1)
    (tmp_path / "state" / left).mkdir(parents=True)
    assert current.last_batch() == 1 and current.current().count() == 100
    for n in range(3, 6):  # the abandoned batch is never retried
        current.upsert(keys(n).limit(3), n)
    assert current.current().count() == 100
    assert not (tmp_path / "state/manifests/batch=2").exists() and not (tmp_path / "state/table/state_version=2").exists()


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    current = state(spark, tmp_path, buckets=32)
    current.upsert(spark.createDataFrame([(f"k{i}", 1, "f", "") for i in range(200)], SCHEMA), 0)
    current.upsert(spark.createDataFrame([("k7", 2, "f", "")], SCHEMA), 1)
    versions = {r["state_version"]: r["n"] for r in current._manifest().groupBy("state_version").agg(F.count("*").alias("n")).collect()}
    assert versions[1] == 1 and versions[0] > 25
    assert current.current().count() == 200


def test_superseded_versions_are_removed(spark, tmp_path):
    current = state(spark, tmp_path)
    for n in range(5):
        current.upsert(spark.createDataFrame([(f"k{i}", n, "f", "") for i in range(50)], SCHEMA), n)
        stored = spark.read.parquet(current.table).count()
        assert stored <= 100 and len(current._commits()) <= 2
    assert current.current().count() == 50 and current.last_batch() == 4
    current.upsert(spark.createDataFrame([("k1", 9, "f", "")], SCHEMA), 5)
    assert current.current().count() == 50
