"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .sources.files import delete

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}
_written: dict[str, SparkSession] = {}  # stored tables that nobody has released


def get_session(app: str = "lotlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a private one only for local sessions without it."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:  # removed when the interpreter exits
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="lotlens-", ignore_cleanup_errors=True)
    return _local_dirs[app].name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used where several consumers need one result, where a result must not
    change between two reads (ranges cut by a sampled partitioning), and for
    lookups: the written size is known, so Catalyst broadcasts a small lookup by
    itself and plans a shuffle join, with AQE splitting hot keys, for a large one.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(*stored: DataFrame | str) -> None:
    """Delete tables written by ``materialize``; plans that still read them fail afterwards."""
    for one in stored:
        path = one if isinstance(one, str) else one.stored_at
        spark = _written.pop(path, None)
        if spark is not None:
            delete(spark, path)


def release_all(spark: SparkSession | None = None) -> None:
    """Delete what ``materialize`` has left, of one session or of all that still run."""
    for path, owner in list(_written.items()):
        if spark is None or owner is spark:
            with contextlib.suppress(Exception):  # the session may be gone
                release(path)


atexit.register(release_all)


def materialize_all(**frames: DataFrame) -> dict[str, DataFrame]:
    """Write independent frames at the same time, so that they share the cluster."""
    spark = next(iter(frames.values())).sparkSession
    write = inheritable_thread_target(spark)(materialize)
    with ThreadPoolExecutor(len(frames)) as pool:
        jobs = {name: pool.submit(write, df, name) for name, df in frames.items()}
        return {name: job.result() for name, job in jobs.items()}
